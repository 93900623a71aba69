"""Six market reports over the star schema.

Reports of the current market read only the latest date. The date is a scalar subquery over one
integer column, so the fact is filtered before anything is joined or shuffled. Distinct counts run
on (group, job) pairs first: a group holding most jobs is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hiremart import config as C
from hiremart.functions import buckets
from hiremart.functions.keys import date_id
from hiremart.functions.text import initcap_words
from hiremart.operators.aggregate import mean_millions, with_share


def latest_facts(fact: DataFrame) -> DataFrame:
    newest = fact.agg(F.max("date_id").alias("date_id")).scalar()
    return fact.where(F.col("date_id") == newest)


def top_keywords(fact: DataFrame, bridge: DataFrame, tags: DataFrame, limit: int = 20
                 ) -> DataFrame:
    """Most wanted tags with their share of all (job, tag) pairs; equal counts by name."""
    jobs = latest_facts(fact).where(F.col("job_sk").isNotNull()).select("job_sk").distinct()
    # The bridge holds a pair once and jobs are distinct: rows are distinct jobs per tag.
    counts = bridge.join(jobs, "job_sk").groupBy("tag_id").agg(F.count("*").alias("job_count"))
    shared = with_share(counts, "job_count", "appearance_percentage")
    named = shared.join(tags, "tag_id").select(
        F.col("tag_name").alias("keyword_name"), "job_count", "appearance_percentage")
    return named.orderBy(F.desc("job_count"), "keyword_name").limit(limit)


def salary_by_experience(fact: DataFrame, jobs: DataFrame) -> DataFrame:
    """Mean salaries in millions per experience text, in career order."""
    wanted = jobs.where(
        F.col("experience").isNotNull() & ~F.lower("experience").isin(C.EXPERIENCE_EXCLUDED)
    ).select("job_sk", "experience")
    paid = latest_facts(fact).where(F.col("salary_min") > 0)
    both = F.col("salary_min") + F.col("salary_max")
    grouped = paid.join(wanted, "job_sk").groupBy("experience").agg(
        F.count("*").alias("job_count"),
        F.sum(both).alias("_sum_both"), F.count(both).alias("_n_both"),
        F.sum("salary_min").alias("_sum_min"),
        F.sum("salary_max").alias("_sum_max"), F.count("salary_max").alias("_n_max"),
    )
    return grouped.select(
        F.col("experience").alias("experience_level"),
        buckets.experience_index("experience").alias("sort_index"),
        "job_count",
        mean_millions(F.col("_sum_both"), F.col("_n_both"), 2).alias("avg_salary_million_vnd"),
        mean_millions(F.col("_sum_min"), F.col("job_count")).alias("min_salary_million_vnd"),
        mean_millions(F.col("_sum_max"), F.col("_n_max")).alias("max_salary_million_vnd"),
    ).orderBy("sort_index", "experience_level")


def hotspots_by_location(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Jobs per city label with market share."""
    # The label is worked out once per place, not once per fact row.
    cities = locations.select("location_id", buckets.city("location_name").alias("city"))
    placed = latest_facts(fact).where(F.col("location_id").isNotNull())
    pairs = placed.select("location_id", "job_sk").distinct()
    counts = pairs.join(cities, "location_id").groupBy("city").agg(
        F.count_distinct("job_sk").alias("job_count"))
    return with_share(counts, "job_count", "market_share_percent").orderBy(
        F.desc("job_count"), "city")


def company_size_distribution(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs per company-size bucket with hiring share."""
    sizes = companies.select(
        "company_sk", buckets.size_label("company_size").alias("company_size"),
        buckets.size_index("company_size").alias("sort_index"))
    counts = _company_jobs(fact, sizes).groupBy("company_size", "sort_index").agg(
        F.count_distinct("job_sk").alias("job_count"))
    return with_share(counts, "job_count", "hiring_share_percent").select(
        "company_size", "job_count", "hiring_share_percent", "sort_index").orderBy("sort_index")


def top_companies(fact: DataFrame, companies: DataFrame, limit: int = 15) -> DataFrame:
    """Companies with the most open jobs; equal counts by name and size."""
    named = companies.select(
        "company_sk", "company_name_full",
        F.coalesce("company_size", F.lit("Unknown")).alias("company_size"))
    counts = _company_jobs(fact, named).groupBy("company_name_full", "company_size").agg(
        F.count_distinct("job_sk").alias("total_active_jobs"))
    best = counts.orderBy(
        F.desc("total_active_jobs"), F.asc_nulls_last("company_name_full"), "company_size"
    ).limit(limit)
    return best.select(
        initcap_words("company_name_full").alias("company_name"), "company_size",
        "total_active_jobs")


def _company_jobs(fact: DataFrame, companies: DataFrame) -> DataFrame:
    pairs = latest_facts(fact).where(F.col("company_sk").isNotNull()).select(
        "company_sk", "job_sk").distinct()
    return pairs.join(companies, "company_sk")


def trend_state(facts: DataFrame, key: str, *slot: str) -> DataFrame:
    """One row per day and job: facts with a stated salary and their amounts.

    Exact partial results: those of different days are put side by side, and a job may still be named
    by another key, or by none, when they are merged. Facts that were placed by day and ``slot``, which follows from
    the key, are aggregated where they are.
    """
    paid = F.col("salary_min") > 0
    both = F.when(paid, F.col("salary_min") + F.col("salary_max"))
    return facts.groupBy("date_id", *slot, key).agg(
        F.count_if(paid).alias("n_paid"), F.sum(both).alias("sum_both"), F.count(both).alias("n_both")).drop(*slot)


def merge_trend(states: DataFrame, key: str, dates: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """The trend from states in which a day holds a job once."""
    start = F.date_sub(as_of, days)
    window = dates.where(F.col("date_day") >= start).select("date_id", "date_day")
    recent = states.where((F.col("date_id") >= date_id(start)) & (F.col("n_paid") > 0))
    daily = recent.groupBy("date_id").agg(
        F.count(key).alias("total_active_jobs"), F.sum("sum_both").alias("_sum"), F.sum("n_both").alias("_n"))
    # Days are aggregated first: the join sees one row per day on either side.
    return daily.join(window, "date_id").select(
        F.col("date_day").alias("snapshot_date"), "total_active_jobs",
        mean_millions(F.col("_sum"), F.col("_n"), 2).alias("avg_market_salary_mil"),
    ).orderBy("snapshot_date")


def hiring_trend(fact: DataFrame, dates: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Jobs with a stated salary and their mean salary per day, back to ``days`` before ``as_of``."""
    # The bound on the fact's own key reaches its scan.
    recent = fact.where((F.col("date_id") >= date_id(F.date_sub(as_of, days))) & (F.col("salary_min") > 0))
    return merge_trend(trend_state(recent, "job_sk"), "job_sk", dates, as_of, days)
