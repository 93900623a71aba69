"""Star schema: dimensions, bridge and fact."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hiremart.config import Config
from hiremart.functions.keys import date_id, packed_key, unpacked_key
from hiremart.functions.text import initcap_words
from hiremart.operators.dense_ids import dense_ids
from hiremart.operators.scd2 import open_versions
from hiremart.plans import intermediate as I
from hiremart.plans.staging import GRAIN, stg_postings
from hiremart.sources.files import COMPACT
from hiremart.sources.scratch import Scratch

FACT_COLUMNS = [
    "job_bk", "snapshot_ts", "job_sk", "date_id", "company_sk", "location_id", "deadline_date_id",
    "salary_min", "salary_max", "salary_avg", "salary_currency", "snapshot_hash",
]
# What an incremental run stores: business keys only, since surrogate keys are renumbered.
STATE_COLUMNS = [
    "job_bk", "snapshot_ts", "date_id", "company_bk", "location_code", "deadline_date_id",
    "salary_min", "salary_max", "salary_avg", "salary_currency", "snapshot_hash",
]
DIGESTS = ["job_bk", "company_bk", "snapshot_hash"]


def dim_source(spark: SparkSession, cfg: Config) -> DataFrame:
    return spark.range(1).select(
        F.lit(cfg.source_id).alias("source_id"), F.lit(cfg.source_name).alias("source_name"))


def dim_job(history: DataFrame, scratch: Scratch) -> DataFrame:
    versions = history.select(
        packed_key("dbt_scd_id").alias("dbt_scd_id"), F.col("job_bk").alias("external_job_id"), "source_id", "title", "job_url",
        F.col("experience_raw").alias("experience"), "desc_mota", "desc_yeucau", "desc_quyenloi",
        F.col("working_addresses_raw").alias("working_addresses"), "working_times",
        "dbt_valid_from", "dbt_valid_to",
    )
    numbered = dense_ids(versions, ["external_job_id", "dbt_valid_from"], "job_sk", "bigint", scratch)
    return numbered.withColumn("dbt_scd_id", unpacked_key("dbt_scd_id"))


def dim_company(history: DataFrame, scratch: Scratch) -> DataFrame:
    versions = history.select(
        "dbt_scd_id", F.col("company_bk").alias("company_id"), "company_name_full", "company_url",
        "company_website", "company_size", "company_followers", "company_industry",
        "company_address", "company_description", "dbt_valid_from", "dbt_valid_to",
    )
    return dense_ids(versions, ["company_id", "dbt_valid_from"], "company_sk", "bigint", scratch)


def dim_date(events: DataFrame, cfg: Config, today: Column | None = None,
             state: DataFrame | None = None, calendar: DataFrame | None = None) -> DataFrame:
    """Every day between the first and last crawl, or a year around ``today`` without any.

    Where deadlines are parsed the calendar also reaches from the first to the last deadline, so that fact
    rows find theirs. ``state`` adds the days of stored facts, ``calendar`` those of
    an earlier dimension. Only one row of bounds reaches the expansion.
    """
    today = F.current_date() if today is None else today
    days = events.select(F.col("snapshot_ts").cast("date").alias("day"), "deadline_date")
    if state is not None:
        stored = state.select(
            F.col("snapshot_ts").cast("date").alias("day"),
            F.to_date(F.col("deadline_date_id").cast("string"), "yyyyMMdd").alias("deadline_date"))
        days = days.unionByName(stored)
    if calendar is not None:
        days = days.unionByName(calendar.select(
            F.col("date_day").alias("day"), F.lit(None).cast("date").alias("deadline_date")))
    first, last = F.min("day"), F.max("day")
    if cfg.regex_mode == "intended":
        first = F.when(first.isNotNull(), F.least(first, F.min("deadline_date")))
        last = F.when(last.isNotNull(), F.greatest(last, F.max("deadline_date")))
    bounds = days.agg(first.alias("low"), last.alias("high"))
    calendar = bounds.select(F.explode(F.sequence(
        F.coalesce("low", F.date_sub(today, 365)), F.coalesce("high", F.date_add(today, 365))
    )).alias("date_day"))
    weekday = F.weekday("date_day") + 1
    return calendar.select(
        date_id("date_day").alias("date_id"), "date_day",
        F.dayofmonth("date_day").alias("day_of_month"), F.month("date_day").alias("month_of_year"),
        F.year("date_day").alias("year_number"), weekday.alias("iso_day_of_week"),
        (weekday >= 6).alias("is_weekend"),
    )


def dim_location(locations: DataFrame, scratch: Scratch, state: DataFrame | None = None,
                 known: DataFrame | None = None) -> DataFrame:
    """Places of the events, of stored facts and of an earlier dimension."""
    names = locations.select(F.col("location_name_norm").alias("location_code"))
    if state is not None:
        names = names.unionByName(
            state.where(F.col("location_code").isNotNull()).select("location_code"))
    if known is not None:
        names = names.unionByName(known.select("location_code"))
    named = names.distinct().withColumn("location_name", initcap_words("location_code"))
    return dense_ids(named, ["location_code"], "location_id", "int", scratch)


def dim_tag(tags: DataFrame, scratch: Scratch) -> DataFrame:
    names = tags.select(F.col("tag_name_norm").alias("tag_name")).distinct()
    return dense_ids(names, ["tag_name"], "tag_id", "int", scratch)


def current(dim: DataFrame, key: str, sk: str, name: str) -> DataFrame:
    """Surrogate key of the open version per business key."""
    return dim.where(F.col("dbt_valid_to").isNull()).select(F.col(key).alias(name), sk)


def bridge_job_tags(tags: DataFrame, dim_tags: DataFrame, dim_jobs: DataFrame) -> DataFrame:
    """Distinct (job, tag) pairs of current jobs.

    Pairs are made distinct before the joins; both look-ups are one-to-one, so they stay distinct.
    """
    pairs = tags.select("job_bk", F.col("tag_name_norm").alias("tag_name")).distinct()
    jobs = current(dim_jobs, "external_job_id", "job_sk", "job_bk")
    tagged = pairs.join(dim_tags, "tag_name").select("job_bk", "tag_id")
    return tagged.join(jobs, "job_bk").select("job_sk", "tag_id")


def fact_state(events: DataFrame, cfg: Config) -> DataFrame:
    """Events in fact shape, still carrying business keys."""
    return events.select(
        *GRAIN, F.col("snapshot_date_id").alias("date_id"), "company_bk",
        I.event_location(cfg).alias("location_code"),
        date_id("deadline_date").alias("deadline_date_id"),
        "salary_min", "salary_max", "salary_avg", "salary_currency", "snapshot_hash",
    )


def packed_facts(facts: DataFrame) -> DataFrame:
    """Facts with their digests as bytes, half as many, for the shuffles before a write."""
    return facts.withColumns({c: packed_key(c) for c in DIGESTS if c in facts.columns})


def unpacked_facts(facts: DataFrame) -> DataFrame:
    return facts.withColumns({c: unpacked_key(c) for c in DIGESTS if c in facts.columns})


def fct_job_snapshot(state: DataFrame, dim_jobs: DataFrame, dim_companies: DataFrame,
                     dim_locations: DataFrame) -> DataFrame:
    """Resolve business keys to the current surrogate keys; unknown keys stay missing.

    Plain joins: a dimension that turns out small is broadcast at run time. Postings without any company
    share one key, most have no place, and a place may name a whole city: adaptive execution splits such
    keys (null included) over tasks on the fact side, as each join is followed by another shuffle or the write.
    """
    jobs = current(dim_jobs, "external_job_id", "job_sk", "job_bk")
    companies = current(dim_companies, "company_id", "company_sk", "company_bk")
    places = dim_locations.select("location_code", "location_id")
    out = state.join(jobs, "job_bk", "left").join(companies, "company_bk", "left")
    return out.join(places, "location_code", "left").select(*FACT_COLUMNS)


class Mart:
    """A full build over one raw table; each model is built when first asked for.

    Staged postings are written once, since every model descends from them.
    """

    def __init__(self, raw: DataFrame, cfg: Config, scratch: Scratch | None = None,
                 today: Column | None = None) -> None:
        self._raw, self._cfg, self._today = raw, cfg, today
        self._spark = raw.sparkSession
        self._scratch = scratch or Scratch(self._spark, **COMPACT)

    @cached_property
    def stg(self) -> DataFrame:
        return self._scratch.stage(stg_postings(self._raw, self._cfg))

    @cached_property
    def events(self) -> DataFrame:
        return I.int_job_snapshot_events(self.stg, self._cfg)

    @cached_property
    def tags(self) -> DataFrame:
        return I.int_job_tags(self.events, self._cfg)

    @cached_property
    def locations(self) -> DataFrame:
        return I.int_job_locations(self.events, self._cfg)

    @cached_property
    def job_source(self) -> DataFrame:
        return I.int_job_snapshot_source(self.stg)

    @cached_property
    def company_source(self) -> DataFrame:
        return I.int_company_snapshot_source(self.stg)

    @cached_property
    def snap_dim_job(self) -> DataFrame:
        return open_versions(self.job_source, "job_bk", "updated_at")

    @cached_property
    def snap_dim_company(self) -> DataFrame:
        return open_versions(self.company_source, "company_bk", "updated_at")

    @cached_property
    def dim_source(self) -> DataFrame:
        return dim_source(self._spark, self._cfg)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.events, self._cfg, self._today)

    @cached_property
    def dim_job(self) -> DataFrame:
        return dim_job(self.snap_dim_job, self._scratch)

    @cached_property
    def dim_company(self) -> DataFrame:
        return dim_company(self.snap_dim_company, self._scratch)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dim_location(self.locations, self._scratch)

    @cached_property
    def dim_tag(self) -> DataFrame:
        return dim_tag(self.tags, self._scratch)

    @cached_property
    def bridge_job_tags(self) -> DataFrame:
        return bridge_job_tags(self.tags, self.dim_tag, self.dim_job)

    @cached_property
    def fct_job_snapshot(self) -> DataFrame:
        return fct_job_snapshot(
            fact_state(self.events, self._cfg), self.dim_job, self.dim_company, self.dim_location)
