"""Raw postings to one typed row per (job, crawl time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hiremart.config import Config
from hiremart.functions.keys import surrogate_key
from hiremart.functions.salary import with_salary
from hiremart.functions.text import blank_to_null
from hiremart.operators.dedup import first_per_key

GRAIN = ["job_bk", "snapshot_ts"]
LOWERED = ["company_url", "company_name_full", "company_website"]
PLAIN = [
    "company_size", "company_followers", "company_industry", "company_address",
    "company_description",
]
RAW_NAMED = {"location": "location_raw", "experience": "experience_raw",
             "deadline": "deadline_raw", "tags": "tags_raw"}
TEXTS = ["desc_mota", "desc_yeucau", "desc_quyenloi"]
COLUMNS = [
    "job_bk", "company_bk", "source_id", "snapshot_ts", "job_url", "title", *LOWERED, *PLAIN,
    *RAW_NAMED.values(), *TEXTS, "working_addresses_raw", "working_times", "salary_currency",
    "salary_min", "salary_max",
]


def typed_postings(raw: DataFrame, cfg: Config) -> DataFrame:
    """Normalise text, parse salaries and derive the company key, as bytes; one output row per input row."""
    priced = with_salary(raw.where(F.trim("job_url") != ""), "salary", cfg.usd_rate)
    cleaned = priced.select(
        F.col("crawled_at").cast("timestamp_ntz").alias("snapshot_ts"),
        F.lower(F.trim("job_url")).alias("job_url"),
        blank_to_null("title").alias("title"),
        *[F.lower(blank_to_null(c)).alias(c) for c in LOWERED],
        *[blank_to_null(c).alias(c) for c in PLAIN],
        *[blank_to_null(c).alias(name) for c, name in RAW_NAMED.items()],
        *[blank_to_null(c).alias(c) for c in TEXTS],
        blank_to_null("working_addresses").alias("working_addresses_raw"),
        blank_to_null("working_times").alias("working_times"),
        "salary_currency", "salary_min", "salary_max",
    )
    company = [F.coalesce(F.col(c), F.lit("")) for c in LOWERED]
    return cleaned.withColumn("company_bk", F.unhex(surrogate_key(*company)))


def stg_postings(raw: DataFrame, cfg: Config) -> DataFrame:
    """One row per (job, crawl time): titled rows first, then rows naming a company page.

    Rows still equal are told apart by their remaining columns, so the choice does not depend on
    how the input was split. A job is its link here, and its key is added to the rows that stay: digests in hex
    would be a quarter of what is shuffled. Those of companies order the rows, as bytes like as text.
    """
    order = [F.col("title").isNull().cast("int"), F.col("company_url").isNull().cast("int")]
    ties = [F.col(c).asc_nulls_last() for c in COLUMNS if c not in (*GRAIN, "source_id", "job_url")]
    kept = first_per_key(typed_postings(raw, cfg), ["job_url", "snapshot_ts"], [*order, *ties])
    return kept.withColumns({
        "job_bk": surrogate_key("job_url"), "company_bk": F.lower(F.hex("company_bk")),
        "source_id": F.lit(cfg.source_id)}).select(*COLUMNS)


def salary_failures(raw: DataFrame, cfg: Config) -> DataFrame:
    """Postings whose salary carries digits but gives no amount, in the shape of a check."""
    keyed = raw.where(F.trim("job_url") != "").select("salary")
    return with_salary(keyed, "salary", cfg.usd_rate).agg(
        F.lit("salary_parse_failed").alias("check"), F.lit("salary").alias("column_name"),
        F.count_if("salary_failed").alias("n_violations"))
