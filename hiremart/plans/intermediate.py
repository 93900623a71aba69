"""Events, exploded attributes and the latest record per entity, from staged postings.

Staged postings are unique on (job_bk, snapshot_ts). Tags and places of one posting are therefore
made distinct inside its row, and its representative place is an array minimum: exploding needs no
shuffle, and the fact needs no join back to the exploded places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.config import Config
from hiremart.functions.keys import date_id, packed_key, surrogate_key, unpacked_key
from hiremart.functions.salary import salary_midpoint
from hiremart.functions.text import location_items, parse_deadline, tag_items
from hiremart.operators.dedup import latest_per_key
from hiremart.operators.explode import explode_distinct
from hiremart.plans.staging import COLUMNS, GRAIN

JOB_ATTRIBUTES = [
    "job_bk", "source_id", "title", "job_url", "experience_raw", "desc_mota", "desc_yeucau",
    "desc_quyenloi", "working_addresses_raw", "working_times",
]
COMPANY_ATTRIBUTES = [
    "company_bk", "company_url", "company_name_full", "company_website", "company_size",
    "company_followers", "company_industry", "company_address", "company_description",
]
HASHED = ["job_bk", "snapshot_ts", "title", "company_bk", "location_raw", "tags_raw",
          "salary_min", "salary_max"]


def int_job_snapshot_events(stg: DataFrame, cfg: Config) -> DataFrame:
    return stg.select(
        *COLUMNS[:4],
        date_id(F.col("snapshot_ts").cast("date")).alias("snapshot_date_id"),
        *COLUMNS[4:],
        parse_deadline("deadline_raw", cfg.regex_mode).alias("deadline_date"),
        salary_midpoint("salary_min", "salary_max").alias("salary_avg"),
        surrogate_key(*HASHED).alias("snapshot_hash"),
    )


def int_job_tags(events: DataFrame, cfg: Config) -> DataFrame:
    return explode_distinct(events, GRAIN, tag_items("tags_raw", cfg.regex_mode), "tag_name_norm")


def _places(cfg: Config) -> Column:
    return location_items("working_addresses_raw", "location_raw", cfg.regex_mode)


def int_job_locations(events: DataFrame, cfg: Config) -> DataFrame:
    return explode_distinct(events, GRAIN, _places(cfg), "location_name_norm")


def event_location(cfg: Config) -> Column:
    """The place an event is counted under: the first in text order."""
    return F.when(F.col("snapshot_ts").isNotNull(), F.array_min(_places(cfg)))


def int_job_snapshot_source(stg: DataFrame) -> DataFrame:
    """Latest record per job."""
    narrow = stg.where(F.col("job_bk").isNotNull()).select(*JOB_ATTRIBUTES, "snapshot_ts")
    latest = latest_per_key(narrow.withColumn("job_bk", packed_key("job_bk")), ["job_bk"], "snapshot_ts")
    return latest.withColumn("job_bk", unpacked_key("job_bk")).withColumnRenamed("snapshot_ts", "updated_at")


def int_company_snapshot_source(stg: DataFrame) -> DataFrame:
    """Latest record per company; of its jobs seen at that time, the smallest job key speaks."""
    narrow = stg.where(F.col("company_bk").isNotNull()).select(
        *COMPANY_ATTRIBUTES, "snapshot_ts", "job_bk")
    latest = latest_per_key(narrow, ["company_bk"], "snapshot_ts", ["job_bk"])
    return latest.drop("job_bk").withColumnRenamed("snapshot_ts", "updated_at")
