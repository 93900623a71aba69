"""Daily posting drops on disk: find, read, write, and prepare for loading."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hiremart.config import POSTING_COLUMNS, Config
from hiremart.operators.dedup import keep_last
from hiremart.operators.quality import QualityError
from hiremart.sources import files

POSITION = "_position"
NO_TIME = "rows with missing or invalid crawled_at"
# Raw table: the posting record with a typed crawl time, plus the time of first load.
RAW_SCHEMA = T.StructType([
    *[T.StructField(c, T.TimestampNTZType() if c == "crawled_at" else T.StringType())
      for c in POSTING_COLUMNS],
    T.StructField("created_at", T.TimestampNTZType()),
])


def check_run_date(run_date: str) -> str:
    if not re.fullmatch(r"[0-9]{8}", run_date):
        raise ValueError(f"run date must be YYYYMMDD: {run_date!r}")
    return run_date


def find_drop(spark: SparkSession, folder: str, cfg: Config, run_date: str | None = None,
              today: str | None = None) -> str:
    """Path of the drop to load.

    With a run date only that day's drop will do: loading an older one as fresh is refused. Without,
    today's drop is preferred and else the newest by name.
    """
    if not files.exists(spark, folder):
        raise ValueError(f"no such folder: {folder}")
    found = [n for n in files.names(spark, folder)
             if n.startswith(f"{cfg.file_prefix}_") and n.endswith(".csv")]
    if run_date:
        wanted = f"{cfg.file_prefix}_{run_date}.csv"
        if wanted not in found:
            raise ValueError(f"no drop for run date {run_date} in {folder}")
        return f"{folder}/{wanted}"
    if today and f"{cfg.file_prefix}_{today}.csv" in found:
        return f"{folder}/{cfg.file_prefix}_{today}.csv"
    if not found:
        raise ValueError(f"no drops in {folder}")
    return f"{folder}/{found[-1]}"


def read_drop(spark: SparkSession, path: str) -> DataFrame:
    """All columns of the header as text plus the position of each row in the drop.

    Quoted line breaks keep a file whole in one task, so a drop is spread by its number of files.
    """
    rows = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .csv(path))
    return rows.select("*", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row")).alias(POSITION))


def write_drop(df: DataFrame, folder: str, cfg: Config, run_date: str,
               rows_per_file: int = 500_000) -> str:
    """Write the known columns present, in file order, as the drop of a day."""
    path = f"{folder}/{cfg.file_prefix}_{check_run_date(run_date)}.csv"
    (df.select(*[c for c in POSTING_COLUMNS if c in df.columns])
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("maxRecordsPerFile", rows_per_file).csv(path))
    return path


def _crawl_time(drop: DataFrame) -> Column:
    """The crawl time of a row; missing if it does not parse or the drop has none."""
    return F.col("crawled_at").try_cast("timestamp_ntz") if "crawled_at" in drop.columns else F.lit(None).cast("timestamp_ntz")


def prepare_batch(drop: DataFrame, counted: bool = False) -> DataFrame:
    """Drop to load-ready rows: keyed, typed, complete in columns, last row per key.

    Rows without a link are left out. Any other whose crawl time is missing or does not parse fails the job that reads
    the batch, also where a later row of its link is sound, so that old data cannot pass as fresh. Of a ``counted`` drop
    the caller has such rows counted and refuses the load itself (``require_crawl_times``).
    """
    link, crawled = F.regexp_replace("job_url", r"(?U)^\s+|\s+$", ""), _crawl_time(drop)
    # Part of the filter: no reader that leaves columns out leaves this out.
    timed = F.lit(True) if counted else F.when(crawled.isNotNull(), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit(f"{NO_TIME}: "), link)))
    keyed = drop.where(F.when(link != "", timed).otherwise(F.lit(False))).withColumn("job_url", link)
    have = set(drop.columns)
    text = [c for c in POSTING_COLUMNS if c != "crawled_at"]
    typed = keyed.select(
        *[(F.nullif(F.col(c), F.lit("")) if c in have else F.lit(None).cast("string")).alias(c)
          for c in text],
        crawled.alias("crawled_at"), POSITION)
    return keep_last(typed, "job_url", POSITION).select(*POSTING_COLUMNS)


def bad_crawl_times(drop: DataFrame) -> DataFrame:
    """One row: how many rows with a link have no usable crawl time."""
    return drop.agg(drop_counters(drop)[-1].alias("n"))


def drop_counters(drop: DataFrame) -> list[Column]:
    """What the gates of a load count in a drop: rows, rows without a link, rows with one but no crawl time."""
    linked = F.coalesce(F.regexp_replace("job_url", r"(?U)^\s+|\s+$", "") != "", F.lit(False))
    return [F.count("*").alias("row_count"), F.count_if(~linked).alias("blank_keys"),
            F.count_if(linked & _crawl_time(drop).isNull()).alias("bad_crawl_times")]


def require_crawl_times(bad: int) -> None:
    """Raise if any row with a link has no usable crawl time."""
    if bad:
        raise QualityError(f"{bad} {NO_TIME}")
