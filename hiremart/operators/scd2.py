"""Type-2 history by update time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.functions.keys import scd_id

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def open_versions(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """First run: every source row opens a version."""
    return source.select(
        *[c for c in source.columns if c != updated_at],
        scd_id(key, updated_at).alias("dbt_scd_id"),
        F.col(updated_at).alias("dbt_updated_at"),
        F.col(updated_at).alias("dbt_valid_from"),
        F.lit(None).cast(source.schema[updated_at].dataType).alias("dbt_valid_to"),
    )


def merge_open(current: DataFrame, source: DataFrame, key: str, updated_at: str, as_of: Column
               ) -> DataFrame:
    """Merge the open versions with a source; both hold a key at most once.

    A key new to ``current`` opens a version. A later ``updated_at`` closes the open version at that
    time and opens the next, whether or not any attribute changed. A key gone from the source is
    closed at ``as_of``. One full outer join; a key yields one or two rows from an array, so nothing
    is scanned twice. The result holds the open versions and those closed by this run.
    """
    fresh = open_versions(source, key, updated_at).select(*current.columns)
    columns = current.columns
    both = (
        current.select(F.col(key).alias("_k"), F.struct(*columns).alias("_old"))
        .join(fresh.select(F.col(key).alias("_k"), F.struct(*columns).alias("_new")), "_k",
              "full_outer")
    )
    old, new = F.col("_old"), F.col("_new")

    def closed(at: Column) -> Column:
        fields = [at.alias(c) if c == "dbt_valid_to" else old[c].alias(c) for c in columns]
        return F.struct(*fields)

    versions = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull(), F.array(closed(as_of)))
        .when(old["dbt_valid_from"] < new["dbt_valid_from"],
              F.array(closed(new["dbt_valid_from"]), new))
        .otherwise(F.array(old))
    )
    return both.select(F.explode(versions).alias("_v")).select("_v.*")


def scd2_merge(history: DataFrame, source: DataFrame, key: str, updated_at: str, as_of: Column
               ) -> DataFrame:
    """Whole history after one run; versions closed earlier pass through untouched."""
    is_open = F.col("dbt_valid_to").isNull()
    merged = merge_open(history.where(is_open), source, key, updated_at, as_of)
    return history.where(~is_open).unionByName(merged)
