"""Incremental processing of scheduled batches: high-water mark, late rows, freshness.

The workload is a daily batch, so "late" means older than everything already stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

FLOOR = "1900-01-01 00:00:00"


def high_water_mark(state: DataFrame, at: str) -> str:
    """Latest time in the stored state as text, or a floor for an empty one.

    The single value goes back into the plan as a literal so that it reaches the file scan.
    """
    seen = state.agg(F.max(at).cast("string").alias("hwm")).first()["hwm"]
    return seen or FLOOR


def _literal(mark: str) -> Column:
    return F.lit(mark).cast("timestamp_ntz")


def on_or_after(df: DataFrame, at: str, mark: str) -> DataFrame:
    return df.where(F.col(at) >= _literal(mark))


def late_rows(df: DataFrame, state: DataFrame, keys: list[str], at: str, mark: str) -> DataFrame:
    """Rows older than the mark that were never stored: the ones an incremental run skips."""
    return df.where(F.col(at) < _literal(mark)).join(state.select(*keys), keys, "left_anti")


def delete_insert(state: DataFrame, batch: DataFrame, keys: list[str], at: str | None = None, mark: str | None = None
                  ) -> DataFrame:
    """Replace the stored rows of the batch's keys and add the rest; columns follow the batch.

    Columns the state lacks are filled with nulls, columns the batch lacks are dropped. With the state's high-water
    ``mark`` of ``at``, one of the keys, rows of the batch after it are not looked for among the stored.
    """
    known = batch if mark is None else batch.where(F.col(at) <= _literal(mark))
    kept = state.join(known.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def freshness(df: DataFrame, at: str, as_of: Column, warn_hours: int, error_hours: int,
              *others: Column) -> DataFrame:
    """One row: latest time, age and pass / warn / error; ``others`` are aggregated in the same scan."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("as_of"))
    late = lambda hours: F.col("age_seconds") > hours * 3600
    return (
        df.agg(F.max(at).alias("max_loaded_at"), *others)
        .withColumn("as_of", as_of)
        .withColumn("age_seconds", age)
        .withColumn(
            "status",
            F.when(F.col("max_loaded_at").isNull() | late(error_hours), "error")
            .when(late(warn_hours), "warn").otherwise("pass"))
    )
