"""Keyed upsert: insert new keys, overwrite changed ones, leave the rest."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, KEEP = "insert", "update", "keep"


def upsert(
    target: DataFrame, batch: DataFrame, key: str, columns: list[str], seen_at: str,
    created_at: str, now: Column,
) -> DataFrame:
    """Merge ``batch`` into ``target``, both unique on ``key``; ``_action`` tells what happened.

    An existing row changes if any of ``columns`` differs (missing equals missing) or the batch was
    seen later. It then takes every column from the batch, whichever was seen last; ``seen_at``
    never moves back and ``created_at`` stays. A column that one side lacks is missing there, so an older
    table takes up new columns. One shuffle of each side, no hot keys: both sides hold a key at most once.
    """
    old = target.select(F.col(key).alias("_k"), F.struct(*target.columns).alias("_old"))
    new = batch.select(F.col(key).alias("_k"), F.struct(*batch.columns).alias("_new"))
    both = old.join(new, "_k", "full_outer")

    def side(df: DataFrame, other: DataFrame, struct: str, name: str) -> Column:
        if name in df.columns:
            return F.col(f"{struct}.{name}")
        kind = other.schema[name].dataType if name in other.columns else "string"
        return F.lit(None).cast(kind)

    def o(name: str) -> Column:
        return side(target, batch, "_old", name)

    def n(name: str) -> Column:
        return side(batch, target, "_new", name)

    differs = reduce(or_, [~o(c).eqNullSafe(n(c)) for c in columns])
    newer = F.coalesce(n(seen_at) > o(seen_at), F.lit(False))
    action = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNotNull() & (differs | newer), UPDATE)
        .otherwise(KEEP)
    )
    merged = both.withColumn("_action", action)
    keep = F.col("_action") == KEEP
    return merged.select(
        F.col("_k").alias(key),
        *[F.when(keep, o(c)).otherwise(n(c)).alias(c) for c in columns],
        F.when(keep, o(seen_at)).otherwise(F.greatest(o(seen_at), n(seen_at))).alias(seen_at),
        F.when(F.col("_old").isNull(), now).otherwise(o(created_at)).alias(created_at),
        "_action",
    )


def affected_rows(merged: DataFrame) -> int:
    """Rows inserted or updated."""
    return merged.where(F.col("_action") != KEEP).count()
