"""Keep one row per key.

``row_number() = 1`` is planned with a partial limit before the shuffle, so each map task ships at
most one row per key and a key that holds a third of the input costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], at: str, ties: list[str] = ()) -> DataFrame:
    """Row with the greatest ``at`` per key; equal times fall back to ``ties`` ascending."""
    order = [F.col(at).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]]
    return first_per_key(df, keys, order)


def keep_last(df: DataFrame, key: str, position: str) -> DataFrame:
    """Last occurrence of each key in input order."""
    return first_per_key(df, [key], [F.col(position).desc_nulls_last()]).drop(position)


def keep_first(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """First occurrence of each key in input order."""
    return first_per_key(df, keys, [F.col(p).asc_nulls_last() for p in position])


def purge_duplicates(df: DataFrame, key: str, newest: list[str], position: str) -> DataFrame:
    """Newest row per key by the first filled time; rows without a key are left alone."""
    time = F.coalesce(*[F.col(c) for c in newest])
    kept = first_per_key(
        df.where(F.col(key).isNotNull()), [key],
        [time.desc_nulls_last(), F.col(position).desc_nulls_last()])
    return kept.unionByName(df.where(F.col(key).isNull()))
