"""Shares of a total and exact means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_share(counts: DataFrame, count_col: str, share_col: str) -> DataFrame:
    """Percent of the summed counts, two decimals; a group of zero rows in total has no share.

    The total is a scalar subquery, so the grouped rows are never gathered in one task.
    """
    total = counts.agg(F.sum(count_col).alias("total")).scalar()
    share = F.lit(100).cast("decimal(4,1)") * F.col(count_col) / F.nullif(total, F.lit(0))
    return counts.withColumn(share_col, F.round(share, 2).cast("double"))


def mean_millions(total: Column, count: Column, parts: int = 1) -> Column:
    """``total / (count * parts)`` in millions, rounded half up to two decimals."""
    rows = F.nullif(count * F.lit(parts), F.lit(0)).cast("decimal(18,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.round(total.cast("decimal(26,2)") / rows / million, 2).cast("double")
