"""Multi-valued attributes to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_distinct(df: DataFrame, keep: list[str], items: Column, name: str) -> DataFrame:
    """One row per array item. ``keep`` identifies an input row and the items of a row are distinct,
    so the rows are distinct without a shuffle."""
    return df.select(*keep, F.explode(items).alias(name))
