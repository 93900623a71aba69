"""Consecutive ids in key order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from hiremart.sources.scratch import Scratch

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def dense_ids(
    df: DataFrame, keys: list[str], id_col: str, id_type: str, scratch: Scratch
) -> DataFrame:
    """Add ``row_number() over (order by keys)`` for rows whose keys are unique.

    Rows are range-partitioned and sorted, so the position inside a partition plus the sizes of the
    partitions before it is the global position. Range bounds come from sampling and may differ
    between evaluations; the table is therefore written once and both passes read that copy. Only
    one row per partition is broadcast.
    """
    placed = scratch.stage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()))
    slot = F.shiftright("_at", _LOCAL_BITS)
    sizes = placed.groupBy(slot.alias("_slot")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_slot", slot).join(F.broadcast(offsets), "_slot")
        .select((F.col("_before") + local + 1).cast(id_type).alias(id_col), *df.columns)
    )
