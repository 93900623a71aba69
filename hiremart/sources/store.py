"""Where the daily tables are: Parquet folders that Spark's own writer fills.

A table is either written whole, or by parts (a day, a hash bucket of a key) with dynamic partition overwrite:
the parts that a frame holds rows of are replaced when its job commits, the files of all others stay as they
are. A job that fails or is stopped before that leaves the table as it was and can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from hiremart.sources import files

PART = "part"


def bucket(key: str, buckets: int) -> Column:
    """Name of the part that holds a key, one of ``buckets``."""
    return F.concat(F.lit("b"), F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), len(str(buckets)), "0"))


def values_of(df: DataFrame, part: Column) -> list[str]:
    """The parts that a frame has rows of; their number is bounded by the layout of the table."""
    return sorted(r[0] for r in df.select(part.cast("string")).distinct().collect())


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self._root}/{name}"

    def parts(self, name: str) -> list[str]:
        """Names of the parts of a table, sorted."""
        prefix = f"{PART}="
        return [n.removeprefix(prefix) for n in files.names(self._spark, self.path(name)) if n.startswith(prefix)]

    def exists(self, name: str) -> bool:
        return any(not n.startswith(("_", ".")) for n in files.names(self._spark, self.path(name)))

    def read(self, name: str, parts: list[str] | None = None, schema: StructType | str | None = None) -> DataFrame:
        """The table, or some of its parts, whose folders alone are listed. Columns that a part lacks read as missing.

        With a ``schema`` no file is opened to learn the columns, and a table without rows can be read.
        """
        if not self.exists(name) and (schema is None or parts):
            raise ValueError(f"no table {name!r} in {self._root}")
        known = self.parts(name)
        if not (self.exists(name) if parts is None else parts):
            return self._spark.createDataFrame([], schema if schema else self.read(name).schema)
        reader = self._spark.read.option("mergeSchema", bool(known) and schema is None)
        reader = reader.schema(schema) if schema else reader
        return reader.parquet(*[f"{self.path(name)}/{PART}={p}" for p in (known if parts is None else parts)] or [self.path(name)])

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Write a whole table, which ``df`` may not read."""
        df.write.mode("overwrite").options(**files.COMPACT).parquet(self.path(name))
        return self.read(name)

    def replace(self, name: str, df: DataFrame, part: Column, of: list[str] | None = None, placed: bool = False,
                finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Replace the parts that ``df`` has rows of; it may read them. Of the parts ``of``, those without rows now are deleted.

        A part should be small enough for a task, as all of it comes from one, in the order ``df`` gives within it.
        ``placed`` rows are already where they are to be written. ``finish`` is applied after the rows were moved.
        """
        rows = df.withColumn(PART, part.cast("string"))
        if of is None and not placed:  # parts of any size: small ones share a task, large ones are split
            rows = rows.hint("rebalance", PART)
        gone = set()
        if of is not None:
            gone = set(of) & set(self.parts(name)) - set(values_of(rows, F.col(PART)))
        finish(rows).write.mode("overwrite").options(partitionOverwriteMode="dynamic", **files.COMPACT).partitionBy(
            PART).parquet(self.path(name))
        for old in gone:
            files.delete(self._spark, f"{self.path(name)}/{PART}={old}")
