"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Rows whose texts are unpacked at once in a Python worker.
ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` behind as many underscores as it takes for none to be a column of ``df``."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any(mark + n in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def crc_of(column: str = "doc_id") -> Column:
    """crc32 of the id written as text (null: empty), the contract's fold function."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def map_rows(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]],
             schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` over plain lists: ``fn`` gets and gives blocks of columns, at most ROWS rows each."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[dict[str, list]]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    yield batch.slice(at, ROWS).to_pydict()

        for out in fn(blocks()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, keep: list[str], value: Column, fn: Callable[[list], list[tuple]],
                added: str) -> DataFrame:
    """``keep`` columns of ``df`` as they are, and the ``added`` ones: ``fn`` gives a tuple for each ``value``.

    Columns go by place inside, so no name of ``df`` can clash with one of this function's.
    """
    new = T._parse_datatype_string(added)
    kept = [df.schema[c] for c in keep]
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*kept, *new])])
    arrow = to_arrow_schema(inner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = list(zip(*fn(part.column(len(kept)).to_pylist())))
                made = [pa.array(f, arrow.field(len(kept) + i).type) for i, f in enumerate(found)]
                old = [part.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*old, *made], schema=arrow)

    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], value.alias(f"c{len(kept)}"))
    return rows.mapInArrow(run, inner).toDF(*keep, *[f.name for f in new])


def made_in_task(sample: DataFrame, order: list[Column], fn: Callable[[Iterator[dict[str, list]]], Any]) -> Any:
    """What ``fn`` makes of a bounded ``sample``, read in ``order`` in blocks of columns.

    One task streams the rows, so the driver gets the result only and a lost executor costs a repetition.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (b.slice(at, ROWS).to_pydict() for b in batches for at in range(0, b.num_rows, ROWS))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fn(blocks))], pa.binary())], ["made"])

    made = sample.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "made binary").collect()
    return pickle.loads(made[0]["made"]) if made else fn(iter(()))


def bounded_share(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of ``keys``, or all if there are no more than that."""
    total = df.count()
    if total <= rows:
        return df
    share = int(1_000_000 * rows / total)
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) < share)
