"""Small inputs shared by the tests of the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = ("the thing of a onan erth with inan to the stedly and what is here for all that ", "der und das ist ein nicht zu ")
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))

ODD_ROWS = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 3), (4, "!!! ... 123", None, "s", 11),
    (5, PROSE[0] * 8, "en", "s", 0), (5, PROSE[0] * 8, "en", "s", 0), (6, PROSE[0] * 8, "en", "s", 0),
    (7, PROSE[1] * 12, "de", "s", 0), (8, LONG, "en", "s", 0), (None, PROSE[0] * 8, "en", "s", 0), (None, None, None, None, None),
    (9, "one", "en", "s", 3), (10, "日本語 テスト é é \x1c x", "fr", "s", 0), (11, "#*$ | <a> & %", "en", "t", 13),
]


def odd(spark):
    """Nulls, blanks, repeated rows and ids, a long text, and extra columns with names the operators use."""
    rows = spark.createDataFrame(ODD_ROWS, SCHEMA)
    for name in ("_id", "ids", "blob", "spans", "score", "_read", "c0", "kept", "_range", "fingerprint"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, path, name="documents"):
    return [r.asDict() for r in spark.read.parquet(f"{path}/{name}.parquet").collect()]


def save(df, folder):
    """Write ``df`` as the documents table of ``folder``."""
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)
