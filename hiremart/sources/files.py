"""Few helpers over the Hadoop file system of the session, so paths may be local, HDFS or S3."""

from __future__ import annotations

from pyspark.sql import SparkSession

COMPACT = {"compression": "zstd"}  # options of a write: digests in hex take half the bytes, which snappy leaves as they are


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if it is missing."""
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; fails if it exists, so two writers cannot both claim a name."""
    fs, where = _fs(spark, path)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
