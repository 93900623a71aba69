"""Intermediate tables written to the shared checkpoint folder.

A written table cuts lineage, survives the loss of any executor and keeps column pruning for
its readers, which a cached or checkpointed plan does not.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from hiremart.sources import files

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for an unconfigured local session."""
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="hiremart-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    sc.setCheckpointDir(root)
    return root


class Scratch:
    """Hands out staged copies of DataFrames, written with ``options``; ``close`` removes them once results are stored."""

    def __init__(self, spark: SparkSession, **options: str) -> None:
        self._spark, self._options = spark, options
        self._root = f"{checkpoint_root(spark)}/hiremart/{uuid.uuid4().hex}"
        self._count = 0
        atexit.register(self._forget)

    def path(self, name: str) -> str:
        """A folder of this scratch space that the caller writes itself."""
        self._count += 1
        return f"{self._root}/{name}"

    def stage(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self._root}/{self._count:04d}"
        df.write.options(**self._options).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        if self._count:
            files.delete(self._spark, self._root)
            self._count = 0

    def _forget(self) -> None:
        """At the end of the driver, while its session still runs: nothing can read the tables any more."""
        if self._spark.sparkContext._jsc is not None:
            self.close()

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
