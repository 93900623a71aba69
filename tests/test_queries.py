"""Every registered query against its SQL twin at the smallest scale."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hiremart import queries as registry
from hiremart.operators import quality as Q
from hiremart.plans.checks import Checks
from hiremart.sources import drops
from hiremart.sources.scratch import Scratch
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def bag(rows):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = bag(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert bag(tuple(r[c] for c in columns) for r in got.collect()) == expected


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_a_drop_in_crawl_order_is_written_by_more_tasks_than_days(spark, monkeypatch):
    """Sorted by crawl time alone, each of the five days would be one task, however many rows it has."""
    sizes, write = {}, drops.write_drop

    def spy(df, folder, cfg, run_date):
        sizes[run_date] = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        return write(df, folder, cfg, run_date)

    monkeypatch.setattr(drops, "write_drop", spy)
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        entry.queries()["load_batch"](spark, SF)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(sizes["20240105"]) > 5 and max(sizes["20240105"]) < sum(sizes["20240105"]) / 5


def test_a_lone_uniqueness_check_makes_no_text_of_its_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (2, None)], "k long, t string")
    for columns, combinations, column in ((["k"], [], "k"), (["t"], [], "t"), ([], [["k", "t"]], "k+t")):
        found = Q.uniqueness(rows, columns, combinations)
        assert "concat" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert [(r["column_name"], r["n_violations"]) for r in found.collect()] == [(column, 3 if combinations else 2)]


def test_tables_of_a_build_are_made_from_the_copies_of_those_before(spark):
    plans = []

    class Spy(Scratch):
        def stage(self, df):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return super().stage(df)

    with Spy(spark) as scratch:
        table = registry._tables(spark, SF, scratch)
        for source, history in (("int_job_snapshot_source", "snap_dim_job"), ("int_company_snapshot_source", "snap_dim_company")):
            table(source)
            assert "Window" in plans[-1]
            table(history)
            assert "Window" not in plans[-1]


def test_damaged_tables_are_made_as_they_are_read(spark):
    """Copies by the first required value: again; again without required values; again with keys that are none. Nothing is stored."""
    rows = spark.createDataFrame([("1", 5, None), ("2", None, 7), ("123", 8, 9), ("4", 3, 2), (None, 1, 1)], "a string, b int, c long")
    checks = Checks(not_null=("a", "b"), relationships={"b": ("p", "k"), "c": ("p", "k")})
    found = registry._damaged(rows, checks)
    assert found.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("1", 5, None), ("2", None, 7), ("123", 8, 9), ("4", 3, 2), (None, 1, 1),
        ("1", 5, None), ("123", 8, 9), (None, None, 7), (None, None, 9), ("123", -9, -10)], key=str)
    assert registry._damaged(rows, Checks(not_null=("a", "b"))).count() == 9


def test_the_suite_over_damaged_tables_stores_sound_ones_only(spark, monkeypatch):
    staged = []

    class Spy(Scratch):
        def stage(self, df):
            staged.append((self._options, df._jdf.queryExecution().optimizedPlan().toString()))
            return super().stage(df)

    monkeypatch.setattr(registry, "Scratch", Spy)
    entry.queries()["dq_suite_damaged"](spark, SF)
    assert 5 < len(staged) < 12 and all(options == {"compression": "zstd"} and "Union" not in plan for options, plan in staged)
