from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from hiremart.operators import extract as X, quality as Q
from hiremart.operators.aggregate import with_share
from hiremart.operators.dedup import keep_last, purge_duplicates
from hiremart.operators.dense_ids import dense_ids
from hiremart.operators.scd2 import open_versions, scd2_merge
from hiremart.operators.upsert import affected_rows, upsert
from hiremart.plans import marts as M
from hiremart.sources.scratch import Scratch
from hiremart.streaming import incremental as INC
from tests.conftest import SF


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def day(n):
    return datetime(2024, 1, n)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.mark.parametrize("partitions", ["1", "4", "32"])
def test_dense_ids_equal_the_global_window(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey", "o_orderkey")
        # one key holds a third of all rows
        df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 7)
                           .otherwise(F.col("o_custkey")))
        got = dense_ids(df, ["o_custkey", "o_orderkey"], "id", "bigint", Scratch(spark))
        wanted = df.withColumn(
            "id", F.row_number().over(Window.orderBy("o_custkey", "o_orderkey")))
        assert rows(got, "id", "o_custkey", "o_orderkey") == \
            rows(wanted, "id", "o_custkey", "o_orderkey")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _fact_inputs(spark, scratch):
    """A stored fact with a hot company and mostly missing places, and its dimensions."""
    state = scratch.stage(spark.range(0, 60_000, 1, 8).selectExpr(
        "cast(id % 5000 as string) as job_bk", "timestamp_ntz'2024-01-01 00:00:00' as snapshot_ts",
        "20240101 as date_id", "if(id % 3 = 0, cast(id % 5000 as string), 'hot') as company_bk",
        "if(id % 4 = 0, cast(id % 900 as string), null) as location_code", "20240101 as deadline_date_id",
        "1.0D as salary_min", "2.0D as salary_max", "1.5D as salary_avg", "'VND' as salary_currency",
        "md5(cast(id as string)) as snapshot_hash"))
    versions = spark.range(5000).selectExpr(
        "cast(id as string) as k", "id as sk", "cast(null as timestamp_ntz) as dbt_valid_to")
    hot = spark.sql("select 'hot' k, 9999L sk, cast(null as timestamp_ntz) dbt_valid_to")
    jobs = scratch.stage(versions.selectExpr("k as external_job_id", "sk as job_sk", "dbt_valid_to"))
    companies = scratch.stage(versions.unionByName(hot).selectExpr(
        "k as company_id", "sk as company_sk", "dbt_valid_to"))
    places = scratch.stage(spark.range(900).selectExpr("cast(id as string) as location_code", "id as location_id"))
    return state, jobs, companies, places


def _jobs_run(spark, build):
    """How many jobs ``build`` starts."""
    sc, group = spark.sparkContext, "counted"
    sc.setJobGroup(group, group)
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_fact_joins_start_no_job_and_spread_hot_keys(spark):
    tight = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "96k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    inputs, kept = _fact_inputs(spark, Scratch(spark)), {k: spark.conf.get(k, None) for k in tight}
    built = []
    assert _jobs_run(spark, lambda: built.append(M.fct_job_snapshot(*inputs))) == 0
    plain = sorted(map(str, built[0].collect()))
    try:
        for key, value in tight.items():
            spark.conf.set(key, value)
        fact = M.fct_job_snapshot(*inputs)
        assert sorted(map(str, fact.collect())) == plain and len(plain) == 60_000
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_merging_records_starts_no_job_and_reads_company_pages_once(spark):
    names = "title,salary,location,experience,deadline,tags,desc_mota,desc_yeucau,desc_quyenloi,working_addresses," \
            "working_times,company_url_from_job,company_name_full,company_website,company_size,company_followers," \
            "company_industry,company_address"
    cards = spark.createDataFrame([("j", "t", "s", "a", "e", "c", "u")],
                                  "job_url string,title string,salary string,address_list string,exp_list string,"
                                  "company string,company_url string")
    details = spark.createDataFrame([], "job_url string," + ",".join(f"{n} string" for n in names.split(",")))
    pages = spark.createDataFrame([("u", "<h1>Big Co</h1>")], "url string, html string")
    built = []
    assert _jobs_run(spark, lambda: built.append(X.merge_records(
        cards, details, X.extract_company(pages), F.lit("now")))) == 0
    assert built[0].first()["company_name_full"] == "Big Co"
    plan = built[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_share_divides_by_the_sum_of_counts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 0)], "g string, n long")
    assert rows(with_share(df, "n", "p")) == [("a", 1, 33.33), ("b", 2, 66.67), ("c", 0, 0.0)]


def test_keep_last_and_purge(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "k string, v int, p int")
    assert rows(keep_last(df, "k", "p")) == [("a", 2), ("b", 1)]
    old = spark.createDataFrame(
        [("a", None, day(3), 1), ("a", day(2), day(9), 2), ("b", None, None, 3),
         ("b", None, None, 4), (None, None, None, 5), (None, None, None, 6)],
        "k string, crawled timestamp_ntz, created timestamp_ntz, p int")
    kept = purge_duplicates(old, "k", ["crawled", "created"], "p")
    assert sorted(r["p"] for r in kept.collect()) == [1, 4, 5, 6]


UP = "k string, v string, w string, seen timestamp_ntz"


def test_upsert_actions(spark):
    target = spark.createDataFrame(
        [("same", "1", None, day(2), day(1)), ("newer", "1", "x", day(2), day(1)),
         ("changed", "1", "x", day(2), day(1)), ("nulled", "1", "x", day(2), day(1)),
         ("older", "1", "x", day(5), day(1)), ("absent", "1", "x", day(2), day(1))],
        UP + ", created timestamp_ntz")
    batch = spark.createDataFrame(
        [("same", "1", None, day(1)), ("newer", "1", "x", day(3)), ("changed", "2", "x", day(2)),
         ("nulled", "1", None, day(2)), ("older", "9", "z", day(1)), ("new", "1", "x", day(3))], UP)
    merged = upsert(target, batch, "k", ["v", "w"], "seen", "created", ts("2024-01-09 00:00:00"))
    got = {r["k"]: tuple(r)[1:] for r in merged.collect()}
    assert got == {
        "same": ("1", None, day(2), day(1), "keep"),
        "newer": ("1", "x", day(3), day(1), "update"),
        "changed": ("2", "x", day(2), day(1), "update"),
        "nulled": ("1", None, day(2), day(1), "update"),
        "older": ("9", "z", day(5), day(1), "update"),  # last load wins, time does not move back
        "absent": ("1", "x", day(2), day(1), "keep"),
        "new": ("1", "x", day(3), day(9), "insert"),
    }
    assert affected_rows(merged) == 5
    again = upsert(merged.drop("_action"), batch, "k", ["v", "w"], "seen", "created",
                   ts("2024-01-10 00:00:00"))
    assert affected_rows(again) == 0


def test_scd2_cases(spark):
    def source(*items):
        return spark.createDataFrame(items, "k string, v string, updated_at timestamp_ntz")

    h = open_versions(source(("a", "1", day(1)), ("b", "1", day(1))), "k", "updated_at")
    steps = [
        (source(("a", "1", day(2)), ("b", "2", day(1))), "2024-01-02 12:00:00"),  # b is not newer
        (source(("b", "3", day(1))), "2024-01-03 00:00:00"),  # a is gone
        (source(("a", "9", day(4)), ("b", "3", day(1)), ("c", "1", day(4))), "2024-01-04 12:00:00"),
    ]
    for src, as_of in steps:
        h = scd2_merge(h, src, "k", "updated_at", ts(as_of))
    assert rows(h, "k", "v", "dbt_valid_from", "dbt_valid_to") == sorted([
        ("a", "1", day(1), day(2)), ("a", "1", day(2), day(3)), ("a", "9", day(4), None),
        ("b", "1", day(1), None), ("c", "1", day(4), None)], key=str)
    assert h.select("dbt_scd_id").distinct().count() == 5


def test_scd2_invariants_on_orders(spark):
    from hiremart.queries import scd2_hard_delete

    h = scd2_hard_delete(spark, SF)
    per_key = h.groupBy("job_bk").agg(F.count_if(F.col("dbt_valid_to").isNull()).alias("n"))
    assert per_key.where("n > 1").count() == 0
    w = Window.partitionBy("job_bk").orderBy("dbt_valid_from")
    overlaps = h.withColumn("next", F.lead("dbt_valid_from").over(w)).where(
        "next is not null and (dbt_valid_to is null or dbt_valid_to > next)")
    assert overlaps.count() == 0


def test_delete_insert_replays_and_follows_the_batch_schema(spark):
    state = spark.createDataFrame(
        [("a", day(1), 1, "old"), ("a", day(2), 2, "old")],
        "k string, t timestamp_ntz, v int, gone string")
    batch = spark.createDataFrame(
        [("a", day(2), 7, 0.5), ("b", day(3), 8, 0.7)], "k string, t timestamp_ntz, v int, n double")
    mark = INC.high_water_mark(state, "t")
    assert mark == "2024-01-02 00:00:00"
    once = INC.delete_insert(state, batch, ["k", "t"])
    assert rows(once) == [("a", day(1), 1, None), ("a", day(2), 7, 0.5), ("b", day(3), 8, 0.7)]
    assert rows(INC.delete_insert(once, batch, ["k", "t"])) == rows(once)
    events = batch.select("k", "t").unionByName(spark.createDataFrame(
        [("z", day(1)), ("a", day(1))], "k string, t timestamp_ntz"))
    assert rows(INC.late_rows(events, state, ["k", "t"], "t", mark)) == [("z", day(1))]
    assert INC.high_water_mark(state.where("v > 99"), "t") == INC.FLOOR


@pytest.mark.parametrize("as_of, status", [
    ("2024-01-02 01:00:00", "pass"), ("2024-01-02 01:00:01", "warn"),
    ("2024-01-03 00:00:01", "error")])
def test_freshness(spark, as_of, status):
    df = spark.createDataFrame([(day(1),)], "t timestamp_ntz")
    assert INC.freshness(df, "t", ts(as_of), 25, 48).first()["status"] == status
    assert INC.freshness(df.limit(0), "t", ts(as_of), 25, 48).first()["status"] == "error"


def test_checks_report_planted_counts(spark):
    df = spark.createDataFrame(
        [(1, "x", 1, 2), (1, None, 3, 2), (2, None, None, 1), (None, "q", 1, 1), (5, "x", 1, 1)],
        "k int, s string, lo int, hi int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    n = lambda d: [r["n_violations"] for r in d.collect()]
    assert n(Q.not_null(df, ["k", "s", "hi"])) == [1, 2, 0]
    assert n(Q.unique(df, "k")) == [1]
    assert n(Q.unique(df, "s")) == [1]
    assert n(Q.unique_combination(df, ["s", "hi"])) == [0]
    assert n(Q.unique_combination(df.select("s", "k").where("k is null or s is null")
                                  .withColumn("k", F.lit(1)), ["s", "k"])) == [1]
    assert n(Q.relationships(df, "k", parent, "k")) == [1]
    assert n(Q.expression_is_true(df, F.expr("lo <= hi"), "range")) == [2]
    with pytest.raises(Q.QualityError, match="not_null"):
        Q.require_clean(Q.not_null(df, ["k"]))
    Q.require_clean(Q.not_null(df, ["hi"]))


def test_raw_gate(spark):
    def gate(items, schema="job_url string, title string"):
        return Q.require_raw(spark.createDataFrame(items, schema), ["job_url", "title"], "job_url")

    assert gate([("a", "1"), ("b", "2")]) == 2
    for items, message in (([], "no rows"), ([("a", "1"), (" \t", "2")], "without"),
                           ([("a", "1"), (" a ", "2")], "duplicate")):
        with pytest.raises(Q.QualityError, match=message):
            gate(items)
    with pytest.raises(Q.QualityError, match="missing required columns: title"):
        gate([("a",)], "job_url string")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from hiremart.sources.scratch import checkpoint_root

    def session(master, configured=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: configured),
            sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert checkpoint_root(session("spark://x", "hdfs:///c")) == "hdfs:///c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(session("spark://x"))


def test_latest_row_is_limited_before_the_shuffle(spark):
    from hiremart.operators.dedup import latest_per_key

    df = spark.read.parquet(f"{SF}/events.parquet")
    plan = latest_per_key(df, ["user_id"], "ts", ["event_id"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
