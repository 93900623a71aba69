from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import DataFrame, functions as F

from hiremart.config import POSTING_COLUMNS, Config
from hiremart.operators.quality import QualityError
from hiremart.plans import pipeline as P
from hiremart.sources import drops
from hiremart.sources.store import Store

CFG = Config(file_prefix="jobs")


def posting(n, day, **values):
    base = {c: None for c in POSTING_COLUMNS}
    base.update(
        job_url=f"https://j.example/viec-lam/x/{n}.html", title=f"Job {n}", salary="10 - 20 triệu",
        company_url="https://j.example/cong-ty/1", company_name_full="Acme co-op",
        company_size="10-24", location="Hà Nội", experience="2 năm", tags="SQL; Spark",
        deadline="5/1/2024", crawled_at=f"2024-01-0{day} 01:00:00")
    base.update(values)
    return tuple(base[c] for c in POSTING_COLUMNS)


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in POSTING_COLUMNS))


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("board"))


def written(store, name, part):
    """Names of the files of a part."""
    return sorted(n for n in os.listdir(f"{store.path(name)}/part={part}") if n.endswith(".parquet"))


def run_day(spark, place, store, day, rows, strict=True):
    drops.write_drop(frame(spark, rows), f"{place}/drops", CFG, f"2024010{day}")
    affected = P.ingest(spark, CFG, store, f"{place}/drops", f"2024-01-0{day} 02:00:00",
                        run_date=f"2024010{day}")
    return affected, P.transform(spark, CFG, store, f"2024-01-0{day} 03:00:00", strict)


def test_three_daily_runs(spark, place):
    store = Store(spark, f"{place}/store")
    multi = 'line one\nsays "hi", ok;  '
    affected, outcome = run_day(
        spark, place, store, 1,
        [posting(1, 1, desc_mota=multi), posting(2, 1, location="Saigon"), posting(3, 1)])
    assert (affected, outcome.freshness, outcome.failed_checks) == (3, "pass", [])
    stored = P.raw_table(store).where("desc_mota is not null").first()
    assert stored["desc_mota"] == multi and stored["created_at"] == datetime(2024, 1, 1, 2)

    # job 1 seen again, job 2 not crawled, job 4 new with another company
    other = {"company_url": None, "company_name_full": "Beta", "salary": "Trên 1000 USD"}
    affected, outcome = run_day(spark, place, store, 2, [posting(1, 2), posting(4, 2, **other)])
    assert (affected, outcome.late_rows, outcome.salary_failures) == (2, 0, 1)
    assert P.raw_table(store).count() == 4
    fact = P.serving_fact(store)
    assert fact.count() == 5 and fact.where("job_sk is null").count() == 0
    # ids are renumbered on every run, and old facts follow them
    pairs = fact.join(store.read("dim_job"), "job_sk").where("external_job_id <> job_bk")
    assert pairs.count() == 0
    jobs = store.read("dim_job").orderBy("job_sk").collect()
    assert [r["job_sk"] for r in jobs] == list(range(1, 6))
    assert sum(r["dbt_valid_to"] is None for r in jobs) == 4
    assert store.parts("fact_state") == ["20240101", "20240102"]
    first_day = written(store, "fact_state", "20240101")

    # replaying the day changes nothing
    before = sorted(map(tuple, fact.collect()), key=str)
    affected, _ = run_day(spark, place, store, 2, [posting(1, 2), posting(4, 2, **other)])
    assert affected == 0
    assert sorted(map(tuple, P.serving_fact(store).collect()), key=str) == before

    # the third day only rewrites from the second on; a row older than that is counted, not stored
    _, outcome = run_day(
        spark, place, store, 3, [posting(1, 3, deadline="Còn 5 ngày"), posting(5, 1)])
    assert outcome.late_rows == 1
    assert written(store, "fact_state", "20240101") == first_day
    assert store.parts("fact_state") == ["20240101", "20240102", "20240103"]
    assert store.read("snap_dim_job").where("dbt_valid_to is null").count() == 5

    reports = {k: [tuple(r) for r in df.collect()]
               for k, df in P.reports(store, CFG, "2024-01-03 03:00:00").items()}
    # The bridge spans every job ever seen, the report only the latest day's one job.
    assert reports["top_keywords"] == [("spark", 1, 50.0), ("sql", 1, 50.0)]
    assert reports["salary_by_experience"] == [("2 năm", 3, 1, 15.0, 10.0, 20.0)]
    assert reports["hotspots_by_location"] == [("Hà Nội", 1, 100.0)]
    assert reports["company_size_distribution"] == [("10-24 nhân viên", 1, 100.0, 2)]
    assert reports["top_companies"] == [("Acme Co-Op", "10-24", 1)]
    assert [r[1:] for r in reports["hiring_trend"]] == [(3, 15.0), (1, 15.0), (1, 15.0)]

    P.publish(spark, store)
    assert spark.sql("select count(*) n from fct_job_snapshot f join dim_date d using (date_id)"
                     ).first()["n"] == 6
    assert store.read("fact_state").count() == 6


def test_a_drop_is_read_once_and_gates_count_in_the_writes(spark, tmp_path):
    store, sc = Store(spark, f"{tmp_path}/store"), spark.sparkContext
    drops.write_drop(frame(spark, [posting(n, 1) for n in range(5)]), f"{tmp_path}/d", CFG, "20240101")
    sc.setJobGroup("gated", "a load")
    assert P.ingest(spark, CFG, store, f"{tmp_path}/d", "2024-01-01 02:00:00", run_date="20240101") == 5
    jobs = len(sc.statusTracker().getJobIdsForGroup("gated"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    # header, drop, batch (shuffle, write), its parts (shuffle, result), upsert (two shuffles, sort by bucket, write)
    assert jobs <= 10, jobs

    with pytest.raises(QualityError, match="no rows"):
        run_day(spark, str(tmp_path), store, 2, [])
    with pytest.raises(QualityError, match="1 rows without a key"):
        run_day(spark, str(tmp_path), store, 2, [posting(1, 2), posting(2, 2, job_url="  ")])
    with pytest.raises(QualityError, match="2 rows with a duplicate key"):
        run_day(spark, str(tmp_path), store, 2, [posting(1, 2), posting(1, 2), posting(1, 2), posting(3, 2)])
    with pytest.raises(QualityError, match="1 rows with missing or invalid crawled_at"):
        run_day(spark, str(tmp_path), store, 2, [posting(1, 2), posting(2, 2, crawled_at="soon")])
    drops.write_drop(frame(spark, [posting(1, 2)]).drop("title"), f"{tmp_path}/d", CFG, "20240102")
    with pytest.raises(QualityError, match="missing required columns: title"):
        P.ingest(spark, CFG, store, f"{tmp_path}/d", "2024-01-02 02:00:00", run_date="20240102")
    assert P.raw_table(store).count() == 5


def test_trend_states_follow_rewritten_days_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    facts = spark.createDataFrame(
        [("a", 1, 10.0, 20.0), ("b", 1, None, 5.0), ("a", 2, 10.0, 20.0), ("b", 2, 2.0, None), ("c", 2, 0.0, 1.0), ("d", 3, 4.0, 4.0)],
        "job_bk string, day int, lo double, hi double").select(
        "job_bk", F.expr("make_timestamp_ntz(2024, 1, day, 1, 0, 0)").alias("snapshot_ts"), (F.col("day") + 20240100).alias("date_id"),
        *[F.col(c).cast("decimal(18,2)").alias(n) for c, n in (("lo", "salary_min"), ("hi", "salary_max"))])
    days = lambda n: facts.where(F.col("date_id") <= 20240100 + n)
    P.store_facts(store, days(2).where("date_id = 20240101 or job_bk = 'c'"))
    first, second = (written(store, "trend_state", f"2024010{d}") for d in (1, 2))
    P.store_facts(store, days(3))
    assert written(store, "trend_state", "20240101") == first and written(store, "trend_state", "20240102") != second
    state = {(r["date_id"] % 100, r["job_bk"]): tuple(map(float, (r["n_paid"], r["sum_both"] or 0, r["n_both"])))
             for r in store.read("trend_state").collect()}
    assert state == {(1, "a"): (1, 30, 1), (1, "b"): (0, 0, 0), (2, "a"): (1, 30, 1), (2, "b"): (1, 0, 0), (2, "c"): (0, 0, 0),
                     (3, "d"): (1, 8, 1)}
    # d has no version today: its amount counts, the job does not
    store.overwrite("dim_job", spark.createDataFrame(
        [("a", 1, None), ("b", 2, None), ("b", 3, "2024-01-01"), ("c", 4, None)],
        "external_job_id string, job_sk int, dbt_valid_to string"))
    store.overwrite("dim_date", spark.createDataFrame([(20240101,), (20240102,), (20240103,)], "date_id int").withColumn(
        "date_day", F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")))
    rows = P.trend_report(store, CFG, "2024-01-03 03:00:00").collect()
    assert [(r["snapshot_date"].day, r["total_active_jobs"], r["avg_market_salary_mil"]) for r in rows] == [(1, 1, 0.0), (2, 2, 0.0), (3, 0, 0.0)]
    # a part that got lost, as in a run that died before it wrote the states, is made again
    from hiremart.sources import files
    files.delete(spark, f"{store.path('trend_state')}/part=20240101")
    P.store_facts(store, days(3))
    assert store.read("trend_state").count() == 6


def test_facts_are_moved_as_bytes_and_trend_states_once(spark, tmp_path, monkeypatch):
    """Shuffles before the writes of a run: digests travel as bytes, and a trend state is written where it was made."""
    key = lambda c: F.md5(F.concat(F.lit(c), F.col("id").cast("string")))
    facts = spark.range(40).withColumn("day", (F.col("id") % 2 + 1).cast("int")).select(
        F.when(F.col("id") == 7, "no digest").when(F.col("id") == 8, F.upper(key("j"))).otherwise(key("j")).alias("job_bk"),
        F.expr("make_timestamp_ntz(2024, 1, day, 1, 0, 0)").alias("snapshot_ts"), (F.col("day") + 20240100).alias("date_id"),
        F.when(F.col("id") != 9, key("c")).alias("company_bk"), key("h").alias("snapshot_hash"),
        *[F.lit(5).cast("decimal(14,2)").alias(c) for c in ("salary_min", "salary_max")])
    store, plans, kind = Store(spark, str(tmp_path)), [], type(facts)
    write = kind.write.fget
    monkeypatch.setattr(kind, "write", property(
        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)))
    P.store_facts(store, facts.where("date_id = 20240101"))
    P.store_facts(store, facts)
    for state, trend in (plans[:2], plans[2:]):
        assert "unhex" in state and state.count("REBALANCE") == 1
        assert "unhex" in trend and trend.count("Exchange") == 1
    assert sorted(map(str, store.read("fact_state").select(*facts.columns).collect())) == sorted(map(str, facts.collect()))
    assert {r["job_bk"] for r in store.read("trend_state").collect()} == {r["job_bk"] for r in facts.collect()}


def test_violations_stop_a_strict_run(spark, tmp_path):
    bad = [posting(1, 1, salary="25 - 18 triệu")]
    store = Store(spark, f"{tmp_path}/a")
    with pytest.raises(QualityError, match="expression_is_true"):
        run_day(spark, str(tmp_path), store, 1, bad)
    with pytest.raises(QualityError, match="stale"):
        P.transform(spark, CFG, store, "2024-01-04 03:00:00")


def test_gates_refuse_a_drop(spark, tmp_path):
    store, folder = Store(spark, f"{tmp_path}/store"), f"{tmp_path}/drops"
    twice = [posting(1, 1), posting(1, 1, title="again")]
    with pytest.raises(QualityError, match="duplicate"):
        run_day(spark, str(tmp_path), store, 1, twice)
    with pytest.raises(QualityError, match="crawled_at"):
        run_day(spark, str(tmp_path), store, 1, [posting(1, 1, crawled_at="soon")])
    assert not store.exists("raw")
    with pytest.raises(ValueError, match="no drop for run date"):
        drops.find_drop(spark, folder, CFG, "20240109")
    assert drops.find_drop(spark, folder, CFG).endswith("jobs_20240101.csv")
    with pytest.raises(ValueError, match="YYYYMMDD"):
        drops.write_drop(frame(spark, twice), folder, CFG, "2024-01-01")


def test_last_duplicate_of_a_file_wins(spark, tmp_path):
    path = f"{tmp_path}/jobs_20240101.csv"
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        out.write("title,job_url,crawled_at,extra\n")
        out.write('first, https://j/1 ,2024-01-01 01:00:00,x\n"two\nlines",https://j/2,'
                  '2024-01-01 01:00:00,\nlast,https://j/1,2024-01-01 00:30:00,\n,,,\n')
    drop = drops.read_drop(spark, path)
    assert drop.columns[0] == "title"
    batch = {r["job_url"]: r for r in drops.prepare_batch(drop).collect()}
    assert set(batch) == {"https://j/1", "https://j/2"}
    assert batch["https://j/1"]["title"] == "last" and batch["https://j/2"]["title"] == "two\nlines"
    assert batch["https://j/1"]["salary"] is None
    store = Store(spark, f"{tmp_path}/store")
    assert P.load(spark, store, drop, "2024-01-01 02:00:00") == 2


def test_a_batch_with_an_unusable_crawl_time_is_no_result(spark, tmp_path):
    """Without any gate before it: the job fails, whichever columns are read and also where a later row replaces the bad one."""
    folders = (f"{tmp_path}/{n}" for n in range(9))

    def drop(*rows, without=()):
        return drops.read_drop(spark, drops.write_drop(frame(spark, rows).drop(*without), next(folders), CFG, "20240101"))

    good, late = posting(1, 1), posting(2, 1, crawled_at="soon")
    for bad in (drop(good, late), drop(late, posting(2, 1)), drop(good, posting(3, 1, crawled_at=None)), drop(good, without=["crawled_at"])):
        for read in (DataFrame.collect, DataFrame.count, lambda batch: batch.select("title").collect()):
            with pytest.raises(Exception, match="rows with missing or invalid crawled_at: https://j.example/viec-lam/x/"):
                read(drops.prepare_batch(bad))
        with pytest.raises(QualityError, match="rows with missing or invalid crawled_at"):
            P.load(spark, Store(spark, f"{tmp_path}/store"), bad, "2024-01-01 02:00:00")
    unlinked = drop(good, posting(4, 1, job_url=" ", crawled_at="soon"), posting(5, 1, job_url=None, crawled_at=None))
    assert [r["crawled_at"] for r in drops.prepare_batch(unlinked).collect()] == [datetime(2024, 1, 1, 1)]
    assert drops.prepare_batch(drop(good).where("false").drop("crawled_at")).count() == 0


def test_store(spark, tmp_path):
    store, part = Store(spark, str(tmp_path)), F.col("d")
    assert not store.exists("t") and store.read("t", schema="d int").count() == 0
    store.replace("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "d int, v string"), part)
    kept = written(store, "t", "1")
    store.replace("t", spark.createDataFrame([(2, "c", 9)], "d int, v string, w int"), part, ["2", "3"])
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "a", None), (2, "c", 9)]
    assert written(store, "t", "1") == kept and store.parts("t") == ["1", "2"]
    assert [r["v"] for r in store.read("t", ["2"]).collect()] == ["c"]
    store.replace("t", store.read("t", ["2"]).withColumn("v", F.lit("again")), part)  # a part may be read and replaced
    assert [r["v"] for r in store.read("t", ["2"]).collect()] == ["again"]
    with pytest.raises(ValueError):
        store.read("missing")
    assert store.read("t", []).select(F.count("*")).first()[0] == 0
    empty = spark.createDataFrame([], "a int")
    assert store.overwrite("whole", empty).columns == ["a"] and store.exists("whole")


def test_load_leaves_other_buckets_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = [posting(n, 1) for n in range(120)]
    drop = lambda some: drops.read_drop(spark, drops.write_drop(frame(spark, some), f"{tmp_path}/d", CFG, "20240101"))
    assert P.load(spark, store, drop(rows), "2024-01-01 02:00:00") == 120
    before = {p: written(store, "raw", p) for p in store.parts("raw")}
    assert len(before) > 10
    assert P.load(spark, store, drop([posting(7, 2, title="other"), posting(7_000, 2)]), "2024-01-02 02:00:00") == 2
    changed = {p for p, names in before.items() if written(store, "raw", p) != names}
    assert 1 <= len(changed) <= 2
    raw = P.raw_table(store)
    assert raw.count() == 121 and raw.where("title = 'other'").count() == 1
    assert raw.where("created_at = timestamp_ntz'2024-01-01 02:00:00'").count() == 120


def test_load_of_a_table_with_older_columns_or_none_changed(spark, tmp_path):
    """Parts that lack a column read as missing there; a drop without news rewrites its own buckets only."""
    store = Store(spark, str(tmp_path))
    one = drops.read_drop(spark, drops.write_drop(frame(spark, [posting(1, 1)]), f"{tmp_path}/d", CFG, "20240101"))
    P.load(spark, store, one, "2024-01-01 02:00:00")
    part, = store.parts("raw")
    old = P.raw_table(store).drop("tags")
    old.write.mode("overwrite").parquet(f"{tmp_path}/old")
    spark.read.parquet(f"{tmp_path}/old").write.mode("overwrite").parquet(f"{store.path('raw')}/part={part}")
    assert P.raw_table(store).first()["tags"] is None
    assert P.load(spark, store, one, "2024-01-02 02:00:00") == 1
    assert P.raw_table(store).first()["tags"] == "SQL; Spark"
    assert P.load(spark, store, one, "2024-01-03 02:00:00") == 0


def test_duplicates_of_a_stored_table_stop_the_write_and_go(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    drop = lambda some: drops.read_drop(spark, drops.write_drop(frame(spark, some), f"{tmp_path}/d", CFG, "20240101"))
    P.load(spark, store, drop([posting(n, 1) for n in range(40)]), "2024-01-01 02:00:00")
    P.raw_table(store).withColumn("crawled_at", F.expr("crawled_at - interval 1 day")).withColumn(
        "part", P.bucket("job_url", CFG.buckets)).write.mode("append").partitionBy("part").parquet(store.path("raw"))
    assert P.raw_table(store).count() == 80
    assert P.load(spark, store, drop([posting(n, 2) for n in range(40)]), "2024-01-02 02:00:00") == 40
    raw = P.raw_table(store)
    assert raw.count() == 40 and raw.select("job_url").distinct().count() == 40


def test_history_rewrites_changed_buckets_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    at = lambda day: F.lit(f"2024-01-0{day} 01:00:00").cast("timestamp_ntz")
    source = lambda day, ids, news: spark.range(ids).where("id <> 5" if day > 1 else "true").select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id").isin(*news), at(day)).otherwise(at(1)).alias("updated_at"),
        F.lit(day).alias("v"))
    run = lambda day, *some: P._snapshot(spark, store, "h", source(day, *some), "k", f"2024-01-0{day} 03:00:00", 16)
    assert run(1, 200, [999]).count() == 200
    before = {p: written(store, "h", p) for p in store.parts("h")}
    history = run(2, 201, [7])  # 5 goes, 7 changes, 200 is new
    changed = {p for p, names in before.items() if written(store, "h", p) != names}
    assert 1 <= len(changed) <= 3 and history.count() == 202
    assert sorted(r["k"] for r in history.where("dbt_valid_to is not null").collect()) == ["5", "7"]
    again = {p: written(store, "h", p) for p in store.parts("h")}
    assert run(2, 201, [7]).count() == 202 and {p: written(store, "h", p) for p in store.parts("h")} == again
