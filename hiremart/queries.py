"""Named queries over the driver tables: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Results are given in plain types (integers as bigint, decimals as double, dates and times as text)
so that they compare with any SQL engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hiremart.config import POSTING_COLUMNS, REQUIRED_COLUMNS, UPDATE_COLUMNS, Config
from hiremart.functions.keys import is_job_url, url_path
from hiremart.functions.salary import with_salary
from hiremart.functions.text import clean_title, extract_deadline, initcap_words, squash
from hiremart.operators import extract as X, quality as Q
from hiremart.operators.aggregate import with_share
from hiremart.operators.dedup import latest_per_key, purge_duplicates
from hiremart.operators.scd2 import open_versions, scd2_merge
from hiremart.operators.upsert import upsert
from hiremart.plans import checks as K, intermediate as I, marts as M, pipeline, reports as R
from hiremart.plans.staging import GRAIN, salary_failures, stg_postings
from hiremart.sources import drops
from hiremart.sources.files import COMPACT
from hiremart.sources.fixture import postings, read
from hiremart.sources.fixture_pages import company_pages, detail_pages, listing_pages
from hiremart.sources.scratch import Scratch
from hiremart.sources.store import Store, bucket
from hiremart.streaming import incremental as INC

Query = Callable[[SparkSession, str], DataFrame]
CFG = Config()
AS_WRITTEN = Config(regex_mode="as_written")
AS_OF = "2024-01-06 03:00:00"
DAYS = range(1, 6)

_REGISTRY: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    def cast(field: T.StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col.cast("string").alias(field.name)
        if isinstance(kind, T.IntegerType):
            return col.cast("bigint").alias(field.name)
        return col

    return df.select(*[cast(f) for f in df.schema])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(spark, sf_dir))

    _REGISTRY[fn.__name__] = run
    return run


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _mart(spark: SparkSession, sf_dir: str, cfg: Config = CFG) -> M.Mart:
    return M.Mart(postings(spark, sf_dir), cfg)


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_postings(postings(spark, sf_dir), CFG)


def _events(spark: SparkSession, sf_dir: str, cfg: Config = CFG) -> DataFrame:
    return I.int_job_snapshot_events(stg_postings(postings(spark, sf_dir), cfg), cfg)


# ---- staging and intermediate models

@query
def stg_postings_model(spark, sf_dir):
    return _stg(spark, sf_dir)


@query
def salary_parse(spark, sf_dir):
    texts = postings(spark, sf_dir).select(
        "job_url", "crawled_at", "salary", F.col("salary").alias("_text"))
    return with_salary(texts, "_text", CFG.usd_rate).withColumnRenamed(
        "salary_multiplier", "multiplier").drop("salary_failed")


@query
def salary_failed(spark, sf_dir):
    return salary_failures(postings(spark, sf_dir), CFG)


@query
def salary_failed_texts(spark, sf_dir):
    """Failures among salaries of which some are too large and some malformed."""
    link = F.col("job_url")
    texts = F.when(link.contains("3.html"), "1234567890123456789012 triệu").when(link.contains("5.html"), "1.2.3 triệu")
    return salary_failures(postings(spark, sf_dir).withColumn("salary", texts.otherwise(F.col("salary"))), CFG)


@query
def event_shape(spark, sf_dir):
    return _events(spark, sf_dir).select(
        *GRAIN, "company_bk", "snapshot_date_id", "deadline_date", "salary_avg", "snapshot_hash")


@query
def explode_tags(spark, sf_dir):
    return I.int_job_tags(_events(spark, sf_dir), CFG)


@query
def explode_locations(spark, sf_dir):
    return I.int_job_locations(_events(spark, sf_dir), CFG)


@query
def explode_tags_as_written(spark, sf_dir):
    return I.int_job_tags(_events(spark, sf_dir, AS_WRITTEN), AS_WRITTEN)


@query
def explode_locations_as_written(spark, sf_dir):
    return I.int_job_locations(_events(spark, sf_dir, AS_WRITTEN), AS_WRITTEN)


@query
def latest_job(spark, sf_dir):
    return I.int_job_snapshot_source(_stg(spark, sf_dir))


@query
def latest_company(spark, sf_dir):
    return I.int_company_snapshot_source(_stg(spark, sf_dir))


# ---- raw table

def _day(df: DataFrame, at: str, first: int, last: int | None = None) -> DataFrame:
    return df.where(F.col(at).between(
        _ts(f"2024-01-0{first} 00:00:00"), _ts(f"2024-01-0{last or first} 23:59:59")))


@query
def upsert_raw(spark, sf_dir):
    """Three loads: the first day, the three after it, then the fifth."""
    raw = postings(spark, sf_dir).withColumn("job_url", F.trim("job_url")).where(
        F.col("job_url") != "")
    target = spark.createDataFrame([], drops.RAW_SCHEMA)
    scratch = Scratch(spark)
    for first, last in ((1, 1), (2, 4), (5, 5)):
        batch = latest_per_key(_day(raw, "crawled_at", first, last), ["job_url"], "crawled_at")
        merged = upsert(target, batch, "job_url", UPDATE_COLUMNS, "crawled_at", "created_at",
                        _ts(f"2024-01-0{last} 02:00:00"))
        merged = scratch.stage(merged)
        target = merged.drop("_action")
    return merged.select(*POSTING_COLUMNS, "created_at", F.col("_action").alias("action"))


@query
def purge_duplicate_rows(spark, sf_dir):
    raw = postings(spark, sf_dir).where(F.trim("job_url") != "")
    return purge_duplicates(raw, "job_url", ["crawled_at"], "crawled_at")


@query
def load_batch(spark, sf_dir):
    """Drops of two days; the one asked for by run date, prepared for loading: last row per link."""
    folder = Scratch(spark).path("drops")
    raw = postings(spark, sf_dir)
    drops.write_drop(_day(raw, "crawled_at", 1), folder, CFG, "20240101")
    # Later crawls further down. There are as many tasks as ranges, so a day must not be one: links split it.
    drops.write_drop(raw.orderBy("crawled_at", "job_url"), folder, CFG, "20240105")
    drops.write_drop(_day(raw, "crawled_at", 2), folder, CFG, "20240109")
    return drops.prepare_batch(drops.read_drop(spark, drops.find_drop(spark, folder, CFG, "20240105")))


@query
def newest_drop(spark, sf_dir):
    """Rows per crawl day of the drop picked without a run date: today's, else the newest by name."""
    folder = Scratch(spark).path("drops")
    raw = postings(spark, sf_dir)
    for day in (2, 4, 3):
        drops.write_drop(_day(raw, "crawled_at", day), folder, CFG, f"2024010{day}")
    picked = [drops.read_drop(spark, drops.find_drop(spark, folder, CFG, today=today))
              for today in ("20240103", "20240109")]
    counts = [d.groupBy(F.substring("crawled_at", 1, 10).alias("day")).agg(F.count("*").alias("n_rows"))
              for d in picked]
    return counts[0].unionByName(counts[1])


@query
def load_gates(spark, sf_dir):
    """Both gates of a drop that lacks two columns and some crawl times."""
    damaged = F.when(~F.col("job_url").contains("7.html"), F.col("crawled_at").cast("string")).otherwise("soon")
    drop = postings(spark, sf_dir).drop("salary", "tags").withColumn("crawled_at", damaged)
    gate = Q.raw_gate(drop, [*REQUIRED_COLUMNS, "salary", "tags"], "job_url")
    return gate.crossJoin(drops.bad_crawl_times(drop).withColumnRenamed("n", "bad_crawl_times"))  # one row each


@query
def schema_sync(spark, sf_dir):
    """An incremental run whose stored state lacks a column and has one that is gone, with stale rows."""
    state = M.fact_state(_events(spark, sf_dir), CFG)
    stored = _day(state, "snapshot_ts", 1, 4).drop("salary_avg").withColumn("old_column", F.lit(1)).withColumn(
        "salary_currency", F.lit("stale"))
    mark = INC.high_water_mark(stored, "snapshot_ts")
    merged = INC.delete_insert(stored, INC.on_or_after(state, "snapshot_ts", mark), GRAIN)
    return merged.groupBy("date_id", "salary_currency").agg(
        F.count("*").alias("n_rows"), F.count("salary_avg").alias("n_averages"))


@query
def csv_round_trip(spark, sf_dir):
    """Write the postings as a drop, read it back, and type it for loading."""
    folder = Scratch(spark).path("drops")
    path = drops.write_drop(postings(spark, sf_dir), folder, CFG, "20240105")
    back = drops.read_drop(spark, path)
    return back.where(F.trim("job_url") != "").select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in POSTING_COLUMNS if c != "crawled_at"],
        F.col("crawled_at").try_cast("timestamp_ntz").alias("crawled_at"))


def _stored(spark: SparkSession, sf_dir: str, days: tuple[int, ...], store: Store, transform: bool) -> None:
    """The daily run over the drops of some days, as a scheduler would start it."""
    raw, folder = postings(spark, sf_dir).where(F.trim("job_url") != ""), store.path("drops")
    for day in days:
        drops.write_drop(_day(raw, "crawled_at", day), folder, CFG, f"2024010{day}")
        pipeline.ingest(spark, CFG, store, folder, f"2024-01-0{day} 02:00:00", run_date=f"2024010{day}")
        if transform:
            pipeline.transform(spark, CFG, store, f"2024-01-0{day} 03:00:00", strict=False)


@query
def stored_days(spark, sf_dir):
    """Two daily runs over stored tables: facts of both days with today's job version and place, and their job's versions."""
    store = Store(spark, Scratch(spark).path("store"))
    _stored(spark, sf_dir, (1, 2), store, transform=True)
    jobs, places = store.read("dim_job"), store.read("dim_location")
    versions = store.read("snap_dim_job").groupBy(F.col("job_bk").alias("external_job_id")).agg(
        F.count("*").alias("n_versions"), F.count("dbt_valid_to").alias("n_closed"))
    today = jobs.join(versions, "external_job_id").select("job_sk", "external_job_id", "title", "dbt_valid_from", "n_versions", "n_closed")
    return pipeline.serving_fact(store).join(today, "job_sk", "left").join(
        places.select("location_id", "location_code"), "location_id", "left").select(
        "job_bk", "snapshot_ts", "date_id", "salary_avg", "snapshot_hash", "external_job_id", "title", "dbt_valid_from",
        "n_versions", "n_closed", "location_code")


@query
def stored_load(spark, sf_dir):
    """A stored raw table that holds rows twice, the older ones stale, after the load of the next day."""
    store = Store(spark, Scratch(spark).path("store"))
    _stored(spark, sf_dir, (1,), store, transform=False)
    stale = pipeline.raw_table(store).withColumns({"crawled_at": F.expr("crawled_at - interval 1 hour"), "salary": F.lit("stale")})
    stale.withColumn("part", bucket("job_url", CFG.buckets)).write.mode("append").partitionBy("part").parquet(store.path("raw"))
    _stored(spark, sf_dir, (2,), store, transform=False)
    return pipeline.raw_table(store).select("job_url", "title", "salary", "tags", "crawled_at", "created_at")


@query
def stored_checks(spark, sf_dir):
    """What the layers' checks find in a stored run that does not stop at them."""
    store, folder = Store(spark, Scratch(spark).path("store")), Scratch(spark).path("drops")
    drops.write_drop(_day(postings(spark, sf_dir), "crawled_at", 3).where(F.trim("job_url") != ""), folder, CFG, "20240103")
    pipeline.ingest(spark, CFG, store, folder, "2024-01-03 02:00:00", run_date="20240103")
    outcome = pipeline.transform(spark, CFG, store, "2024-01-05 03:00:00", strict=False)
    found = [outcome.freshness, f"late {outcome.late_rows}", f"salary {outcome.salary_failures}", *outcome.failed_checks]
    return spark.createDataFrame([(line,) for line in found], "finding string")  # a line for each declared check at most


@query
def published_marts(spark, sf_dir):
    """SQL over the views of a stored day's marts."""
    store = Store(spark, Scratch(spark).path("store"))
    _stored(spark, sf_dir, (1,), store, transform=True)
    pipeline.publish(spark, store)
    return spark.sql("""
        select d.date_day, l.location_name, t.tag_name, count(*) as n_facts, count(distinct c.company_id) as n_companies
        from fct_job_snapshot f join dim_date d using (date_id) join dim_location l using (location_id)
        join dim_company c using (company_sk) join bridge_job_tags b using (job_sk) join dim_tag t using (tag_id)
        group by all""")


@query
def upsert_new_columns(spark, sf_dir):
    """A load into a table that lacks two of the columns."""
    raw = postings(spark, sf_dir).withColumn("job_url", F.trim("job_url")).where("job_url <> ''")
    older = latest_per_key(_day(raw, "crawled_at", 1, 4), ["job_url"], "crawled_at").drop("tags", "company_size")
    batch = latest_per_key(_day(raw, "crawled_at", 5), ["job_url"], "crawled_at")
    merged = upsert(older.withColumn("created_at", _ts("2024-01-04 02:00:00")), batch, "job_url", UPDATE_COLUMNS, "crawled_at",
                    "created_at", _ts("2024-01-05 02:00:00"))
    return merged.select("job_url", "title", "tags", "company_size", "crawled_at", "created_at")


@query
def dq_raw_gate(spark, sf_dir):
    return Q.raw_gate(postings(spark, sf_dir), REQUIRED_COLUMNS, "job_url")


# ---- type-2 history

def _daily_history(spark, sf_dir, key: str, source, last: int) -> DataFrame:
    """Run the merge once per day, each day's crawl being the whole source."""
    scratch = Scratch(spark)
    stg = scratch.stage(_stg(spark, sf_dir))
    history = open_versions(source(_day(stg, "snapshot_ts", 1)), key, "updated_at")
    for day in range(2, last + 1):
        # Each run reads what the one before wrote, as in production: the plan does not grow.
        history = scd2_merge(
            scratch.stage(history), source(_day(stg, "snapshot_ts", day)), key, "updated_at",
            _ts(f"2024-01-0{day} 03:00:00"))
    return history


@query
def scd2_first(spark, sf_dir):
    return _daily_history(spark, sf_dir, "job_bk", I.int_job_snapshot_source, 1)


@query
def scd2_second(spark, sf_dir):
    return _daily_history(spark, sf_dir, "job_bk", I.int_job_snapshot_source, 2)


@query
def scd2_hard_delete(spark, sf_dir):
    return _daily_history(spark, sf_dir, "job_bk", I.int_job_snapshot_source, 5)


@query
def scd2_company(spark, sf_dir):
    return _daily_history(spark, sf_dir, "company_bk", I.int_company_snapshot_source, 5)


@query
def scd2_orders(spark, sf_dir):
    """History of each customer's latest order over two runs: up to 1996, then up to the end."""
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("updated_at"))

    def source(df: DataFrame) -> DataFrame:
        return latest_per_key(df, ["o_custkey"], "updated_at", ["o_orderkey"])

    early = source(orders.where(F.col("updated_at") < _ts("1996-01-01 00:00:00")))
    history = open_versions(early, "o_custkey", "updated_at")
    return scd2_merge(
        history, source(orders), "o_custkey", "updated_at", _ts("2000-01-01 00:00:00"))


# ---- star schema

@query
def dim_job(spark, sf_dir):
    return _mart(spark, sf_dir).dim_job


@query
def dim_company(spark, sf_dir):
    return _mart(spark, sf_dir).dim_company


@query
def dim_date(spark, sf_dir):
    return M.dim_date(_events(spark, sf_dir), CFG)


@query
def dim_date_as_written(spark, sf_dir):
    return M.dim_date(_events(spark, sf_dir, AS_WRITTEN), AS_WRITTEN)


@query
def dim_location(spark, sf_dir):
    return M.dim_location(I.int_job_locations(_events(spark, sf_dir), CFG), Scratch(spark))


@query
def dim_tag(spark, sf_dir):
    return M.dim_tag(I.int_job_tags(_events(spark, sf_dir), CFG), Scratch(spark))


@query
def dim_source(spark, sf_dir):
    """The source dimension with the postings each source gave."""
    seen = _stg(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("n_postings"))
    return M.dim_source(spark, CFG).join(seen, "source_id", "left")


@query
def bridge_job_tags(spark, sf_dir):
    return _mart(spark, sf_dir).bridge_job_tags


@query
def fct_full(spark, sf_dir):
    return _mart(spark, sf_dir).fct_job_snapshot


@query
def fct_incremental(spark, sf_dir):
    """State of the first four days, then an incremental run over all events."""
    mart = _mart(spark, sf_dir)
    state = M.fact_state(mart.events, CFG)
    stored = _day(state, "snapshot_ts", 1, 4)
    mark = INC.high_water_mark(stored, "snapshot_ts")
    merged = INC.delete_insert(stored, INC.on_or_after(state, "snapshot_ts", mark), GRAIN)
    return M.fct_job_snapshot(merged, mart.dim_job, mart.dim_company, mart.dim_location)


@query
def fct_incremental_stale(spark, sf_dir):
    """An incremental run over a stored state of which some rows are stale: those at the mark heal, older ones stay."""
    state = M.fact_state(_events(spark, sf_dir), CFG)
    stale = F.when(F.col("job_bk").startswith("a"), F.lit(1).cast(state.schema["salary_avg"].dataType)).otherwise(F.col("salary_avg"))
    stored = _day(state, "snapshot_ts", 1, 4).withColumn("salary_avg", stale)
    mark = INC.high_water_mark(stored, "snapshot_ts")
    merged = INC.delete_insert(stored, INC.on_or_after(state, "snapshot_ts", mark), GRAIN)
    return merged.select("job_bk", "snapshot_ts", "date_id", "salary_avg")


@query
def late_rows(spark, sf_dir):
    """Events an incremental run skips when the state holds the third day only."""
    state = M.fact_state(_events(spark, sf_dir), CFG)
    stored = _day(state, "snapshot_ts", 3)
    mark = INC.high_water_mark(stored, "snapshot_ts")
    return INC.late_rows(state, stored, GRAIN, "snapshot_ts", mark).groupBy("date_id").agg(
        F.count("*").alias("n_late"))


# ---- reports

@query
def report_keywords(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.top_keywords(m.fct_job_snapshot, m.bridge_job_tags, m.dim_tag)


@query
def report_salary(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.salary_by_experience(m.fct_job_snapshot, m.dim_job)


@query
def report_hotspots(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.hotspots_by_location(m.fct_job_snapshot, m.dim_location)


@query
def report_hotspots_cities(spark, sf_dir):
    """The same over places of every label."""
    places = ["Hồ Chí Minh; quận 1", "ha noi", "Đà Nẵng", "can tho", "Bình Dương", "dong nai", "Hải Phòng", "bac ninh", "TP Vũng Tàu",
              "thai nguyen", "Huế", "Remote", "từ xa", "Nha Trang"]
    number = F.regexp_extract("job_url", "/x/([0-9]+)", 1).try_cast("int") % len(places)
    m = M.Mart(postings(spark, sf_dir).withColumn("working_addresses", F.get(F.array(*map(F.lit, places)), number)), CFG)
    return R.hotspots_by_location(m.fct_job_snapshot, m.dim_location)


@query
def report_company_size(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.company_size_distribution(m.fct_job_snapshot, m.dim_company)


@query
def report_top_companies(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.top_companies(m.fct_job_snapshot, m.dim_company)


@query
def report_trend(spark, sf_dir):
    m = _mart(spark, sf_dir)
    return R.hiring_trend(m.fct_job_snapshot, m.dim_date, _ts(AS_OF).cast("date"))


@query
def stored_trend(spark, sf_dir):
    """The trend from stored day states; the first run saw half of its newest day's jobs, with other amounts."""
    mart, store = _mart(spark, sf_dir), Store(spark, Scratch(spark).path("store"))
    state = M.fact_state(mart.events, CFG)
    newest = F.col("snapshot_ts") >= _ts("2024-01-02")
    half = _day(state, "snapshot_ts", 1, 2).where(~newest | (F.col("job_bk") < "8")).withColumn(
        "salary_max", F.when(newest, F.col("salary_min")).otherwise(F.col("salary_max")))
    for run in (half, _day(state, "snapshot_ts", 1, 4), state):
        pipeline.store_facts(store, run)
    store.overwrite("dim_job", mart.dim_job)
    store.overwrite("dim_date", mart.dim_date)
    return pipeline.trend_report(store, CFG, AS_OF)


# ---- data quality

@query
def dq_not_null(spark, sf_dir):
    return Q.not_null(postings(spark, sf_dir), POSTING_COLUMNS)


@query
def dq_unique(spark, sf_dir):
    raw = postings(spark, sf_dir)
    return Q.union_checks([Q.unique(raw, c) for c in ("job_url", "company_url", "title")])


@query
def dq_unique_combo(spark, sf_dir):
    return Q.unique_combination(
        postings(spark, sf_dir).withColumn("key", F.lower(F.trim("job_url"))),
        ["key", "crawled_at"])


@query
def dq_relationships(spark, sf_dir):
    """Order lines whose part is not among the parts of the first brand."""
    parts = read(spark, sf_dir, "part").where(F.col("p_brand") == "Brand#1")
    return Q.relationships(read(spark, sf_dir, "lineitem"), "l_partkey", parts, "p_partkey")


@query
def dq_expression(spark, sf_dir):
    return Q.expression_is_true(_stg(spark, sf_dir), F.expr(K.SALARY_RANGE), "salary_range")


@query
def dq_freshness(spark, sf_dir):
    return INC.freshness(
        postings(spark, sf_dir), "crawled_at", _ts(AS_OF), CFG.warn_hours, CFG.error_hours)


def _tables(spark: SparkSession, sf_dir: str, scratch: Scratch) -> Callable[[str], DataFrame]:
    """The tables of a full build by name; those that cost most are written once."""
    raw = postings(spark, sf_dir)
    mart = M.Mart(raw, CFG, scratch)
    attr = {
        "stg_postings": "stg", "int_job_snapshot_events": "events", "int_job_tags": "tags",
        "int_job_locations": "locations", "int_company_snapshot_source": "company_source",
        "int_job_snapshot_source": "job_source",
    }
    staged = {"raw": raw}

    def table(name: str) -> DataFrame:
        if name not in staged:
            built = getattr(mart, attr.get(name, name))
            once = name in ("bridge_job_tags", "fct_job_snapshot", "int_company_snapshot_source",
                            "int_job_snapshot_source", "snap_dim_job", "snap_dim_company")
            staged[name] = scratch.stage(built) if once else built
            setattr(mart, attr.get(name, name), staged[name])  # what descends from it reads the copy
        return staged[name]

    return table


@query
def dq_suite(spark, sf_dir):
    """Every declared check over a full build."""
    return K.report(K.ALL, _tables(spark, sf_dir, Scratch(spark)))


@query
def dq_suite_damaged(spark, sf_dir):
    """Every declared check over tables with repeated rows, rows without required values and rows without parents."""
    sound, damaged = _tables(spark, sf_dir, Scratch(spark, **COMPACT)), {}

    def table(name: str) -> DataFrame:
        if name not in damaged:
            damaged[name] = _damaged(sound(name), K.ALL[name])
        return damaged[name]

    return K.report(K.ALL, table)


def _damaged(df: DataFrame, checks: K.Checks) -> DataFrame:
    """Each row, and by its first required value again, again without required values, again with foreign keys that are none.

    Copies are made while the table is read, in one scan. They are not stored: a check reads few of the columns.
    """
    key = F.col(checks.not_null[0]).cast("string")
    kinds = ("1", "2", "3") if checks.relationships else ("1", "2")
    bits = sum((F.when(key.contains(k), F.lit(1 << n)).otherwise(F.lit(0)) for n, k in enumerate(kinds)), F.lit(0))
    copies = F.array(*[F.array(*[F.lit(n) for n in range(4) if n == 0 or some >> n - 1 & 1]) for some in range(8)])
    rows = df.select("*", F.explode(F.get(copies, bits)).alias("_copy"))
    changed = {c: F.col(c) for c in (*checks.not_null, *checks.relationships)}
    for c in checks.relationships:
        changed[c] = F.when(F.col("_copy") == 3, (-1 - F.col(c)).cast(df.schema[c].dataType)).otherwise(changed[c])
    for c in checks.not_null:
        changed[c] = F.when(F.col("_copy") != 2, changed[c])
    return rows.withColumns(changed).drop("_copy")


# ---- scalar operators at table size

@query
def url_class(spark, sf_dir):
    jobs = postings(spark, sf_dir).select(F.trim("job_url").alias("url"))
    brands = read(spark, sf_dir, "orders").select(F.concat(
        F.lit("/brand/b"), (F.col("o_orderkey") % 7).cast("string"), F.lit("/tuyen-dung/role-j"),
        F.col("o_custkey").cast("string"), F.lit(".html?from=list")).alias("url"))
    pages = read(spark, sf_dir, "pages").select("url")
    return jobs.unionByName(brands).unionByName(pages).select(
        "url", url_path("url").alias("path"), is_job_url("url").alias("is_job"))


@query
def title_clean(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    noisy = F.when(F.col("p_partkey") % 11 == 0, F.lit(" HOT  ✨")).otherwise(
        F.concat(F.lit(" HOT "), F.col("p_name"), F.lit("  ✨ "), F.col("p_brand"), F.lit(" ")))
    return part.select("p_partkey", clean_title(noisy).alias("title"))


@query
def deadline_extract(spark, sf_dir):
    noted = F.concat(F.lit("Hạn nộp: "), F.col("deadline"), F.lit(" (24h)"))
    return postings(spark, sf_dir).select(
        "job_url", "crawled_at", extract_deadline(noted).alias("deadline"))


@query
def initcap_text(spark, sf_dir):
    return postings(spark, sf_dir).select(
        "job_url", "crawled_at", initcap_words("working_addresses").alias("place"),
        initcap_words(F.concat_ws("-", "company_website", "tags")).alias("label"))


@query
def explode_document_lines(spark, sf_dir):
    """Distinct non-blank lines of each document."""
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda line: squash(line)), lambda line: line != "")
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(F.array_distinct(lines)).alias("line"))


@query
def share_of_total(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count_distinct("l_orderkey").alias("order_count"))
    return with_share(counts, "order_count", "share_percent")


@query
def latest_event(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"])


# ---- page extraction

@query
def extract_pages(spark, sf_dir):
    return X.page_outline(read(spark, sf_dir, "pages"))


@query
def extract_listing(spark, sf_dir):
    return X.extract_listing(listing_pages(postings(spark, sf_dir)), CFG)


@query
def listing_dedup(spark, sf_dir):
    """First card per job path over all listing pages."""
    cards = X.extract_listing(listing_pages(postings(spark, sf_dir)), CFG)
    return X.dedup_cards(cards).select("page_id", "job_url", "title", "salary")


@query
def extract_detail(spark, sf_dir):
    return X.extract_detail(detail_pages(postings(spark, sf_dir)))


@query
def extract_company(spark, sf_dir):
    return X.extract_company(company_pages(spark, sf_dir))


@query
def extract_all_days(spark, sf_dir):
    """Listing, card dedup, newest detail page, company page and merge over the pages of all days."""
    raw = postings(spark, sf_dir)
    return X.extract_records(listing_pages(raw), detail_pages(raw), company_pages(spark, sf_dir), CFG,
                             F.lit("2024-01-06 00:00:00"), Scratch(spark))


@query
def merge_record(spark, sf_dir):
    """Cards of the fifth day with details of the fourth and the companies' own pages."""
    raw = postings(spark, sf_dir).withColumn("job_url", F.trim("job_url")).where(
        F.col("job_url") != "")
    cards = _day(raw, "crawled_at", 5).select(
        "job_url", "title", "salary", F.col("location").alias("address_list"),
        F.col("experience").alias("exp_list"), F.lit("card co").alias("company"), "company_url")
    details = _day(raw, "crawled_at", 4).where(F.col("title").isNotNull()).select(
        "job_url", "title", "salary", "location", F.lit(None).cast("string").alias("experience"),
        "deadline", "tags", "desc_mota", "desc_yeucau", "desc_quyenloi", "working_addresses",
        "working_times", F.lit("https://other.example/c").alias("company_url_from_job"),
        F.lit(" ").alias("company_name_full"), "company_website", "company_size",
        "company_followers", "company_industry", "company_address")
    companies = X.extract_company(company_pages(spark, sf_dir))
    return X.merge_records(cards, details, companies, F.lit("2024-01-06 00:00:00"))


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)
