"""The daily run: load a drop, then rebuild history and marts, checking after every layer."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from hiremart.config import POSTING_COLUMNS, REQUIRED_COLUMNS, UPDATE_COLUMNS, Config
from hiremart.operators.dedup import purge_duplicates
from hiremart.functions.keys import packed_key
from hiremart.functions.salary import with_salary
from hiremart.operators.quality import QualityError, require_clean, require_counts
from hiremart.operators.scd2 import merge_open, open_versions
from hiremart.operators.upsert import KEEP, upsert
from hiremart.plans import checks as K, intermediate as I, marts as M, reports as R
from hiremart.plans.staging import GRAIN, stg_postings
from hiremart.sources.drops import (
    RAW_SCHEMA, drop_counters, find_drop, prepare_batch, read_drop, require_crawl_times)
from hiremart.sources.files import COMPACT
from hiremart.sources.scratch import Scratch
from hiremart.sources.store import PART, Store, bucket, values_of
from hiremart.streaming import incremental as INC

RAW, STATE, TREND, FACT = "raw", "fact_state", "trend_state", "fct_job_snapshot"
SLOTS = 64  # files that the trend state of a large day has at most
TWICE = "two rows of one job_url in the raw table"


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def ingest(spark: SparkSession, cfg: Config, store: Store, folder: str, now: str,
           run_date: str | None = None, today: str | None = None) -> int:
    """Gate one drop and upsert it into the raw table; returns rows inserted or updated."""
    drop = read_drop(spark, find_drop(spark, folder, cfg, run_date, today))
    absent = sorted(set(REQUIRED_COLUMNS) - set(drop.columns))
    if absent:
        raise QualityError(f"missing required columns: {','.join(absent)}")
    return load(spark, store, drop, now, cfg.buckets, gated=True)


def _batch(scratch: Scratch, drop: DataFrame, gated: bool) -> DataFrame:
    """The rows to load, staged. What the gates look at is counted by the two writes themselves.

    The drop is parsed once. Both counts are taken in the tasks that write, of which Spark counts each part
    once, also when lost executors make it run again.
    """
    rows, keys = Observation("drop"), Observation("keys")
    staged = scratch.stage(drop.observe(rows, *drop_counters(drop)))
    seen = {c: rows.get.get(c) or 0 for c in ("row_count", "blank_keys", "bad_crawl_times")}
    if not gated:
        require_crawl_times(seen["bad_crawl_times"])
    batch = scratch.stage(prepare_batch(staged, counted=True).observe(keys, F.count("*").alias("keys")))
    if gated:
        repeated = seen["row_count"] - seen["blank_keys"] - (keys.get.get("keys") or 0)
        require_counts({**seen, "missing_columns": "", "duplicate_keys": repeated})
        require_crawl_times(seen["bad_crawl_times"])
    return batch


def raw_table(store: Store, parts: list[str] | None = None) -> DataFrame:
    """The raw table, or some of its buckets; its columns are known, so no file is opened to learn them."""
    return store.read(RAW, parts, RAW_SCHEMA)


def load(spark: SparkSession, store: Store, drop: DataFrame, now: str, buckets: int = Config.buckets, gated: bool = False) -> int:
    """Upsert a drop into the buckets of the raw table that hold its links; returns rows inserted or updated.

    ``gated`` refuses empty drops and rows without a link or with one seen before; else the former are left out, of
    the latter the last is loaded.

    Only these buckets are read, joined and written; the files of the others stay. A bucket is written in key
    order, so that equal keys are neighbours: one pair of them, and the write fails before anything
    is replaced. An older table may hold such pairs; its buckets then lose all but the newest row of a key.
    Counts come out of the write itself.
    """
    with Scratch(spark) as scratch:
        batch = _batch(scratch, drop, gated)
        part = bucket("job_url", buckets)
        touched = sorted({*values_of(batch, part)} & {*store.parts(RAW)})

        def write(target: DataFrame) -> int:
            merged = upsert(target, batch, "job_url", UPDATE_COLUMNS, "crawled_at", "created_at", _ts(now))
            seen = Observation("upsert")
            rows = merged.withColumn(PART, part).repartition(PART).withColumn(
                "_before", F.lag("job_url").over(Window.partitionBy(PART).orderBy("job_url")))
            rows = rows.withColumn("job_url", F.when(
                F.col("_before") == F.col("job_url"), F.raise_error(F.lit(TWICE))).otherwise(F.col("job_url")))
            rows = rows.observe(seen, F.count_if(F.col("_action") != KEEP).alias("affected"))
            rows.select(*POSTING_COLUMNS, "created_at", PART).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(store.path(RAW))
            return seen.get["affected"] or 0

        known = raw_table(store, touched)
        try:
            return write(known)
        except Exception as error:  # a task's error reaches the driver as text in one of several classes
            if TWICE not in str(error):
                raise
        times = [c for c in ("crawled_at", "created_at") if c in known.columns]
        return write(purge_duplicates(known, "job_url", times, "crawled_at"))


@dataclass
class Outcome:
    """What a transform run found."""

    freshness: str
    late_rows: int
    salary_failures: int
    failed_checks: list[str] = field(default_factory=list)


def _check(outcome: Outcome, declared: dict, tables, strict: bool) -> None:
    report = K.report(declared, tables)
    try:
        require_clean(report)
    except QualityError as error:
        outcome.failed_checks += str(error).split("; ")
        if strict:
            raise


def _open_parts(store: Store, name: str) -> list[str]:
    return [p for p in store.parts(name) if p.startswith("b")]


def _snapshot(spark: SparkSession, store: Store, name: str, source: DataFrame, key: str, as_of: str, buckets: int) -> DataFrame:
    """Merge a source into its history. Open versions are kept by bucket of their key, closed ones by run.

    A narrow join of keys and times tells which buckets change; only these are read whole, merged and
    written. Versions closed by earlier runs are never touched. A run that fails is repeated with its ``as_of``.
    """
    part = bucket(key, buckets)
    if not store.parts(name):
        store.replace(name, open_versions(source, key, "updated_at"), part)
        return store.read(name)
    known = _open_parts(store, name)
    old = store.read(name, known).select(F.col(key).alias("_k"), "dbt_valid_from")
    both = source.select(key, "updated_at").join(old, F.col(key) == F.col("_k"), "full_outer")
    changed = both.where(F.col("_k").isNull() | F.col(key).isNull() | (F.col("dbt_valid_from") < F.col("updated_at")))
    touched = values_of(changed.select(F.coalesce("_k", key).alias(key)), part)
    if touched:
        with Scratch(spark) as scratch:
            current = store.read(name, [p for p in known if p in touched] or known[:1])
            current = current.where(part.isin(*touched))
            merged = scratch.stage(merge_open(current, source.where(part.isin(*touched)), key, "updated_at", _ts(as_of)))
            is_open = F.col("dbt_valid_to").isNull()
            stamp = "closed_" + "".join(c for c in as_of if c.isdigit())
            closed = merged.where(~is_open)
            if stamp in store.parts(name):  # a second run at the same time adds to what the first one closed
                closed = store.read(name, [stamp]).unionByName(closed).dropDuplicates(["dbt_scd_id"])
            store.replace(name, closed, F.lit(stamp))
            store.replace(name, merged.where(is_open), part, touched)
    return store.read(name)


def _days(store: Store) -> list[str]:
    return [p for p in store.parts(STATE) if p.isdigit()]


def _fact_state(store: Store, state: DataFrame) -> tuple[list[str], int]:
    """Add the events at or after the high-water mark; returns the days written and the late rows."""
    before = _days(store)
    if not before:
        store.replace(STATE, M.packed_facts(state), F.col("date_id"), finish=M.unpacked_facts)
        return _days(store), 0
    newest = before[-1:]
    mark = INC.high_water_mark(store.read(STATE, newest), "snapshot_ts")
    # A late row can only be stored among the rows of its own day: other days are not opened.
    old = state.where(F.col("snapshot_ts") < _ts(mark))
    known = store.read(STATE, [p for p in values_of(old, F.col("date_id")) if p in before])  # days, not rows
    packed = M.packed_facts(state)
    late = INC.late_rows(packed, M.packed_facts(known), GRAIN, "snapshot_ts", mark).count()
    batch = INC.on_or_after(packed, "snapshot_ts", mark)
    # Only the newest stored day can hold rows at the mark: older days are neither read nor written.
    merged = INC.delete_insert(M.packed_facts(store.read(STATE, newest)), batch, GRAIN, "snapshot_ts", mark)
    store.replace(STATE, merged, F.col("date_id"), finish=M.unpacked_facts)
    return [p for p in _days(store) if p >= newest[0]], late


def _trend_state(store: Store) -> None:
    """Make the trend's day states anew from the newest known day on, and where one is missing.

    Older days of the facts never change. A run that died between facts and states is healed by the next. Facts are
    moved once, to where their state is written: by day and slot of the job.
    """
    known = store.parts(TREND)
    days = [d for d in _days(store) if d not in known or d >= known[-1]]
    if days:
        facts = M.packed_facts(store.read(STATE, days)).withColumn("_slot", F.pmod(F.xxhash64("job_bk"), F.lit(SLOTS)))
        state = R.trend_state(facts.repartition("date_id", "_slot"), "job_bk", "_slot")
        store.replace(TREND, state, F.col("date_id"), placed=True, finish=M.unpacked_facts)


def store_facts(store: Store, state: DataFrame) -> tuple[list[str], int]:
    """Add facts to the stored days and refresh their states; returns the days written and the late rows."""
    written = _fact_state(store, state)
    _trend_state(store)
    return written


def serving_fact(store: Store, days: list[str] | None = None) -> DataFrame:
    """The fact with today's surrogate keys, resolved when read; ``days`` opens only these parts.

    Surrogate keys are renumbered by every build, so a stored copy would have to be rewritten daily.
    """
    return M.fct_job_snapshot(store.read(STATE, days), *(
        store.read(name) for name in ("dim_job", "dim_company", "dim_location")))


def transform(spark: SparkSession, cfg: Config, store: Store, as_of: str, strict: bool = True
              ) -> Outcome:
    """Freshness, staging and intermediate, snapshots, marts; each layer is checked before the next.

    ``strict`` stops at the first layer with violations; otherwise they are listed in the outcome.
    """
    raw = raw_table(store)
    # One narrow scan, before the wide one is paid for.
    priced = with_salary(raw.select("job_url", "salary", "crawled_at"), "salary", cfg.usd_rate)
    failed = F.count_if(F.col("salary_failed") & (F.trim("job_url") != "")).alias("n_failed")
    state = INC.freshness(priced, "crawled_at", _ts(as_of), cfg.warn_hours, cfg.error_hours, failed).first()
    outcome = Outcome(state["status"], 0, state["n_failed"])
    if state["status"] == "error" and strict:
        raise QualityError(f"raw data is stale: last crawl {state['max_loaded_at']}")

    with Scratch(spark, **COMPACT) as scratch:
        tables: dict[str, DataFrame] = {RAW: raw}
        stg = tables["stg_postings"] = scratch.stage(stg_postings(raw, cfg))
        events = tables["int_job_snapshot_events"] = I.int_job_snapshot_events(stg, cfg)
        tags = tables["int_job_tags"] = I.int_job_tags(events, cfg)
        places = tables["int_job_locations"] = I.int_job_locations(events, cfg)
        jobs = tables["int_job_snapshot_source"] = scratch.stage(I.int_job_snapshot_source(stg))
        companies = tables["int_company_snapshot_source"] = scratch.stage(
            I.int_company_snapshot_source(stg))
        _check(outcome, {**K.SOURCE, **K.STAGING}, tables.__getitem__, strict)

        tables["snap_dim_job"] = _snapshot(
            spark, store, "snap_dim_job", jobs, "job_bk", as_of, cfg.buckets)
        tables["snap_dim_company"] = _snapshot(
            spark, store, "snap_dim_company", companies, "company_bk", as_of, cfg.buckets)
        _check(outcome, K.SNAPSHOTS, tables.__getitem__, strict)

        days, outcome.late_rows = store_facts(store, M.fact_state(events, cfg))
        # Older facts' days and places are in the dimensions of the run before.
        fresh = store.read(STATE, days)
        calendar, codes = (scratch.stage(store.read(name)) if store.exists(name) else None
                           for name in ("dim_date", "dim_location"))
        built = {
            "dim_source": lambda: M.dim_source(spark, cfg),
            "dim_date": lambda: M.dim_date(events, cfg, _ts(as_of).cast("date"), fresh, calendar),
            "dim_job": lambda: M.dim_job(tables["snap_dim_job"], scratch),
            "dim_company": lambda: M.dim_company(tables["snap_dim_company"], scratch),
            "dim_location": lambda: M.dim_location(places, scratch, fresh, codes),
            "dim_tag": lambda: M.dim_tag(tags, scratch),
            "bridge_job_tags": lambda: M.bridge_job_tags(
                tags, tables["dim_tag"], tables["dim_job"]),
        }
        for name, build in built.items():
            tables[name] = store.overwrite(name, build())
        tables[FACT] = scratch.stage(serving_fact(store, days))
        _check(outcome, K.MARTS, tables.__getitem__, strict)
    return outcome


def trend_report(store: Store, cfg: Config, as_of: str) -> DataFrame:
    """The trend from the states of its days: no fact is read, and of the dimensions only today's job keys."""
    start = (datetime.fromisoformat(as_of) - timedelta(days=cfg.trend_days)).strftime("%Y%m%d")
    states = store.read(TREND, [d for d in store.parts(TREND) if d >= start])
    jobs = M.current(store.read("dim_job"), "external_job_id", "job_sk", "job_bk")
    states, jobs = (df.withColumn("job_bk", packed_key("job_bk")) for df in (states, jobs))
    return R.merge_trend(states.join(jobs, "job_bk", "left"), "job_sk", store.read("dim_date"),
                         _ts(as_of).cast("date"), cfg.trend_days)


def reports(store: Store, cfg: Config, as_of: str) -> dict[str, DataFrame]:
    """The six reports over the stored marts; each opens only the days it is about."""
    today = serving_fact(store, _days(store)[-1:])
    companies, jobs = store.read("dim_company"), store.read("dim_job")
    return {
        "top_keywords": R.top_keywords(today, store.read("bridge_job_tags"), store.read("dim_tag")),
        "salary_by_experience": R.salary_by_experience(today, jobs),
        "hotspots_by_location": R.hotspots_by_location(today, store.read("dim_location")),
        "company_size_distribution": R.company_size_distribution(today, companies),
        "top_companies": R.top_companies(today, companies),
        "hiring_trend": trend_report(store, cfg, as_of),
    }


def publish(spark: SparkSession, store: Store) -> None:
    """Register every mart under its own name for SQL clients of this session."""
    for name in K.MARTS:
        (serving_fact(store) if name == FACT else store.read(name)).createOrReplaceTempView(name)
