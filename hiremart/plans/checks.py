"""The declared checks of every layer and how they run.

Row checks of a table share one scan, its foreign keys one shuffle, its uniqueness checks another.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from hiremart.operators import quality as Q

SALARY_RANGE = "salary_min is null or salary_max is null or salary_min <= salary_max"


@dataclass(frozen=True)
class Checks:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    combination: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)
    expression: str | None = None


SOURCE = {"raw": Checks(not_null=("job_url", "crawled_at"))}
STAGING = {
    "stg_postings": Checks(
        not_null=("job_bk", "company_bk", "job_url", "snapshot_ts", "source_id"),
        combination=("job_bk", "snapshot_ts")),
    "int_job_snapshot_events": Checks(
        not_null=("job_bk", "snapshot_ts", "snapshot_date_id"),
        combination=("job_bk", "snapshot_ts")),
    "int_job_tags": Checks(
        not_null=("tag_name_norm",), combination=("job_bk", "snapshot_ts", "tag_name_norm")),
    "int_job_locations": Checks(
        not_null=("location_name_norm",),
        combination=("job_bk", "snapshot_ts", "location_name_norm")),
    "int_company_snapshot_source": Checks(
        not_null=("company_bk", "updated_at"), unique=("company_bk",)),
    "int_job_snapshot_source": Checks(not_null=("job_bk", "updated_at"), unique=("job_bk",)),
}
SNAPSHOTS = {
    "snap_dim_company": Checks(
        not_null=("company_bk", "dbt_scd_id", "dbt_valid_from"), unique=("dbt_scd_id",)),
    "snap_dim_job": Checks(
        not_null=("job_bk", "dbt_scd_id", "dbt_valid_from"), unique=("dbt_scd_id",)),
}
MARTS = {
    "dim_source": Checks(not_null=("source_id", "source_name"), unique=("source_id",)),
    "dim_company": Checks(
        not_null=("company_sk", "dbt_scd_id", "company_id"), unique=("company_sk", "dbt_scd_id")),
    "dim_job": Checks(
        not_null=("job_sk", "dbt_scd_id", "external_job_id", "source_id"),
        unique=("job_sk", "dbt_scd_id"),
        relationships={"source_id": ("dim_source", "source_id")}),
    "dim_date": Checks(not_null=("date_id", "date_day"), unique=("date_id",)),
    "dim_location": Checks(
        not_null=("location_id", "location_code"), unique=("location_id", "location_code")),
    "dim_tag": Checks(not_null=("tag_id", "tag_name"), unique=("tag_id", "tag_name")),
    "bridge_job_tags": Checks(
        not_null=("job_sk", "tag_id"), combination=("job_sk", "tag_id"),
        relationships={"job_sk": ("dim_job", "job_sk"), "tag_id": ("dim_tag", "tag_id")}),
    "fct_job_snapshot": Checks(
        not_null=("job_bk", "snapshot_ts", "job_sk", "date_id"),
        combination=("job_bk", "snapshot_ts"),
        relationships={
            "job_sk": ("dim_job", "job_sk"), "company_sk": ("dim_company", "company_sk"),
            "location_id": ("dim_location", "location_id"), "date_id": ("dim_date", "date_id"),
            "deadline_date_id": ("dim_date", "date_id")},
        expression=SALARY_RANGE),
}
ALL = {**SOURCE, **STAGING, **SNAPSHOTS, **MARTS}


def table_report(name: str, checks: Checks, tables) -> DataFrame:
    """Violation counts of one table; ``tables`` maps a name to its DataFrame."""
    df = tables(name)
    done = []
    if checks.not_null or checks.expression:
        done.append(Q.row_checks(df, list(checks.not_null), {
            e: F.expr(e) for e in [checks.expression] if e}))
    if checks.unique or checks.combination:
        done.append(Q.uniqueness(df, list(checks.unique), [list(checks.combination)] if checks.combination else []))
    if checks.relationships:
        done.append(Q.foreign_keys(df, {
            column: (tables(parent), key) for column, (parent, key) in checks.relationships.items()}))
    return Q.union_checks(done).select(F.lit(name).alias("table_name"), "*")


def report(declared: dict[str, Checks], tables) -> DataFrame:
    return Q.union_checks([table_report(name, checks, tables) for name, checks in declared.items()])
