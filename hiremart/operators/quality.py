"""Data-quality checks.

Every check yields ``check, column_name, n_violations`` rows. Checks that need one pass over the
table share it; checks that group pre-aggregate, so a dominant value is one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(RuntimeError):
    """A gate or check found violations."""


def row_checks(df: DataFrame, columns: list[str], expressions: dict[str, Column]) -> DataFrame:
    """Missing values of ``columns`` and rows failing each labelled expression, counted in one scan."""
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in columns}
    counts |= {("expression_is_true", label): F.count_if(F.coalesce(~test, F.lit(True)))
               for label, test in expressions.items()}
    sums = df.agg(*[n.alias(f"_{i}") for i, n in enumerate(counts.values())])
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"),
                              F.col(f"_{i}").alias("n_violations")) for i, (check, column) in enumerate(counts)])
    return sums.select(F.inline(rows))


def foreign_keys(df: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without a parent for each column; a missing key passes.

    All keys of a row go through one scan and one shuffle as (column, key) pairs, pre-aggregated, and
    meet the united parents in one anti-join.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_k")) for c in parents])
    keys = df.select(F.inline(pairs)).where(F.col("_k").isNotNull()).groupBy("_c", "_k").agg(F.count("*").alias("_n"))
    known = reduce(DataFrame.unionByName, [
        parent.select(F.lit(c).alias("_c"), F.col(field).cast("string").alias("_k"))
        for c, (parent, field) in parents.items()])
    orphans = keys.join(known, ["_c", "_k"], "left_anti").agg(*[
        F.coalesce(F.sum(F.when(F.col("_c") == c, F.col("_n"))), F.lit(0)).cast("bigint").alias(f"_{i}")
        for i, c in enumerate(parents)])
    rows = F.array(*[F.struct(F.lit("relationships").alias("check"), F.lit(c).alias("column_name"),
                              F.col(f"_{i}").alias("n_violations")) for i, c in enumerate(parents)])
    return orphans.select(F.inline(rows))


def uniqueness(df: DataFrame, columns: list[str], combinations: list[list[str]]) -> DataFrame:
    """Repeated values of ``columns`` (missing ones left out) and of column combinations (missing ones equal).

    A row gives one (check, key) pair for each check. All pairs go through one scan and one shuffle, pre-aggregated,
    so a dominant key costs one row a task. A key is written as the lengths and texts of its values, which keeps it apart
    from any other. A check that is the only one groups by its columns as they are: no row is turned into text.
    """
    if len(columns) + len(combinations) == 1:
        return unique(df, columns[0]) if columns else unique_combination(df, list(combinations[0]))

    def key(parts: list[str]) -> Column:
        texts = [F.col(c).cast("string") for c in parts]
        return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])

    checks = [("unique", c, F.when(F.col(c).isNotNull(), key([c]))) for c in columns]
    checks += [("unique_combination", "+".join(c), key(list(c))) for c in combinations]
    pairs = F.array(*[F.struct(F.lit(i).alias("_c"), k.alias("_k")) for i, (_, _, k) in enumerate(checks)])
    repeated = df.select(F.inline(pairs)).where(F.col("_k").isNotNull()).groupBy("_c", "_k").agg(
        F.count("*").alias("_n")).where("_n > 1")
    sums = repeated.agg(*[F.count_if(F.col("_c") == i).alias(f"_{i}") for i in range(len(checks))])
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"),
                              F.col(f"_{i}").alias("n_violations")) for i, (check, column, _) in enumerate(checks)])
    return sums.select(F.inline(rows))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values of several columns, counted in one scan."""
    sums = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return sums.unpivot([], columns, "column_name", "n_violations").select(
        F.lit("not_null").alias("check"), "column_name", "n_violations")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of one column that occur more than once."""
    return _repeated(df.where(F.col(column).isNotNull()), [column], "unique")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column combinations that occur more than once; missing values compare equal."""
    return _repeated(df, columns, "unique_combination")


def _repeated(df: DataFrame, columns: list[str], check: str) -> DataFrame:
    repeated = df.groupBy(*columns).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(
        F.lit(check).alias("check"), F.lit("+".join(columns)).alias("column_name"),
        F.count("*").alias("n_violations"))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose key has no parent; a missing key passes."""
    keys = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k"))
            .agg(F.count("*").alias("_n")))
    orphans = keys.join(parent.select(F.col(field).alias("_k")), "_k", "left_anti")
    return orphans.agg(
        F.lit("relationships").alias("check"), F.lit(column).alias("column_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_violations"))


def expression_is_true(df: DataFrame, expression: Column, label: str) -> DataFrame:
    """Rows for which the expression is false or unknown."""
    bad = F.coalesce(~expression, F.lit(True))
    return df.agg(
        F.lit("expression_is_true").alias("check"), F.lit(label).alias("column_name"),
        F.count_if(bad).alias("n_violations"))


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require_clean(report: DataFrame) -> None:
    """Raise if any check in the report found violations."""
    failed = report.where(F.col("n_violations") > 0).collect()  # one row per declared check
    if failed:
        raise QualityError("; ".join(
            " ".join(str(row[c]) for c in report.columns) for row in failed))


def raw_gate(df: DataFrame, required: list[str], key: str) -> DataFrame:
    """One row about a raw drop: absent columns, rows, rows without key, repeated keys."""
    absent = sorted(set(required) - set(df.columns))
    trimmed = F.trim(F.regexp_replace(F.col(key), r"(?U)^\s+|\s+$", ""))
    # Counting per key first keeps a dominant key to one partial row per task.
    keys = (df.groupBy(F.nullif(trimmed, F.lit("")).alias("_k")).agg(F.count("*").alias("_n"))
            if key in df.columns else
            df.agg(F.lit(None).cast("string").alias("_k"), F.count("*").alias("_n")))
    has_key = F.col("_k").isNotNull()
    zero = F.lit(0)
    return keys.agg(
        F.lit(",".join(absent)).alias("missing_columns"),
        F.coalesce(F.sum("_n"), zero).cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(~has_key, F.col("_n"))), zero).cast("bigint").alias("blank_keys"),
        F.coalesce(F.sum(F.when(has_key, F.col("_n") - 1)), zero).cast("bigint")
        .alias("duplicate_keys"),
    )


def require_counts(seen: Mapping[str, str | int]) -> int:
    """Raise unless the counts of a raw gate are those of a sound drop; returns the rows."""
    if seen["missing_columns"]:
        raise QualityError(f"missing required columns: {seen['missing_columns']}")
    if seen["row_count"] == 0:
        raise QualityError("the drop contains no rows")
    if seen["blank_keys"]:
        raise QualityError(f"{seen['blank_keys']} rows without a key")
    if seen["duplicate_keys"]:
        raise QualityError(f"{seen['duplicate_keys']} rows with a duplicate key")
    return seen["row_count"]


def require_raw(df: DataFrame, required: list[str], key: str) -> int:
    """Raise unless the drop passes the raw gate; returns its row count."""
    return require_counts(raw_gate(df, required, key).first().asDict())
