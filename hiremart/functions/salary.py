"""Free-text salaries to amounts in VND."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.functions.text import _c, contains_any

# Wording that decides currency, unit and which bound a number gives.
USD_MARKS = ("usd", "$")
MILLION_MARKS = ("triệu", "tr")
THOUSAND_MARKS = ("k",)
NEGOTIABLE_MARKS = ("thỏa thuận", "thu nhap canh tranh")
FROM_MARK, ABOVE_MARK, UP_TO_MARK = "từ", "trên", "tới"

# 14 integer digits: a larger number cannot fit the 14,2 result whatever its unit.
NUMBER = "decimal(24,10)"
MONEY = "decimal(14,2)"
SALARY_COLUMNS = [
    "salary_currency", "salary_multiplier", "salary_min", "salary_max", "salary_failed"]


def with_salary(df: DataFrame, column: str, usd_rate: int) -> DataFrame:
    """Replace a salary text by its currency, unit, both bounds and a failure flag.

    The order of the tests is the meaning: a dash beats every word, "from" and "above" beat
    "up to" for the lower bound, and "up to" beats "above" for the upper one. Text that carries
    digits yet gives no amount (malformed or too large) is missing and flagged as failed.

    Each step reads columns of the step before, so the lower-cased text and the digits of a bound
    are worked out once per row and not once per test.
    """
    others = [c for c in df.columns if c != column]
    text = F.col("_pay")
    silent = (text == "") | contains_any(text, NEGOTIABLE_MARKS)
    ranged = text.contains("-")
    missing = F.lit(None).cast("string")
    low = (
        F.when(silent, missing)
        .when(ranged, F.split_part(text, F.lit("-"), F.lit(1)))
        .when(text.contains(FROM_MARK) | text.contains(ABOVE_MARK), text)
        .when(text.contains(UP_TO_MARK), F.lit("0"))
        .otherwise(text)
    )
    high = (
        F.when(silent, missing)
        .when(ranged, F.split_part(text, F.lit("-"), F.lit(2)))
        .when(text.contains(UP_TO_MARK), text)
        .when(text.contains(ABOVE_MARK), missing)
        .otherwise(text)
    )
    multiplier = (
        F.when(contains_any(text, MILLION_MARKS), F.lit(1_000_000))
        .when(contains_any(text, THOUSAND_MARKS), F.lit(1_000))
        .otherwise(F.lit(1))
    )
    worded = df.select(*others, F.lower(F.coalesce(_c(column), F.lit(""))).alias("_pay")).select(
        *others,
        F.when(contains_any(text, USD_MARKS), F.lit("USD")).otherwise(F.lit("VND"))
        .alias("salary_currency"),
        multiplier.alias("salary_multiplier"), low.alias("_low"), high.alias("_high"))
    rate = F.when(F.col("salary_currency") == "USD", F.lit(usd_rate)).otherwise(F.lit(1))
    counted = worded.select(
        *others, "salary_currency", "salary_multiplier",
        (F.col("salary_multiplier").cast("bigint") * rate).cast("decimal(12,0)").alias("_factor"),
        # Only digits and points are left: separators of thousands go with the words.
        *[F.regexp_replace(c, r"[^0-9.]", "").alias(c) for c in ("_low", "_high")])
    priced = counted.select(
        *others, "salary_currency", "salary_multiplier", "_low", "_high",
        *[(F.col(c).try_cast(NUMBER) * F.col("_factor")).try_cast(MONEY).alias(name)
          for c, name in (("_low", "salary_min"), ("_high", "salary_max"))])

    def lost(digits: str, amount: str) -> Column:
        return F.coalesce(F.col(digits) != "", F.lit(False)) & F.col(amount).isNull()

    failed = lost("_low", "salary_min") | lost("_high", "salary_max")
    return priced.select(*others, *SALARY_COLUMNS[:-1], failed.alias("salary_failed"))


def salary_midpoint(low: Column | str, high: Column | str) -> Column:
    low, high = _c(low), _c(high)
    middle = ((low + high) / F.lit(2).cast("decimal(1,0)")).cast(MONEY)
    return F.when(low.isNotNull() & high.isNotNull(), middle).otherwise(F.coalesce(low, high))
