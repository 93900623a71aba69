"""Quality rules: robust multivariate outliers, in DataFrame functions only.

Each text gives a vector of transformed statistics (``FEATURES``). For every (language, source) with
at least ``least`` documents, or else for the rest of the language, or else for the rest of all, a
minimum-covariance-determinant estimate is made: from medians and median absolute deviations on, the
CORE share of documents with the smallest distances gives the next mean and covariance (a C-step),
STEPS times, which never increases the determinant. Distances are scaled so that their median is the
one of the chi-square distribution; a document beyond ``CUTOFF`` is rejected. Every aggregation is a
group-by with partial sums or digests over all documents; no group is ever gathered.

FLOORS are spreads added to the estimates, so that a statistic that is constant in a group does not
turn a small difference into an outlier. A distance is at most the sum of squares in units of the floors, so
they are small enough for each statistic to pass CUTOFF alone: in a group that is clean otherwise about half of
the lines repeated, 36% repeated words or 5 symbols per 100 word characters. Documents that fail the base rules are not used for the
estimates. Null texts count as empty and fail the base rules; null language or source is a group of
its own; documents of a remainder too small for an estimate are kept; repeated rows are judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.llm.common import SPACE, WORD, let, text_of
from hiremart.sources.scratch import Scratch

FEATURES = ("f_words", "f_length", "f_symbols", "f_lines", "f_repeat")
FLOORS = (0.5, 0.08, 0.3, 0.3, 0.1)
CORE, STEPS, LEAST = 0.75, 4, 200
CHI_MEDIAN = 4.351  # median of the chi-square distribution with five degrees of freedom
CUTOFF = 35.9  # its quantile at 1 - 1e-6
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(starts: Column) -> Column:
    """Places covered by windows of three from sorted ``starts``."""
    steps = F.transform(starts, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - x, F.lit(3))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def _repeat_words(words: Column) -> Column:
    def repeated(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda p: let(
            F.sort_array(F.transform(
                F.filter(p, lambda x, j: F.coalesce(x["h"] == F.get(p, j + 1)["h"], F.lit(False))
                         | F.coalesce(x["h"] == F.get(p, j - 1)["h"], F.lit(False))),
                lambda x: x["i"])), _covered))

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, let(grams, lambda g: F.when(
        F.size(F.array_distinct(g)) < F.size(g), repeated(g)).otherwise(0))).otherwise(0)


def text_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with the five statistics of each whole text."""
    words = F.array_remove(F.split(text_of(), SPACE), "")
    lines = F.filter(F.split(text_of(), "\n"), lambda line: line.rlike(WORD))
    sized = docs.select(*keep, text_of().alias("_text"), words.alias("_words"), lines.alias("_lines"))
    return sized.select(
        *keep, F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("_lines").cast("bigint").alias("_n_lines"),
        _repeat_words(F.col("_words")).cast("bigint").alias("n_repeat_words"))


def _vector(stats: DataFrame) -> DataFrame:
    """Add the statistic vector; the shares make it independent of the length but for f_words."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return stats.withColumns({
        "f_words": F.log(n), "f_length": F.log(chars / n),
        "f_symbols": F.log1p(100 * F.col("n_symbols") / chars),
        "f_lines": F.log1p(10 * F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1))),
        "f_repeat": F.sqrt(F.col("n_repeat_words") / n)})


def _grouped(rows: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """Add _group: language and source, or a remainder where these have too few usable documents."""
    lang = F.concat(F.lit("l"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))
    source = F.concat(F.lit("s"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    sizes = rows.select(lang.alias("_l"), source.alias("_s"), "base_failed").groupBy("_l", "_s").agg(
        F.count(F.when(~F.col("base_failed"), 1)).alias("_n"))
    sizes = scratch.stage(sizes)  # one row per language and source
    rest = sizes.where(F.col("_n") < least).groupBy("_l").agg(F.sum("_n").alias("_rest"))
    names = sizes.join(rest, "_l", "left").select("_l", "_s", F.when(F.col("_n") >= least, F.concat_ws("\n", "_l", "_s"))
                                                 .when(F.col("_rest") >= least, F.col("_l")).otherwise("").alias("_group"))
    return rows.withColumns({"_l": lang, "_s": source}).join(names, ["_l", "_s"]).drop("_l", "_s")


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Add _d2, the squared distance under ``estimate`` (_group, means m*, lower factor l**)."""
    joined, terms = rows.join(estimate, "_group", "left"), []
    for i, f in enumerate(FEATURES):
        value = F.col(f) - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * F.col(f"_y{j}")
        joined = joined.withColumn(f"_y{i}", value / F.col(f"l{i}{i}"))
        terms.append(F.col(f"_y{i}") * F.col(f"_y{i}"))
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return joined.withColumn("_d2", total).select(*rows.columns, "_d2")


def _factor(moments: DataFrame) -> DataFrame:
    """(_group, m*, l**): Cholesky factor of the covariances c** with the floors added."""
    for i in range(len(FEATURES)):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") + (F.lit(FLOORS[i] ** 2) if i == j else 0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            moments = moments.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    n = range(len(FEATURES))
    return moments.select("_group", *[f"m{i}" for i in n], *[f"l{i}{j}" for i in n for j in range(i + 1)])


def mcd(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(_group, m*, l**, _scale): the estimate of each group of ``rows`` (_group, features)."""
    n = range(len(FEATURES))
    middle = rows.groupBy("_group").agg(*[F.percentile_approx(f, 0.5).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    middle = scratch.stage(middle)
    spread = rows.join(middle, "_group").groupBy("_group").agg(*[
        F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5).alias(f"s{i}") for i, f in enumerate(FEATURES)])
    start = middle.join(spread, "_group").select(
        "_group", *[f"m{i}" for i in n], *[
            (F.pow(1.4826 * F.col(f"s{i}"), F.lit(2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
            for i in n for j in range(i + 1)])
    estimate = scratch.stage(_factor(start))
    for _ in range(STEPS):
        near = _distance(rows, estimate)
        limit = scratch.stage(near.groupBy("_group").agg(F.percentile_approx("_d2", CORE).alias("_limit")))
        core = near.join(limit, "_group").where("_d2 <= _limit")
        moments = core.groupBy("_group").agg(
            *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)],
            *[F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i in n for j in range(i + 1)])
        estimate = scratch.stage(_factor(moments))
    scale = _distance(rows, estimate).groupBy("_group").agg(
        (F.greatest(F.percentile_approx("_d2", 0.5), F.lit(1e-9)) / CHI_MEDIAN).alias("_scale"))
    # Floors make a median distance small; scaling never widens a distance.
    return scratch.stage(estimate.join(scale.withColumn("_scale", F.greatest("_scale", F.lit(1.0))), "_group"))


def judge(docs: DataFrame, id_column: str = "doc_id", least: int = LEAST, scratch: Scratch | None = None) -> DataFrame:
    """(id, the five statistics, base_failed, distance, kept) for each row of ``docs`` (id, text, lang, source).

    ``distance`` is the scaled squared Mahalanobis distance, null where no estimate was made.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    source = docs.select(F.col(id_column).alias("_id"), "text", "lang", "source")
    stats = text_stats(source, ["_id", "lang", "source"]).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    stats = scratch.stage(_vector(stats))
    rows = scratch.stage(_grouped(stats, least, scratch))
    usable = rows.where(~F.col("base_failed"))
    counted = scratch.stage(usable.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") >= least))
    estimate = mcd(usable.select("_group", *FEATURES).join(counted.select("_group"), "_group", "left_semi"), scratch)
    scale = estimate.select("_group", "_scale")
    found = _distance(rows, estimate.drop("_scale")).join(scale, "_group", "left")
    distance = F.col("_d2") / F.col("_scale")
    return found.select(F.col("_id").alias(id_column), *STATS, "base_failed", distance.alias("distance"),
                        (~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))).alias("kept"))
