"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

The shingles of a text (runs of WORDS words; a shorter text is one shingle) are hashed once. The top
bits of a hash name one of BINS bins, and a bin keeps its least hash. An empty bin borrows from a
full one by optimal densification: each bin has its own random order of the other bins and takes
the first full one, so two texts with the same full bins borrow alike. BITS low-order bits of every bin
are packed into the fingerprint (hex, BINS * BITS / 4 digits). Two bins of unlike texts agree by
chance with probability 2**-BITS; ``likeness`` removes this bias.

A text without words, and null as an empty text, has a fingerprint of its own (all zeros) that is
like itself (1) and unlike all others (0, unless the other is empty too). Equal texts always have
equal fingerprints, repeated rows each get theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hiremart.llm.common import SPACE, let

WORDS, BINS, BITS, RANGES = 5, 128, 8, 8
_SHIFT = 64 - BINS.bit_length() + 1
EMPTY = "0" * (BINS * BITS // 4)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, _SHIFT).cast("int")


def least_per_bin(text: Column) -> Column:
    """The least hash of each full bin, in the order of the bins."""
    words = F.array_remove(F.split(text, SPACE), "")

    def hashes(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(
            *[F.get(w, i + j) for j in range(WORDS)]))
        return F.when(F.size(w) >= WORDS, runs).when(
            F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<bigint>"))

    # Bins in order of the signed hashes: the order itself does not matter, only that equal bins are neighbours.
    return let(let(words, hashes), lambda h: let(F.sort_array(h), lambda s: F.filter(
        s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))))


def densified(least: Column) -> Column:
    """The hash of every bin; an empty one takes that of the full bin that comes first in its own order."""
    def fill(bins: Column) -> Column:
        def one(b: Column) -> Column:
            at = F.array_position(bins, b)
            order = F.transform(bins, lambda c, i: F.struct(F.xxhash64(b, c).alias("p"), i.alias("i")))
            return F.when(at > 0, F.get(least, (at - 1).cast("int"))).otherwise(
                F.get(least, F.array_min(order)["i"]))

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), one)

    return let(F.transform(least, _bin), fill)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text as hex digits."""
    def packed(least: Column) -> Column:
        low = F.transform(densified(least), lambda h: F.lpad(F.lower(F.hex(
            h.bitwiseAND(F.lit((1 << BITS) - 1)))), BITS // 4, "0"))
        return F.when(F.size(least) > 0, F.array_join(low, "")).otherwise(F.lit(EMPTY))

    return let(least_per_bin(text), packed)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two fingerprints, free of chance agreement."""
    size, chance = BITS // 4, 2.0 ** -BITS
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0), lambda n, i: n + F.when(
        F.substr(a, i * size + 1, F.lit(size)) == F.substr(b, i * size + 1, F.lit(size)), 1).otherwise(0))
    raw = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == EMPTY) | (b == EMPTY), 0.0).otherwise(raw)


def _range_of(value: Column, limits: list) -> Column:
    """How many of the ascending ``limits`` are not below ``value``: 0 for the largest values."""
    if not limits:
        return F.lit(0)
    step = max(1, int(len(limits) ** 0.5))
    every = F.array(*[F.lit(x) for x in reversed(limits)])  # descending
    coarse = F.array(*[F.lit(x) for x in limits[::-1][::step]])

    def above(some: Column) -> Column:
        return F.size(F.filter(some, lambda x: x >= value))

    block = F.greatest(F.lit(0), above(coarse) - 1) * step
    return F.when(value.isNull(), len(limits)).otherwise(
        let(block, lambda b: b + above(F.slice(every, b + 1, F.lit(step)))))


def with_next(docs: DataFrame, derived: dict[str, Column], follow: list[str], id_column: str = "doc_id") -> DataFrame:
    """Rows with ``derived`` columns and, as next_*, the ``follow`` columns of the row with the next smaller id.

    After the last row comes the first. Rows are dealt once, by ranges of (numeric) ids whose limits are
    approximate quantiles, RANGES of them for each shuffle partition, so that partitions even out although ranges
    are dealt by hash; each range also gets the row after its last. Rows with equal ids follow each other by their columns; null ids come last.
    """
    parts = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(id_column, shares).alias("limits")).first()["limits"] if shares else None
    rows = docs.withColumns({"_range": _range_of(F.col(id_column), sorted(set(found or []))), "_given": F.lit(0)})
    tops = rows.groupBy("_range").agg(F.max(id_column).alias("_top"))  # a row for each range
    whole = Window.orderBy("_range")
    tops = tops.select(F.col("_range").alias("_now"), "_top", F.coalesce(
        F.lag("_range").over(whole), F.max("_range").over(whole.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    given = rows.join(F.broadcast(tops), (rows["_range"] == tops["_now"]) & rows[id_column].eqNullSafe(tops["_top"]))
    given = given.select(*docs.columns, F.col("_before").alias("_range"), F.lit(1).alias("_given"))
    both = rows.unionByName(given).withColumns(derived)
    order = Window.partitionBy("_range").orderBy(
        "_given", F.col(id_column).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in docs.columns if c != id_column])
    return both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in follow]).where(
        "_given = 0").drop("_range", "_given")
