"""Fingerprints against a plain version of the same definition, and their estimates against exact similarity."""

from __future__ import annotations

import hashlib
import statistics
import struct

import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hiremart.llm import fingerprint as fp
from tests.conftest import SF
from tests.llm import cases


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def spark_hash(*values):
    seed = 42
    for v in values:
        data = struct.pack("<i", v) if isinstance(v, int) else v.encode()
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def plain(text):
    words = cases.WORD.findall(text)
    if not words:
        return fp.EMPTY
    runs = [words[i:i + fp.WORDS] for i in range(len(words) - fp.WORDS + 1)] or [[" ".join(words)]]
    least = {}
    for h in sorted((spark_hash(*r) for r in runs), key=signed):
        least.setdefault(h >> 57, h)
    out = []
    for b in range(fp.BINS):
        donor = b if b in least else min(least, key=lambda c: (signed(spark_hash(b, c))))
        out.append(f"{least[donor] & 255:02x}")
    return "".join(out)


def edited(rows):
    """{id: (text, edited text, next text)}, ids descending, after the last the first."""
    rows, out = sorted(rows, reverse=True), {}
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        out[key] = (text, text[:len(text) - cut] + after[:cut], after)
    return out


def shingles(text):
    w = cases.WORD.findall(text)
    return {tuple(w[i:i + fp.WORDS]) for i in range(max(1, len(w) - fp.WORDS + 1))}


def test_table(spark):
    want = edited([(r["doc_id"], r["text"] or "") for r in cases.table(spark, SF)])
    got = {r["doc_id"]: r for r in entry.queries()["op1_fingerprint"](spark, SF).collect()}
    assert got.keys() == want.keys()
    errors = []
    for key, (text, other, after) in want.items():
        r = got[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain(text), plain(other))
        a, b, c = shingles(text), shingles(other), shingles(after)
        errors += [r["near_edited"] - len(a & b) / len(a | b), r["near_next"] - len(a & c) / len(a | c)]
    assert abs(statistics.mean(errors)) < 0.01  # no bias
    assert statistics.pstdev(errors) < 0.05 and max(map(abs, errors)) < 0.25


def test_odd_rows(spark):
    rows = cases.odd(spark).select("doc_id", "text", fp.fingerprint(F.coalesce("text", F.lit(""))).alias("f")).collect()
    for r in rows:
        assert r["f"] == plain(r["text"] or ""), r["doc_id"]
    pair = spark.createDataFrame([(plain("a"), plain("a")), (fp.EMPTY, fp.EMPTY), (fp.EMPTY, plain("a"))], "a string, b string")
    assert [r[0] for r in pair.select(fp.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0, 0.0]
    assert cases.empty(spark).select(fp.fingerprint(F.col("text"))).count() == 0


def test_next_row_over_many_ranges(spark):
    rows = [(i * 7 % 1009, f"t{i}") for i in range(1009)] + [(5, "zz"), (None, "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = fp.with_next(docs, {}, ["text"]).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = sorted((str(a), x, y) for (a, x), (_, y) in zip(order, order[1:] + order[:1]))
    assert sorted((str(r["doc_id"]), r["text"], r["next_text"]) for r in got) == want
    assert fp.with_next(cases.empty(spark).select("doc_id", "text"), {}, ["text"]).count() == 0


def test_no_python_on_executors(spark):
    plan = entry.queries()["op1_fingerprint"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
