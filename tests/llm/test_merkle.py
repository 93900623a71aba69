"""Merkle proofs against a plain tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hiremart.llm import merkle
from hiremart.sources.scratch import Scratch
from tests.conftest import SF
from tests.llm import cases


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climb(nodes):
    """The top of a tree and for each node its (left, right) siblings, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 8 * 8
            path.append(("".join(nodes[run:at[i]]), "".join(nodes[at[i] + 1:run + 8])))
            at[i] //= 8
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, found = [], []
    for g in names:
        members = sorted(groups[g], key=lambda m: m[:3])
        top, paths = climb([m[2] for m in members])
        tops.append(top)
        found.append(list(zip(members, paths)))
    root, above = climb(tops) if tops else (None, [])
    out = Counter()
    for g, (members, top) in enumerate(zip(found, tops)):
        for (_, _, own, r), path in members:
            path = path + above[g]
            changed = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                changed = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
            for left, right in path:
                changed = H(left + changed + right)
            out[r["doc_id"], own, top, root, H("".join(a + b for a, b in path)), changed, changed == root] += 1
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def run(spark, docs, folder):
    got = entry.queries()["op13_merkle"](spark, cases.save(docs, folder)).select(*COLUMNS).collect()
    return Counter(tuple(r) for r in got)


def test_table(spark):
    rows = cases.table(spark, SF)
    got = Counter(tuple(r) for r in entry.queries()["op13_merkle"](spark, SF).select(*COLUMNS).collect())
    assert got == plain(rows)
    assert 0 < sum(n for k, n in got.items() if not k[-1]) < len(rows) / 2


def test_odd_rows(spark, tmp_path):
    docs = cases.odd(spark)
    rows = docs.collect()
    assert run(spark, docs, tmp_path / "odd") == plain(rows)
    assert run(spark, cases.empty(spark), tmp_path / "empty") == Counter()
    assert run(spark, docs.limit(1), tmp_path / "one") == plain(docs.limit(1).collect())


@pytest.mark.parametrize("sizes", [[8], [65, 8, 1, 64], [3] * 70 + [600]])
def test_sizes_of_trees(spark, tmp_path, sizes):
    rows = [(i * 3, f"Text {g} {i}", f"l{g:02d}é", "s", i) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    assert run(spark, docs, tmp_path) == plain(docs.collect())


def test_hot_group_and_other_columns(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 40).cast("string")).alias("lang"), F.col("id").alias("doc_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("leaf"), F.col("id").alias("place"), F.lit("x").alias("tree"), F.lit(1).alias("none"))
    out = merkle.manifest(rows, Scratch(spark))
    assert out.columns == ["lang", "doc_id", "leaf", "place", "tree", "none", "subroot", "root", "path"]
    assert out.where(merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).where("place = doc_id").count() == 3_000
    assert out.select("root").distinct().count() == 1 and out.select("subroot").distinct().count() == 41
