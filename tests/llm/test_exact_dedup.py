"""Exact duplicates against a plain grouping, digests that collide included."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hiremart.llm import exact_dedup
from hiremart.sources.scratch import Scratch
from tests.conftest import SF
from tests.llm import cases


def plain(rows):
    """(id, keep_id, group_size, kept, digest) of each (id, text), as a bag."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), key is None, key or 0, key))
    out = Counter()
    for content, members in groups.items():
        best = min(members)
        for i, m in enumerate(sorted(members)):
            out[m[3], best[3], len(members), i == 0, hashlib.sha256(content.encode()).hexdigest()] += 1
    return out


def found(docs, **options):
    rows = exact_dedup.exact_duplicates(docs, Scratch(docs.sparkSession), **options).collect()
    assert not rows or rows[0].__fields__ == ["doc_id", "keep_id", "group_size", "kept", "digest"]
    return Counter((r[0], r[1], r[2], r[3], bytes(r[4]).hex()) for r in rows)


def test_odd_rows(spark):
    docs = cases.odd(spark).withColumn("digest", F.lit(1)).withColumn("first", F.lit(2)).withColumn("size", F.lit(3))
    docs = docs.unionByName(docs.limit(4)).repartition(5)
    assert found(docs) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert not found(cases.empty(spark))


def test_table_and_copies_over_many_tasks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    hot = spark.range(400).selectExpr("id + 100000 as doc_id", "repeat(' x', cast(id % 7 as int)) || 'same text' as text")
    docs = docs.unionByName(hot).repartition(23)
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    for salts in (1, 3, 64):
        assert found(docs, salts=salts) == want


def test_contents_that_share_a_digest_stay_apart(spark):
    docs = cases.odd(spark).unionByName(cases.odd(spark).limit(6)).repartition(4)
    rows = exact_dedup.exact_duplicates(docs, Scratch(spark), salts=3, digest=lambda c: (F.length(c) % 2).cast("int"))
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows.collect())
    want = Counter()
    for key, n in plain([(r["doc_id"], r["text"]) for r in docs.collect()]).items():
        want[key[:4]] += n
    assert got == want
