"""Each stage of the pipeline on its own input, and the whole of it."""

from __future__ import annotations

import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF
from tests.llm import cases
from tests.llm.test_chosen_path import brute
from tests.llm.test_secrets import base

STAGE = dict(corpus_pipeline.STAGES)


def test_order_of_the_stages():
    assert list(STAGE) == ["language", "toxicity", "near_duplicates", "secrets", "packing"]


def test_language_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = STAGE["language"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    bad = docs.limit(20).selectExpr("doc_id + 9000000 as doc_id", "'123 !!' as text", "lang", "source", "n_chars")
    mixed = STAGE["language"](spark, docs.unionByName(bad), SF)
    assert mixed.where("doc_id >= 9000000").count() == 0 and mixed.count() == kept.count()


def test_toxicity_stage(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r[0] for r in STAGE["toxicity"](spark, docs, folder).select("doc_id").collect()}
    labels = cases.table(spark, folder, "labels")
    toxic, clean = ([r["doc_id"] in kept for r in labels if r["toxic"] == t] for t in (1, 0))
    assert sum(toxic) < 0.25 * len(toxic) and sum(clean) > 0.995 * len(clean)


def test_near_duplicate_stage_keeps_one_of_each_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {k for (k, _), (_, low) in zip(rows, brute(rows, 5)) if k == low}
    got = STAGE["near_duplicates"](spark, docs.unionByName(docs.limit(30)), SF)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)


def test_near_duplicate_stage_loses_no_text_of_a_shared_id(spark):
    a, b, c = ("w%d " * 9 % tuple(range(k, k + 9)) for k in (0, 100, 200))
    rows = [(3, a), (5, a), (5, b), (5, b), (7, c), (7, c + "more "), (7, ""), (8, b), (None, a), (9, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], cases.SCHEMA)
    got = sorted(((r["doc_id"], r["text"]) for r in STAGE["near_duplicates"](spark, docs, SF).collect()), key=str)
    assert (7, c) in got or (7, c + "more ") in got
    assert [r for r in got if r[0] != 7 or not r[1]] == sorted([(3, a), (5, b), (7, ""), (None, a), (9, None)], key=str)
    assert len(got) == 6


def test_column_names_of_any_kind_go_through_every_stage(spark, tmp_path):
    names = ["_row", "_toxic", "_lang", "_lang_pred", "_score", "_accepted", "_blob", "_spans", "_digest", "_key", "__key", "_text", "toxic"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs.write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    for stage, fn in list(STAGE.items())[:-1]:
        out = fn(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[name] == f"{name}{r['doc_id']}" for r in rows for name in names)
    assert STAGE["packing"](spark, docs, SF).count() >= 60


def test_secrets_stage_leaves_no_finding_and_no_other_change(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    for r in STAGE["secrets"](spark, docs, SF).collect():
        assert not base(r["text"]) and r["n_chars"] == len(r["text"])
        if not base(before[r["doc_id"]]["text"]):
            assert r == before[r["doc_id"]]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in cases.table(spark, SF)}
    sizes = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert sum(r["length"] for r in rows) == sum(sizes.values())
    untouched = [k for k in sizes if not base(texts[k])]
    for k in untouched[::9]:
        assert sizes[k] == len(library.encode(texts[k], add_special_tokens=False).ids) + 1


def test_odd_and_empty_tables(spark, tmp_path):
    for name, rows in (("odd", cases.odd(spark)), ("empty", cases.empty(spark))):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(5, 0), (7, 1)], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
        if name == "empty":
            assert out.count() == 0
