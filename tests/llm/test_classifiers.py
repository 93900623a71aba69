"""Language and toxicity models: held-out accuracy and their contracts."""

from __future__ import annotations

import zlib

import numpy as np

import __spark_entry__ as entry
from hiremart.llm import language, toxicity
from tests.llm import cases

SF = "/root/testdata/sf0.01"  # models need more rows than the smallest scale has


def learn(rows, **options):
    return language.fit(((language.bags(text), lang) for text, lang in rows), **options)


def test_languages_of_held_out_documents(spark):
    got = entry.queries()["op5_language"](spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in cases.table(spark, SF)}
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert np.mean([r["accepted"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_text_of_an_unlearned_language_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(docs, language.F.col("lang") != "es")
    assert "es" not in model.languages
    rows = language.predict(docs, model, ["lang"]).groupBy("lang").agg(
        language.F.avg(language.F.col("accepted").cast("int"))).collect()
    accepted = dict(map(tuple, rows))
    assert accepted.pop("es") < 0.1 and min(accepted.values()) > 0.99


def test_a_rare_language_gets_rows():
    rows = [(cases.PROSE[0] * 3, "en")] * 900 + [(f"{cases.PROSE[1]} {i}", "de") for i in range(60)] + [("la la lo li", "it")] * 40
    model = learn(rows[i * 7 % 1000] for i in range(1000))
    assert model.languages == ["de", "en", "it"] and model.predict("lo la li la")[0] == "it"


def test_training_is_bounded_in_bytes():
    texts = (f"text number {i} of an endless stream" for i in iter(int, 1))
    assert learn(((t, "en") for t in texts), most=10_000).languages == ["en"]
    assert toxicity.fit(((toxicity.distinct(t), 1) for t in texts), most=10_000).bias > 0


def test_language_of_odd_rows(spark):
    model = learn([(cases.PROSE[0], "en")] * 40 + [(cases.PROSE[1], "de")] * 40)
    rows = language.predict(cases.odd(spark), model).collect()
    assert len(rows) == len(cases.ODD_ROWS)
    by = {r["doc_id"]: r for r in rows}
    for key in (1, 2, 3, 4):
        assert (by[key]["lang_pred"], by[key]["score"], by[key]["accepted"]) == ("und", 0.0, False)
    assert (by[5]["lang_pred"], by[7]["lang_pred"]) == ("en", "de")
    assert language.predict(cases.empty(spark), model).count() == 0
    assert cases.odd(spark).columns + ["_l", "_s", "_a"] == language.predict(
        cases.odd(spark), model, cases.odd(spark).columns, ("_l", "_s", "_a")).columns
    nothing = language.train(cases.empty(spark), language.F.lit(True))
    assert {r["lang_pred"] for r in language.predict(cases.odd(spark), nothing).collect()} == {"und"}


def test_slices_hold_the_grams_of_the_whole(monkeypatch):
    whole = np.sort(np.concatenate(list(language.buckets(cases.PROSE[0] * 5))))
    monkeypatch.setattr(language, "SLICE", 17)
    assert (np.sort(np.concatenate(list(language.buckets(cases.PROSE[0] * 5)))) == whole).all()


def test_multiplied_out_layers_equal_the_two(spark):
    model = learn([("aa bb", "x")] * 10 + [("cc dd", "y")] * 10)
    grams = np.concatenate(list(language.buckets("aa dd")))
    assert np.allclose(model.logits("aa dd"), model.table[grams].mean(0) + model.bias, atol=1e-5)


def test_toxicity_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in entry.queries()["op10_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in cases.table(spark, "/root/testdata/sf0.1", "labels")}
    held = [k for k in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] for k in held)
    toxic = [got[k]["predicted"] for k in held if labels[k]]
    clean = [got[k]["predicted"] for k in held if not labels[k]]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.005
    assert all((r["score"] >= 0.5) == r["predicted"] and 0 <= r["score"] <= 1 for r in got.values())


def test_ftrl_finds_the_words_and_stays_sparse():
    r = np.random.default_rng(0)
    texts = [" ".join(f"w{i}" for i in r.integers(0, 300, 40)) for _ in range(800)]
    labels = [int(i % 8 == 0) for i in range(800)]
    texts = [t + (" nasty, words" if y else " words") for t, y in zip(texts, labels)]
    model = toxicity.fit((toxicity.distinct(t), y) for t, y in zip(texts, labels))
    words, dense = toxicity.Words(limit=20), model.dense()
    score = [toxicity.score_text(words, dense, model.bias, t) for t in texts]
    assert all((s >= 0.5) == bool(y) for s, y in zip(score, labels))
    assert len(model.at) < 200
    assert toxicity.score_text(words, dense, model.bias, "NASTY nasty (nasty)") > 0.3


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(5, 0), (6, 1), (6, 0), (7, 0), (None, 1), (8, None), (99, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(cases.odd(spark), labels, toxicity.F.lit(True))
    rows = toxicity.score(cases.odd(spark), model).collect()
    assert len(rows) == len(cases.ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (5, 6)}) == 1  # equal texts, equal scores
    none = toxicity.train(cases.empty(spark), labels.where("false"), toxicity.F.lit(True))
    assert {round(r["score"], 6) for r in toxicity.score(cases.odd(spark), none).collect()} == {toxicity.EMPTY_SCORE}
    assert toxicity.score(cases.empty(spark), model).count() == 0
