"""Base statistics against a plain version; the robust estimate against numpy and the labelled documents."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

import __spark_entry__ as entry
from hiremart.llm import quality
from hiremart.sources.scratch import Scratch
from tests.conftest import SF
from tests.llm import cases


def plain(text):
    text = text or ""
    w = cases.WORD.findall(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if cases.WORD.search(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_table(spark):
    got = {r["doc_id"]: r for r in entry.queries()["op3_quality"](spark, SF).collect()}
    for r in cases.table(spark, SF):
        stats = plain(r["text"])
        found = got[r["doc_id"]]
        assert tuple(found[s] for s in quality.STATS) == stats
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert found["base_failed"] == failed and not (failed and found["kept"])
    labels = {r["doc_id"]: r["quality"] for r in cases.table(spark, SF, "labels")}
    clean = [got[k]["kept"] for k, q in labels.items() if q and not got[k]["base_failed"]]
    assert sum(clean) >= 0.98 * len(clean)


def test_estimate_equals_numpy(spark):
    r = np.random.default_rng(2)
    n, p = 900, len(quality.FEATURES)
    mix = r.normal(size=(p, p))
    x = r.normal(size=(n, p)) @ mix
    x[:150] += 25  # a sixth of the rows are far off
    rows = spark.createDataFrame([("g", *map(float, v)) for v in x], ["_group", *quality.FEATURES]).repartition(4)
    got = quality.mcd(rows, Scratch(spark)).collect()[0]

    floors = np.diag(np.square(quality.FLOORS))
    mid = np.quantile(x, 0.5, axis=0, method="inverted_cdf")
    mad = np.quantile(np.abs(x - mid), 0.5, axis=0, method="inverted_cdf")
    mean, cov = mid, np.diag((1.4826 * mad) ** 2) + floors

    def distance():
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    for _ in range(quality.STEPS):
        d = distance()
        core = x[d <= np.quantile(d, quality.CORE, method="inverted_cdf")]
        mean, cov = core.mean(0), np.cov(core.T, bias=True) + floors
    low = np.linalg.cholesky(cov)
    assert np.allclose([got[f"m{i}"] for i in range(p)], mean)
    assert np.allclose([[got[f"l{i}{j}"] if j <= i else 0 for j in range(p)] for i in range(p)], low)
    scale = max(1.0, np.quantile(distance(), 0.5, method="inverted_cdf") / quality.CHI_MEDIAN)
    assert np.isclose(got["_scale"], scale)
    assert (distance()[:150] / scale > quality.CUTOFF).all() and (distance()[150:] / scale < quality.CUTOFF).mean() > 0.99


def test_one_extreme_statistic_is_enough(spark):
    r = np.random.default_rng(8)
    word = lambda: "".join(r.choice(list("abcdefghijklmnop"), 5))

    def lines(words, size=10):
        return "\n".join(" ".join(words[i:i + size]) for i in range(0, len(words), size))

    clean = [lines([word() for _ in range(int(r.integers(100, 140)))]) for _ in range(300)]
    names, short, grams = [word() for _ in range(7)], [], set()
    while len(short) < 120:  # lines of one word each, no three of them in the same order twice
        free = [w for w in names if (*short[-2:], w) not in grams]
        short.append(str(r.choice(free or [word()])))
        grams.add(tuple(short[-3:]))
    phrase = [word() for _ in range(3)]
    repeated = [w for _ in range(20) for w in (*phrase, word(), word(), word())] + [word(), word(), word()]
    marked = [w[:4] + "#" if i % 20 < 9 else w for i, w in enumerate(word() for _ in range(120))]
    odd = ["\n".join(short), lines(repeated, 11), lines(marked)]
    found = [plain(t) for t in odd]
    assert [n[3] > 100 for n in found] == [True, False, False] and [n[4] > 50 for n in found] == [False, True, False]
    assert [n[2] > 50 for n in found] == [False, False, True] and all(100 * n[4] <= 50 * n[0] for n in found)
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + odd)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {x["doc_id"]: x["kept"] for x in quality.judge(docs).collect()}
    assert not any(kept[300 + i] for i in range(len(odd)))
    assert all(kept[i] for i in range(300))


def test_odd_rows(spark):
    for least in (1, 200):
        got = quality.judge(cases.odd(spark), least=least).collect()
        want = sorted((str(r[0]), *plain(r[1])) for r in cases.ODD_ROWS)
        assert sorted((str(r["doc_id"]), *(r[s] for s in quality.STATS)) for r in got) == want
        assert all(r["kept"] is not None for r in got)
    assert quality.judge(cases.empty(spark)).count() == 0


def test_no_python_on_executors(spark):
    plan = quality.text_stats(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Exchange"))
