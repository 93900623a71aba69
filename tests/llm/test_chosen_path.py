"""Near-duplicate classes against exhaustive comparison."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
from hiremart.llm import chosen_path
from hiremart.sources.scratch import Scratch
from tests.conftest import SF
from tests.llm import cases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, words, percent=80):
    """{position: (size, smallest id of the class)} of rows (id, text)."""
    sets = []
    for key, text in rows:
        w = cases.WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return [(len(s), low.get(root(i)) if rows[i][0] is not None else None) for i, s in enumerate(sets)]


def test_classes_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in cases.table(spark, SF)]
    got = {r["doc_id"]: r for r in entry.queries()["op4_chosen_path"](spark, SF).collect()}
    for (key, _), (size, low) in zip(rows, brute(rows, 4)):
        assert (got[key]["n_shingles"], got[key]["component_id"], got[key]["kept"]) == (size, low, key == low)


def near_copies(n, seed=5, size=120, edits=6):
    """A crowd of near copies of one text, each a few edits away from an earlier one, and loners."""
    r = random.Random(seed)
    crowd = [[f"w{r.randrange(400)}" for _ in range(size)]]
    while len(crowd) < n:
        text = list(r.choice(crowd[-30:]))
        for _ in range(r.randrange(1, edits)):
            text[r.randrange(size)] = f"x{r.randrange(10_000)}"
        crowd.append(text)
    loners = [[f"w{r.randrange(400)}" for _ in range(size)] for _ in range(n // 4)]
    rows = [" ".join(t) for t in crowd + loners + crowd[::7]]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("leaf", [2_000, 60])
def test_crowds_of_near_copies(spark, leaf):
    rows = near_copies(220)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           chosen_path.near_duplicates(docs, words=4, leaf=leaf).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows, 4)


def classes(spark, sets, leaf):
    rows = [(i, " ".join(words)) for i, words in enumerate(sets)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           chosen_path.near_duplicates(docs, words=1, leaf=leaf).collect()}
    return [got[i] for i in range(len(rows))], brute(rows, 1)


def test_star_of_near_copies(spark):
    """Each copy is at 0.82 to its template and below 0.8 to all other copies: one missed pair parts it."""
    r = random.Random(3)
    template = [f"w{i}" for i in range(100)]
    star = [template] + [r.sample(template, 90) + [f"c{n}x{k}" for k in range(10)] for n in range(1_100)]
    got, want = classes(spark, star, leaf=60)
    assert got == want and {low for _, low in want} == {0}


def test_pairs_in_branched_nodes(spark, monkeypatch):
    """Pairs at 0.82 among texts that share a fifth of their words, in nodes of three and more levels."""
    levels, branched = [], chosen_path._branched
    monkeypatch.setattr(chosen_path, "_branched", lambda *a: levels.append(1) or branched(*a))
    shared, sets = [f"s{i}" for i in range(30)], []
    for n in range(500):
        one = shared + [f"p{n}x{i}" for i in range(60)]
        sets += [one, one[:81] + [f"q{n}x{i}" for i in range(9)]]
    got, want = classes(spark, sets, leaf=6)
    assert got == want and len({low for _, low in want}) == 500
    assert len(levels) >= 3


def test_nodes_that_cannot_be_split_are_compared_in_blocks(spark):
    big = spark.range(40).selectExpr("0 as _tree", "7L as _node", "id as _v", "40L as _size")
    nodes = {}
    for r in chosen_path._blocks(big, 16).collect():
        nodes.setdefault(r["_node"], set()).add(r["_v"])
    together = {(a, b) for members in nodes.values() for a in members for b in members}
    assert len(together) == 40 * 40
    assert max(map(len, nodes.values())) < 40


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 150), (150, 170)]
    found = chosen_path.components(spark.createDataFrame(edges, "_a bigint, _b bigint"), Scratch(spark))
    got = {r["_v"]: r["_root"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(61)}, 150: 150, 170: 150, 200: 150}


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in cases.ODD_ROWS]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in
                 chosen_path.near_duplicates(cases.odd(spark), words=5).collect())
    want = sorted((str(k), n, str(low), k is None or k == low) for (k, _), (n, low) in zip(rows, brute(rows, 5)))
    assert got == want
    assert chosen_path.near_duplicates(cases.empty(spark)).count() == 0
