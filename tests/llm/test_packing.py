"""Packing: every id once, windows gapless, and the slack of the plan against exhaustive search."""

from __future__ import annotations

import itertools
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from hiremart.llm import packing
from tests.conftest import SF
from tests.llm import cases

PATH = P.path("word_bpe_49k.json")


def check(rows, ids, window):
    """``rows`` pack ``ids`` (list of (key, ids)) whole, in gapless windows; gives the fill of each."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[str(r["doc_id"])].append(r)
        windows[r["sequence_id"]].append(r)
    assert sum(r["length"] for r in rows) == sum(len(i) for _, i in ids)
    for key, values in ids:
        own = [r for r in pieces[str(key)] if r["doc_tokens"] == len(values)]
        spans = {(r["start"], r["length"]) for r in own}
        assert sum(n for _, n in spans) >= len(values)
        for r in own:
            part = values[r["start"]:r["start"] + r["length"]]
            assert len(part) == r["length"] > 0
    fills = {}
    for key, parts in windows.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
        fills[key] = at
    assert sorted(fills) == list(range(len(fills)))
    return list(fills.values())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def tokens(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [packing.END]


def test_pack_of_the_table(spark, library):
    rows = entry.queries()["op2_packing"](spark, SF).collect()
    ids = {r["doc_id"]: tokens(library, r["text"]) for r in cases.table(spark, SF)}
    fills = check(rows, list(ids.items()), 2048)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert all(n & (n - 1) == 0 for n in fills)  # full, or a power of two: no padding at all
    assert len([n for n in fills if n < 2048]) <= 11


def test_odd_rows(spark, library):
    rows = packing.pack(cases.odd(spark), PATH, 64).collect()
    fills = check(rows, [(r[0], tokens(library, r[1])) for r in cases.ODD_ROWS], 64)
    assert all(n & (n - 1) == 0 for n in fills)
    assert packing.pack(cases.empty(spark), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_fullest_is_the_best_multiset(seed):
    r = np.random.default_rng(seed)
    window = 24
    counts = np.zeros(window, np.int64)
    for n in r.integers(1, window, 7):
        counts[n] += 1
    chosen = dict(packing.fullest(counts, window))
    longest = int(np.flatnonzero(counts)[-1])
    assert longest in chosen and all(c <= counts[n] for n, c in chosen.items())
    items = [n for n in range(window) for _ in range(counts[n])]
    best = max(sum(s) for k in range(1, len(items) + 1) for s in itertools.combinations(items, k)
               if sum(s) <= window and longest in s)
    assert sum(n * c for n, c in chosen.items()) == best


def test_plan_places_every_remainder_once():
    r = np.random.default_rng(1)
    window, counts = 64, np.zeros(64, np.int64)
    for n in r.integers(1, 64, 900):
        counts[n] += 1
    counts[33] += 2_000  # a hot length that never pairs up with itself
    plan, used = packing.plan_windows(counts, window), defaultdict(list)
    loose = []
    for n in range(1, window):
        for rank in range(int(counts[n])):
            w, at, stream = plan.place(n, rank)
            (loose if stream else used[w]).append((at, n))
    for parts in used.values():
        assert sum(n for _, n in parts) == window
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(sorted(parts)))
    loose.sort()
    assert sum(n for _, n in loose) == plan.stream
    assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(loose))
    assert len(used) == plan.windows


def test_stream_is_cut_into_windows_and_powers_of_two():
    seen = list(packing.stream_cuts(0, 2 * 64 + 45, 2 * 64 + 45, 64))
    assert [(s, o) for _, s, o in seen] == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 0)]
    assert [at for at, _, _ in seen] == [0, 64, 128, 160, 168, 172]
    assert list(packing.stream_cuts(60, 70, 173, 64)) == [(60, 0, 60), (64, 1, 0)]
