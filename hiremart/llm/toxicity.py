"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document is the set of its words, adjacent pairs and pairs with one word between, hashed into
2**BITS coordinates. Training keeps the per-coordinate sums of FTRL-proximal (its rates are per
coordinate, L1 leaves most weights at exactly zero), so the fitted model is a short list of
coordinates and weights that is broadcast, at most 2**BITS of them (8 MB). Scoring reads the whole text.

Training reads the whole texts of a bounded sample of labelled documents: about ``train_rows``, drawn by a hash of their ids,
hashed where they are, in the order of that hash and until their coordinates fill ``TRAIN_BYTES``. One task fits;
neither texts nor coordinates come to the driver. Rows with a null label or text are left out, equal ids count once with their highest label. Null and empty texts get the score
of the bias. Without any label the score is EMPTY_SCORE. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hiremart.llm.common import add_columns, bounded_share, made_in_task, text_of

BITS = 20
TRAIN_ROWS, TRAIN_BYTES, EMPTY_SCORE = 20_000, 400_000_000, 0.01
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
_A, _B, _C = (np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Words:
    """Hashes of words, lower-cased and without punctuation at their ends; kept up to a limit."""

    def __init__(self, limit: int = 100_000) -> None:
        self.limit, self.known = limit, {}

    def hashes(self, text: str) -> np.ndarray:
        chunks, known = text.split(), self.known
        found = list(map(known.get, chunks))
        if None in found:
            for at, h in enumerate(found):
                if h is None:
                    if len(known) >= self.limit:
                        known.clear()
                    word = chunks[at].lower()
                    found[at] = known[chunks[at]] = xxhash.xxh64_intdigest(
                        (word.strip(_EDGE) or word).encode("utf-8", "surrogatepass"))
        return np.array(found, np.uint64)

    def coordinates(self, text: str) -> np.ndarray:
        """Hashed coordinates of a text, with repetitions."""
        h, shift = self.hashes(text), np.uint64(64 - BITS)
        pair = (h[:-1] * _A ^ h[1:]) * _B
        skip = (h[:-2] * _B ^ h[2:]) * _C
        return np.concatenate([h * _A >> shift, pair >> shift, skip >> shift]).astype(np.uint32)


@dataclass
class Model:
    at: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << BITS, np.float32)
        full[self.at] = self.weight
        return full


def score_text(words: Words, dense: np.ndarray, bias: float, text: str) -> float:
    at = words.coordinates(text)
    at = np.unique(at[dense[at] != 0])
    return float(1 / (1 + np.exp(-np.clip(bias + dense[at].sum(dtype=np.float64), -35, 35))))


def fit_sets(sets: list[np.ndarray], labels: list[int], alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
        l2: float = 0.0, updates: int = 50_000, seed: int = 7) -> Model:
    """FTRL-proximal over sets of coordinates, one document at a time in a fixed random order, 3 to 20 times over (about ``updates``)."""
    n = len(sets)
    if not n:
        return Model(np.zeros(0, np.uint32), np.zeros(0, np.float32), float(np.log(EMPTY_SCORE / (1 - EMPTY_SCORE))))
    z, s = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = float(np.log((sum(labels) + 0.5) / (n - sum(labels) + 0.5)))
    bias_s, order = 1.0, np.random.default_rng(seed)
    for _ in range(min(20, max(3, updates // n))):
        for i in order.permutation(n):
            at = sets[i]
            zi, si = z[at], s[at]
            root = np.sqrt(si)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2))
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -35, 35))) - labels[i]
            z[at] = zi + g - (np.sqrt(si + g * g) - root) / alpha * w
            s[at] = si + g * g
            bias_s += g * g
            bias -= 0.05 * g / np.sqrt(bias_s)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(s)) / alpha + l2))
    at = np.flatnonzero(w)
    return Model(at.astype(np.uint32), w[at].astype(np.float32), bias)


def fit(rows: Iterable[tuple[bytes, int]], most: int = TRAIN_BYTES, **settings) -> Model:
    """Fit to (coordinates, label) rows, as many as fit ``most`` bytes of coordinates."""
    sets, labels, size = [], [], 0
    for coordinates, label in rows:
        sets.append(np.frombuffer(coordinates, np.uint32))
        labels.append(int(label > 0))
        size += len(coordinates)
        if size >= most:
            break
    return fit_sets(sets, labels, **settings)


def distinct(text: str) -> bytes:
    """The distinct coordinates of a text."""
    return np.unique(_WORDS.coordinates(text)).tobytes()


def train(docs: DataFrame, labels: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``train_rows`` labelled documents at most; ``usable`` says which ids may be used."""
    known = labels.where(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = bounded_share(known, ["doc_id"], train_rows)  # bounded, so it can be broadcast
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), "doc_id")
    hashed = add_columns(rows, ["doc_id", "toxic"], F.col("text"), lambda texts: [(distinct(t),) for t in texts], "at binary")
    return made_in_task(hashed, [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("at")], lambda blocks: fit(
        row for b in blocks for row in zip(b["at"], b["toxic"])))


_WORDS = Words()
_DENSE: dict[int, np.ndarray] = {}


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """``keep`` columns (doc_id by default) of each row with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = shared._jbroadcast.id()

    def run(texts: list[str]) -> list[tuple[float]]:
        if key not in _DENSE:
            _DENSE.clear()
            _DENSE[key] = shared.value.dense()
        return [(score_text(_WORDS, _DENSE[key], shared.value.bias, t),) for t in texts]

    return add_columns(docs, keep or ["doc_id"], text_of(), run, f"{name} double")
