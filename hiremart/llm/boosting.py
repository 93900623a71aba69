"""Gradient-boosted trees in numpy: softmax loss, trees that ask one question a level."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH, ROUNDS, RATE, BINS, RIDGE = 5, 30, 0.3, 20, 1.0


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Boosted:
    feature: np.ndarray  # tree x level
    limit: np.ndarray  # tree x level
    value: np.ndarray  # tree x leaf
    classes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        out, columns = np.zeros((len(x), self.classes)), np.ascontiguousarray(x.T)
        for t in range(len(self.value)):
            leaf = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                leaf = leaf * 2 + (columns[self.feature[t, level]] > self.limit[t, level])
            out[:, t % self.classes] += self.value[t][leaf]
        return out

    def log_probability(self, x: np.ndarray) -> np.ndarray:
        s = self.scores(x)
        s -= s.max(1, keepdims=True)
        return s - np.log(np.exp(s).sum(1, keepdims=True))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int) -> Boosted:
    """Newton steps on the softmax loss over histogram bins, one tree for each class a round."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = [np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)]  # bin > k: x > edge k
    target, score = np.eye(classes)[y], np.zeros((n, classes))
    trees: list[tuple[list[int], list[float], np.ndarray]] = []
    for _ in range(ROUNDS):
        p = softmax(score)
        for c in range(classes):
            g, h = weight * (p[:, c] - target[:, c]), weight * np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            leaf, chosen, limits = np.zeros(n, np.int64), [], []
            for level in range(DEPTH):
                best = (-1.0, 0, 0)
                for f in range(width):
                    k = len(edges[f])
                    if not k:
                        continue
                    cell = leaf * (k + 1) + binned[f]
                    size = (1 << level) * (k + 1)
                    gs = np.bincount(cell, g, size).reshape(-1, k + 1)
                    hs = np.bincount(cell, h, size).reshape(-1, k + 1)
                    gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                    gr, hr = gs.sum(1, keepdims=True) - gl, hs.sum(1, keepdims=True) - hl
                    gain = (gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE)).sum(0)
                    at = int(gain.argmax())
                    if gain[at] > best[0]:
                        best = (float(gain[at]), f, at)
                _, f, at = best
                chosen.append(f)
                limits.append(float(edges[f][at]) if len(edges[f]) else np.inf)
                leaf = leaf * 2 + (binned[f] > at)
            value = -RATE * np.bincount(leaf, g, 1 << DEPTH) / (np.bincount(leaf, h, 1 << DEPTH) + RIDGE)
            score[:, c] += value[leaf]
            trees.append((chosen, limits, value))
    return Boosted(np.array([t[0] for t in trees]), np.array([t[1] for t in trees], np.float32),
                   np.array([t[2] for t in trees]), classes)
