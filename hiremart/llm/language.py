"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the bag of its character 2- to 4-grams that hold no inner white space, white space at an
end standing for a word border. Each gram is hashed to one of 2**BITS embeddings; their mean goes
through a linear softmax. Embeddings and softmax are trained together by stochastic gradient descent
in numpy, on whole documents and random short stretches of them, so that short texts are told apart as well.
They come from a bounded sample: about ``TRAIN_ROWS`` documents drawn by a hash of their ids, a language's share
raised to LANGUAGE_ROWS if it has fewer, read whole and bagged where they are, taken in the order of that hash until their
bags fill ``TRAIN_BYTES``. One task fits; neither texts nor bags come to the driver.

A fifth of the sample is held back. It sets the temperature (least log loss) and, with foreign text, the rejection: a text
is accepted by how familiar it is, its largest logit. Models fitted without some of the languages show how familiar text of an unlearned
language gets against that of learned ones; the threshold keeps out FOREIGN_SHARE of it, but never more than
REJECT_SHARE of the held-back texts. Below three languages there is no foreign text, and that share alone is the threshold.

For prediction the two linear layers are multiplied out, so a worker holds one row of language
weights per bucket. Null texts and texts without a letter are ``und`` with score 0 and rejected.
Without training rows every text is. Repeated rows are predicted each.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from hiremart.llm.common import add_columns, made_in_task

BITS, WIDTH, GRAMS, SLICE = 15, 16, (2, 3, 4), 1 << 18
TRAIN_ROWS, TRAIN_BYTES, LANGUAGE_ROWS, EPOCHS = 4_000, 400_000_000, 200, 4
REJECT_SHARE, FOREIGN_SHARE, FOLDS, FOLD_ROWS = 0.001, 0.99, 4, 800
#: Languages whose share of the sample is set one by one; others are drawn like the whole.
LANGUAGES = 1_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all grams of a text, a slice of it at a time."""
    text = f" {' '.join(text.lower().split())} "
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[at:at + SLICE + GRAMS[-1] - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes, blank = codes.astype(np.uint64), codes == 32
        out = []
        for n in GRAMS:
            size = min(len(codes) - n + 1, SLICE)
            if size <= 0:
                continue
            h, inner = np.full(size, n, np.uint64), np.zeros(size, bool)
            for j in range(n):
                h = (h ^ codes[j:j + size]) * _MUL
                h ^= h >> np.uint64(29)
                if 0 < j < n - 1:
                    inner |= blank[j:j + size]
            if n == 2:
                inner |= blank[:size] & blank[1:size + 1]
            out.append((h[~inner] * _MUL >> np.uint64(64 - BITS)).astype(np.uint32))
        if out:
            yield np.concatenate(out)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = -np.inf  # least familiarity

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for at in buckets(text):
            total += self.table[at].sum(0, dtype=np.float64)
            n += len(at)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, accepted)."""
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        logits = self.logits(text)
        best = int(logits.argmax())
        return self.languages[best], float(softmax(logits / self.temperature)[best]), bool(logits[best] >= self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


Bag = tuple[np.ndarray, np.ndarray]  # buckets and their shares


def bag(text: str) -> Bag | None:
    parts = list(buckets(text))
    if not parts:
        return None
    at, n = np.unique(np.concatenate(parts), return_counts=True)
    return at.astype(np.uint16), (n / n.sum()).astype(np.float32)


def stretch(text: str, rng: np.random.Generator) -> Bag | None:
    """The bag of 1 to 24 words."""
    words = text.split()
    if not words:
        return None
    start, size = rng.integers(len(words)), rng.integers(1, 25)
    return bag(" ".join(words[start:start + size]))


def learn(rows: list[list[Bag | None]], target: list[int], classes: int, rng: np.random.Generator, epochs: int = EPOCHS,
          rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (bucket x class) and bias by gradient descent; a row is a whole text's bag and one for each epoch."""
    emb = rng.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, classes), np.float32), np.zeros(classes, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            for found in filter(None, (rows[i][0], rows[i][1 + epoch])):
                at, share = found
                mean = share @ emb[at]
                slope = softmax(mean @ out + bias)
                slope[target[i]] -= 1
                back = out @ slope
                out -= step * np.outer(mean, slope)
                bias -= 0.1 * step * slope
                emb[at] -= step * len(at) ** 0.5 * share[:, None] * back
    return (emb @ out).astype(np.float32), bias.astype(np.float64)


def logits_of(table: np.ndarray, bias: np.ndarray, bags: list[Bag]) -> np.ndarray:
    return np.array([share @ table[at] for at, share in bags]).reshape(len(bags), len(bias)) + bias


def foreign_ratio(rows: list, langs: list[str], held: list, held_langs: list[str], away: set[str], rng: np.random.Generator) -> float | None:
    """How familiar text of the languages ``away`` gets to a model without them, against the median of its own."""
    names = sorted(set(langs) - away)
    own = [i for i, n in enumerate(langs) if n not in away][:FOLD_ROWS]
    foreign = [row[0] for row, n in zip(rows, langs) if n in away and row[0]][:FOLD_ROWS]
    familiar = [b for b, n in zip(held, held_langs) if n not in away]
    if len(names) < 2 or not foreign or not familiar:
        return None
    table, bias = learn([rows[i] for i in own], [names.index(langs[i]) for i in own], len(names), rng, epochs=2)
    middle = np.median(logits_of(table, bias, familiar).max(1))
    return float(np.quantile(logits_of(table, bias, foreign).max(1), FOREIGN_SHARE) / middle) if middle > 0 else None


def bags(text: str) -> bytes:
    """What training needs of a text: its bag, one of a stretch for each epoch, and whether it has letters."""
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    return pickle.dumps([any(map(str.isalpha, text)), bag(text), *[stretch(text, rng) for _ in range(EPOCHS)]])


def fit(rows: Iterable[tuple[bytes, str]], most: int = TRAIN_BYTES, seed: int = 5) -> Model:
    """Train on four fifths of the (bags, language) rows, calibrate on the rest; ``most`` bounds the bytes of the bags."""
    rng, used, langs, held, held_langs, size = np.random.default_rng(seed), [], [], [], [], 0
    for at, (packed, lang) in enumerate(rows):
        lettered, *found = pickle.loads(packed)
        if at % 5 < 4:
            used.append(found)
            langs.append(lang)
        elif lettered and found[0]:
            held.append(found[0])
            held_langs.append(lang)
        size += len(packed)
        if size >= most:
            break
    languages = sorted(set(langs))
    table, bias = learn(used, [languages.index(n) for n in langs], len(languages), rng)
    model = Model(languages, table, bias)
    known = [i for i, n in enumerate(held_langs) if n in languages]
    if len(languages) > 1 and known:
        logits = logits_of(table, bias, [held[i] for i in known])
        truth = np.array([languages.index(held_langs[i]) for i in known])
        loss = {t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
                for t in np.geomspace(0.2, 8, 40)}
        model.temperature = float(min(loss, key=loss.get))
        own = logits.max(1)[logits.argmax(1) == truth]
        if len(own):
            model.threshold = float(np.quantile(own, REJECT_SHARE, method="lower"))
            folds = [set(languages[k::FOLDS]) for k in range(min(FOLDS, len(languages)))] if len(languages) > 2 else []
            ratios = [r for away in folds if (r := foreign_ratio(used, langs, held, held_langs, away, rng)) is not None]
            if ratios:
                model.threshold = min(model.threshold, max(ratios) * float(np.median(own)))
    return model


def train(docs: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``train_rows`` documents, among those that ``usable`` allows."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "lang").limit(LANGUAGES).collect()}
    whole = train_rows / max(1, sum(counts.values()))
    steps = 1 << 30
    parts = [v for lang, n in counts.items() if LANGUAGE_ROWS > whole * n for v in (F.lit(lang), F.lit(int(min(1, LANGUAGE_ROWS / n) * steps)))]
    share = F.coalesce(F.element_at(F.create_map(*parts), F.col("lang")), F.lit(int(min(1, whole) * steps))) if parts else F.lit(int(min(1, whole) * steps))
    drawn = known.select("doc_id", "text", "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < share)
    bagged = add_columns(drawn, ["doc_id", "lang"], F.col("text"), lambda texts: [(bags(t),) for t in texts], "bags binary")
    return made_in_task(bagged, [F.xxhash64("doc_id"), F.xxhash64("bags"), F.col("doc_id")], lambda blocks: fit(
        row for b in blocks for row in zip(b["bags"], b["lang"])))


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None,
            names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """``keep`` columns (doc_id by default) of each row with language, score and whether it is accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str | None]) -> list[tuple[str, float, bool]]:
        return [shared.value.predict(t) for t in texts]

    return add_columns(docs, keep or ["doc_id"], F.col("text"), run,
                       "{} string, {} double, {} boolean".format(*names))
