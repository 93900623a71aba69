"""Main text of web pages by gradient-boosted trees over DOM elements.

Each element gets features of its subtree (text, link and punctuation density, size), attribute
tokens, depth, siblings and ancestors, and log probabilities of three states: article, boilerplate or
holder of both. Decoding is hierarchical: the states of a page are the likeliest ones of all elements
together in which boilerplate holds boilerplate only and an article holds article or boilerplate.
Text directly in article elements is kept; its blocks are joined.

The trees are fitted to SAMPLES pages of a seeded grammar of layouts (page_samples), with words from
WORDS words of about WORD_PAGES pages of the table. Null html counts as empty; a page without article text, or
without an element, gives an empty text; broken markup is read as far as it goes; null ids and
urls are passed on; repeated rows are extracted each. There is no limit on the length of a page.
"""

from __future__ import annotations

import html as entities
import re
import numpy as np
from pyspark.sql import DataFrame, functions as F

from hiremart.llm import boosting, dom, page_samples
from hiremart.llm.common import add_columns, bounded_share

SAMPLES, WORD_PAGES, WORDS, SEED = 800, 50, 5_000, 17
STATES = "cbm"
_MARK = re.compile(r'data-y="([cbm])"')
#: Allowed states of a child by the state of its parent: article, boilerplate, holder.
ALLOWED = ((0, 1), (1,), (0, 1, 2))


def sample_marks(page: dom.Page) -> list[int]:
    marks: list[int] = []
    for parent, attrs in zip(page.parent, page.attrs):
        m = _MARK.search(attrs)
        marks.append(STATES.index(m[1]) if m else marks[parent] if parent >= 0 else 2)
    return marks


def train(words: list[str], samples: int = SAMPLES, seed: int = SEED) -> boosting.Boosted:
    sampler = page_samples.Sampler(words, seed)
    pages = [dom.Page(sampler.page()) for _ in range(samples)]
    y = np.array([m for p in pages for m in sample_marks(p)])
    return boosting.fit(dom.features(pages), y, np.ones(len(y)), len(STATES))


def decode(parent: list[int], log_p: np.ndarray) -> list[int]:
    """Likeliest states of the elements of a page under the allowed pairs of parent and child."""
    total = log_p.tolist()
    for node in range(len(parent) - 1, 0, -1):
        c, b, m = total[node]
        up = total[parent[node]]
        best = c if c > b else b
        up[0] += best
        up[1] += b
        up[2] += m if m > best else best
    states = [2] * len(parent)
    for node in range(1, len(parent)):
        states[node] = max(ALLOWED[states[parent[node]]], key=total[node].__getitem__)
    return states


def main_text(page: dom.Page, states: list[int]) -> str:
    parts = [" " if node < 0 else text for node, text in page.segments if node < 0 or states[node] == 0]
    return " ".join(entities.unescape("".join(parts)).split())


def extract_all(model: boosting.Boosted, pages: list[str]) -> list[str]:
    read = [dom.Page(p) for p in pages]
    if not read:
        return []
    log_p, at, out = model.log_probability(dom.features(read)), 0, []
    for page in read:
        n = len(page.tag)
        out.append(main_text(page, decode(page.parent, log_p[at:at + n])))
        at += n
    return out


def sample_words(pages: DataFrame) -> list[str]:
    """WORDS words at most of about WORD_PAGES pages, without their markup; both drawn by hash."""
    few = bounded_share(pages.select("html").where("html is not null"), ["html"], WORD_PAGES)
    words = few.select(F.explode(F.split(F.regexp_replace("html", r"<[^>]*>|&[^;\s]*;?", " "), r"\s+")).alias("word"))
    words = words.where((F.length("word") < 30) & ~F.col("word").rlike("[<>&\"'=;]") & (F.col("word") != "")).distinct()
    return [r["word"] for r in words.orderBy(F.xxhash64("word"), "word").limit(WORDS).collect()]


def extract(pages: DataFrame, model: boosting.Boosted, keep: list[str], name: str = "text") -> DataFrame:
    """``keep`` columns of each row with its main text."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(raw: list[str]) -> list[tuple[str]]:
        texts, start, size = [], 0, 0
        for at, page in enumerate(raw):  # pages of about 4 MB at a time
            size += len(page)
            if size > 4 << 20:
                texts += extract_all(shared.value, raw[start:at + 1])
                start, size = at + 1, 0
        return [(t,) for t in texts + extract_all(shared.value, raw[start:])]

    return add_columns(pages, keep, F.coalesce("html", F.lit("")), run, f"{name} string")
