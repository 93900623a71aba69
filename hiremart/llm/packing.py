"""Packing documents into fixed windows by minimum bin slack.

Whole windows are cut from long documents first, which leaves at most one remainder shorter than a
window for each document. Windows are then planned on the *counts of remainder lengths*, a table of
fewer than ``window`` rows however large the corpus is: each step takes the longest length left,
finds by subset-sum dynamic programming over bitsets the multiset of lengths that comes closest to
the capacity, backtracks how many of each it holds, and repeats that window as often as the counts
allow. Documents find their place in the plan by their rank among those of the same length, which
comes from per-bucket counts, so a length that a third of all documents share is spread over tasks.

Windows that the dynamic programme cannot fill are not padded: their contents are laid end to end and
cut at window borders, and the last, incomplete window is cut into powers of two, which need no
padding. Null texts count as empty (one end token), repeated rows are packed each, an empty table
gives no piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from hiremart.llm.common import map_rows, text_of
from hiremart.llm.word_tokens import worker_ids
from hiremart.sources.scratch import Scratch

END = 1
_PIECE = ("{id}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


def fullest(counts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(length, copies) of a multiset with the longest length left and the least slack in ``window``."""
    lengths = [int(n) for n in np.flatnonzero(counts)[::-1]]
    mask, full = (1 << window + 1) - 1, 1 << window
    reach, before = 1 << lengths[0], []  # bit s: some choice so far sums to s
    for at, length in enumerate(lengths):
        before.append(reach)
        left = min(int(counts[length]) - (at == 0), window // length)
        step = 1
        while left and not reach & full:  # 1, 2, 4, ... copies reach every number up to ``left``
            step = min(step, left)
            reach |= reach << step * length & mask
            left -= step
            step *= 2
        if reach & full:
            break
    total, copies = reach.bit_length() - 1, {lengths[0]: 1}
    for at in range(len(before) - 1, -1, -1):
        while not before[at] >> total & 1:
            total -= lengths[at]
            copies[lengths[at]] = copies.get(lengths[at], 0) + 1
    return sorted(copies.items(), reverse=True)


@dataclass
class Plan:
    """Where the remainders of each length go, by their rank among their length.

    Row i of ``length``: ranks from ``first`` on fill ``copies`` places a window at ``offset``; the
    windows are numbered from ``base``. ``loose`` rows lie in a stream of ``fill`` tokens a window.
    """

    length: np.ndarray
    first: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    base: np.ndarray
    fill: np.ndarray
    loose: np.ndarray
    windows: int
    stream: int

    def place(self, length: int, rank: int) -> tuple[int, int, bool]:
        """(window, offset) of a remainder, or (0, place in the stream) of a loose one."""
        lo, hi = np.searchsorted(self.length, [length, length + 1])
        i = lo + int(np.searchsorted(self.first[lo:hi], rank, "right")) - 1
        turn, copy = divmod(rank - int(self.first[i]), int(self.copies[i]))
        offset = int(self.offset[i]) + copy * length
        if self.loose[i]:
            return 0, int(self.base[i]) + turn * int(self.fill[i]) + offset, True
        return int(self.base[i]) + turn, offset, False


def plan_windows(counts: np.ndarray, window: int) -> Plan:
    """The windows for ``counts[length]`` remainders of each length."""
    left, used = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    rows, windows, stream = [], 0, 0
    while left.any():
        chosen = fullest(left, window)
        times = min(int(left[n]) // c for n, c in chosen)
        fill = sum(n * c for n, c in chosen)
        loose, offset = fill < window, 0
        for n, c in chosen:
            rows.append((n, int(used[n]), c, offset, stream if loose else windows, fill, loose))
            offset += n * c
            left[n] -= c * times
            used[n] += c * times
        if loose:
            stream += fill * times
        else:
            windows += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 7).T
    return Plan(*table, windows=windows, stream=stream)


def stream_cuts(start: int, end: int, stream: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(place, sequence, offset) of the parts of a stretch of the stream.

    The stream is cut every ``window`` tokens, its last part into descending powers of two.
    """
    body = stream // window
    while start < end:
        if start < body * window:
            sequence, offset = divmod(start, window)
            size = window
        else:
            sequence, at, rest = body, body * window, stream - body * window
            while True:
                size = 1 << rest.bit_length() - 1
                if start < at + size:
                    break
                at, rest, sequence = at + size, rest - size, sequence + 1
            offset = start - at
        stop = min(end, start + size - offset)
        yield start, sequence, offset
        start = stop


def _short(ids: np.ndarray) -> bytes:
    """Ids in 16 bits each."""
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError(f"token id {ids.max()} does not fit 16 bits")
    return ids.astype("<u2").tobytes()


def tokenise(docs: DataFrame, path: str, id_column: str) -> DataFrame:
    """(id, ids, doc_tokens): ids with the end token, as little-endian unsigned 32-bit integers."""
    end = END.to_bytes(4, "little")

    def run(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokens = worker_ids(path)
        for block in blocks:
            ids = [tokens.ids(t) + end for t in block["text"]]
            yield {"_id": block["_id"], "ids": [_short(np.frombuffer(i, "<u4")) for i in ids],
                   "doc_tokens": [len(i) // 4 for i in ids]}

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), text_of().alias("text"))
    return map_rows(rows, run, f"_id {kind}, ids binary, doc_tokens bigint")


def pack(docs: DataFrame, path: str, window: int = 2048, id_column: str = "doc_id",
         scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``path`` is a tokenizer file whose ids fit 16 bits, in which they are kept between the passes; others are refused.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    staged = scratch.stage(tokenise(docs, path, id_column).withColumn("_row", F.monotonically_increasing_id()))
    rest = F.pmod("doc_tokens", F.lit(window))
    sizes = staged.select("_row", (F.col("_row").bitwiseAND(4095)).alias("_bucket"), rest.alias("_rest"),
                          F.floor(F.col("doc_tokens") / window).alias("_full"))
    # Ranks within a length, and within all documents for the whole windows: first by bucket, then inside.
    by_bucket = sizes.groupBy("_rest", "_bucket").agg(F.count("*").alias("_n"), F.sum("_full").alias("_f"))
    by_bucket = scratch.stage(by_bucket)
    whole = {r["_rest"]: (r["n"], r["f"]) for r in by_bucket.groupBy("_rest").agg(
        F.sum("_n").alias("n"), F.sum("_f").alias("f")).collect()}  # fewer than ``window`` rows
    counts = np.zeros(window, np.int64)
    first_full, full = {}, 0
    for length, (n, f) in sorted(whole.items()):
        counts[length], first_full[length], full = (n if length else 0), full, full + f
    plan = spark.sparkContext.broadcast(plan_windows(counts, window))
    earlier = Window.partitionBy("_rest").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_bucket.select("_rest", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
                              F.coalesce(F.sum("_f").over(earlier), F.lit(0)).alias("_f0"))
    inside = Window.partitionBy("_rest", "_bucket").orderBy("_row")
    ranked = sizes.select(
        "_row", "_rest", "_bucket", (F.row_number().over(inside) - 1).alias("_r"),
        (F.sum("_full").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_full")).alias("_f"))
    ranked = ranked.join(starts, ["_rest", "_bucket"]).select(
        "_row", (F.col("_r") + F.col("_n0")).alias("_rank"), (F.col("_f") + F.col("_f0")).alias("_before"))

    def pieces(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        layout: Plan = plan.value
        loose_from = full + layout.windows
        for block in blocks:
            out = []
            for key, ids, tokens, rank, before in zip(*(block[c] for c in (
                    "_id", "ids", "doc_tokens", "_rank", "_before"))):
                ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                body, length = divmod(tokens, window)
                cuts = [(i * window, first_full[length] + before + i, 0) for i in range(body)]
                if length:
                    sequence, offset, loose = layout.place(length, rank)
                    if loose:
                        cuts += [(body * window + at - offset, loose_from + s, o) for at, s, o in stream_cuts(
                            offset, offset + length, layout.stream, window)]
                    else:
                        cuts.append((body * window, full + sequence, offset))
                ends = [c[0] for c in cuts[1:]] + [tokens]
                out += [(key, c[0], e - c[0], ids[4 * c[0]:4 * e], tokens, c[1], c[2]) for c, e in zip(cuts, ends)]
            yield dict(zip(names, map(list, zip(*out)) if out else ([] for _ in names)))

    names = ["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema[id_column].dataType.simpleString()
    joined = staged.join(ranked, "_row").select("_id", "ids", "doc_tokens", "_rank", "_before")
    return map_rows(joined, pieces, _PIECE.format(id=f"_id {kind}")).withColumnRenamed("_id", id_column)


def with_crc(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ids_crc32 in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")

