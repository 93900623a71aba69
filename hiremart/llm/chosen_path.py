"""Near-duplicate classes by a chosen-path set similarity join.

A document is the set of its word shingles; it is embedded as COORDINATES minwise tokens. Each of
TREES trees puts all sets into nodes by the minwise token at one coordinate. A pair of similarity s is
together in a root with probability s, so all TREES miss a pair at the threshold with probability
0.2**10 = 1e-7. A node of more than ``leaf`` sets is branched by two further coordinates, drawn from the
hash of the node itself and never one that its path has seen, so that neither trees nor nodes share their
choices. A node that this does not shrink well (its children hold more than half of its pairs: two of
its sets agree at a coordinate with probability above 1/4) is not branched but compared in blocks, whole.
So a tree keeps a pair below its root with probability 1 in nodes compared whole, and in branched ones with q,
where q(0) = 1, q(k + 1) = 1 - (1 - s q(k))**2: 0.96 on one level and never below 0.9375 at s = 0.8, whatever the
depth. Over the spread of a pair's agreement on the 54 coordinates that nodes draw from, all trees miss a pair at
the threshold with 7e-7, 1.7e-6, 2.9e-6 on one to three levels, 8.6e-6 on ten and 1.2e-5 on all 27. Nodes of at
most ``leaf`` sets are compared exhaustively: pairs whose signatures agree in less than ESTIMATE of their coordinates
are passed over (at similarity 0.8 that has probability 1e-8), the others are confirmed on their full shingle sets.

Equal sets are one vertex from the start, a pair is compared in the first root compared whole that it
shares, and a node gives a spanning forest of its links only, so copies are never expanded into pairs
and sets of one class are not compared again in a node. Blocks make the work of a node grow with the square
of its different sets, which is what exactness costs where no coordinate tells the sets apart.

Results are classes of documents: texts without words and rows without id are linked with nothing
(an id of null stays null and is kept), rows with equal texts are in
one class, rows that share only their id are not, and the smallest id of a class stands for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from hiremart.llm.common import map_rows, text_of
from hiremart.sources.scratch import Scratch

COORDINATES, TREES, LEAF, ESTIMATE = 64, 10, 4_096, 0.5
#: Most bits for the shared hashes of a node; beyond that its sets are compared as sorted arrays.
_BITS = 1 << 26
_LEVELS = (COORDINATES - TREES) // 2
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int, limit: int = 100_000) -> None:
        self.words, self.limit, self.known = words, limit, {}

    def of(self, text: str) -> np.ndarray:
        # Bytes lower and split by ASCII rules: A-Z, and white space \x20 \x09-\x0D.
        chunks, known = text.encode("utf-8", "surrogatepass").lower().split(), self.known
        if not chunks:
            return np.zeros(0, np.uint64)
        found = list(map(known.get, chunks))
        if None in found:
            for at, h in enumerate(found):
                if h is None:
                    if len(known) >= self.limit:
                        known.clear()
                    found[at] = known[chunks[at]] = xxhash.xxh64_intdigest(chunks[at])
        h, n = np.array(found, np.uint64), min(self.words, len(chunks))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            out = (out ^ h[j:j + len(out)]) * _MUL
            out ^= out >> np.uint64(31)
        return np.unique(out * _MIX)


def signature(shingles: np.ndarray) -> bytes:
    """The minwise token at each coordinate, 32 bits of it."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[at:at + 4096, None] * _SEEDS).min(0))
    return (low >> np.uint64(32)).astype("<u4").tobytes()


_WORKER: dict[int, Shingles] = {}


def _shingles(words: int) -> Shingles:
    return _WORKER.setdefault(words, Shingles(words))


def digest(column: str = "text") -> Column:
    return F.unhex(F.sha2(text_of(column).cast("binary"), 256))


def _sketch(docs: DataFrame, words: int, id_column: str) -> DataFrame:
    """(_id, _text, _n, _key, _sig) of each row; equal sets have equal keys, ``_text`` is the digest of the text."""

    def run(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        make = _shingles(words)
        for block in blocks:
            sets = [make.of(t) for t in block["text"]]
            yield {"_id": block["_id"], "_text": block["_text"], "_n": [len(s) for s in sets],
                   "_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                   "_sig": [signature(s) if len(s) else b"" for s in sets]}

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), digest().alias("_text"), text_of().alias("text"))
    return map_rows(rows, run, f"_id {kind}, _text binary, _n bigint, _key binary, _sig binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int, id_column: str) -> DataFrame:
    """(_v, _set): full shingle sets of the wanted vertices (_v, _id, _key), from one of their rows each."""

    def run(blocks: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        make = _shingles(words)
        for block in blocks:
            out = []
            for v, key, text in zip(block["_v"], block["_key"], block["text"]):
                found = make.of(text)
                if xxhash.xxh3_128_digest(found.tobytes()) == key:
                    out.append((v, found.tobytes()))
            yield {"_v": [o[0] for o in out], "_set": [o[1] for o in out]}

    rows = docs.select(F.col(id_column).alias("_id"), text_of().alias("text")).join(wanted, "_id")
    return map_rows(rows.select("_v", "_key", "text"), run, "_v bigint, _set binary").dropDuplicates(["_v"])


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by node, regrouped so that no node is cut."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("_node").to_numpy()
        last = int(np.searchsorted(node, node[-1]))
        if last or kept and kept[-1].column("_node")[-1].as_py() != node[0]:
            yield pa.Table.from_batches([*kept, batch.slice(0, last)])
            kept = [batch.slice(last)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def _matrix(table: pa.Table) -> np.ndarray:
    joined = b"".join(table.column("_sig").to_pylist())
    return np.frombuffer(joined, "<u4").reshape(-1, COORDINATES)


def _pairs(node: np.ndarray, sig: np.ndarray, mask: np.ndarray, tree: np.ndarray,
           done: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of a node that may be similar, are not ``done`` and were not compared in an earlier root."""
    at, roots = np.arange(len(node)), np.ascontiguousarray(sig[:, :TREES])
    earlier = ((mask & ((1 << tree) - 1))[:, None] >> np.arange(TREES) & 1) > 0
    for step in range(1, len(node)):
        at = at[:np.searchsorted(at, len(node) - step)]
        at = at[node[at] == node[at + step]]
        if not len(at):
            break
        i = at[~done(at, at + step)]
        i = i[~((roots[i] == roots[i + step]) & earlier[i]).any(1)]
        i = i[(sig[i] == sig[i + step]).sum(1) >= ESTIMATE * COORDINATES]
        if len(i):
            yield i, i + step


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that are in some pair of their node."""
    for table in _nodes(batches):
        columns = [table.column(c).to_numpy() for c in ("_node", "_mask", "_tree")]
        chosen = np.zeros(table.num_rows, bool)
        both = lambda i, j: chosen[i] & chosen[j]
        for i, j in _pairs(columns[0], _matrix(table), columns[1], columns[2], both):
            chosen[i] = chosen[j] = True
        yield from table.select(["_tree", "_node", "_v"]).filter(pa.array(chosen)).combine_chunks().to_batches()


def _stretches(table: pa.Table, alone: int = 64) -> Iterator[pa.Table]:
    """Nodes of more than ``alone`` rows one by one, runs of smaller ones together."""
    _, starts, sizes = np.unique(table.column("_node").to_numpy(), return_index=True, return_counts=True)
    big = sizes > alone
    cuts = np.unique(np.concatenate([[0], starts[big], (starts + sizes)[big], [table.num_rows]]))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield table.slice(lo, hi - lo)


class _Common:
    """Sizes of the intersections of the sets of a node."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets, self.bits = sets, None
        if len(sets) > 8:
            # Only hashes that two sets share can be common: one bit for each of them.
            values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = np.cumsum(times > 1) - 1
            width = int(shared[-1]) + 1
            if len(sets) * width <= _BITS:
                row, many = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), (times > 1)[place]
                dense = np.zeros((len(sets), max(64, -(-width // 64) * 64)), bool)
                dense[row[many], shared[place[many]]] = True
                self.bits = np.packbits(dense, axis=1).view(np.uint64)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            return np.bitwise_count(self.bits[i] & self.bits[j]).sum(1, dtype=np.int64)
        out = np.zeros(len(i), np.int64)
        for n, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
            own, other = self.sets[a], self.sets[b]
            out[n] = np.count_nonzero(own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other)
        return out


def _links(percent: int):
    """Spanning forests of the confirmed links of each node."""

    def forest(table: pa.Table) -> Iterator[tuple[int, int]]:
        node, mask, tree, v = (table.column(c).to_numpy() for c in ("_node", "_mask", "_tree", "_v"))
        sets = [np.frombuffer(s, np.uint64) for s in table.column("_set").to_pylist()]
        size, part, common = np.array([len(s) for s in sets]), np.arange(len(sets)), {}
        first = np.searchsorted(node, node)  # where the row's node begins
        for i, j in _pairs(node, _matrix(table), mask, tree, lambda i, j: part[i] == part[j]):
            alike = 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            i, j = i[alike], j[alike]
            begins, cuts = np.unique(first[i], return_index=True)
            for lo, a, b in zip(begins.tolist(), np.split(i, cuts[1:]), np.split(j, cuts[1:])):
                hi = int(np.searchsorted(node, node[lo], "right"))
                if lo not in common:
                    common[lo] = _Common(sets[lo:hi])
                both, own = common[lo].of(a - lo, b - lo), part[lo:hi]
                right = 100 * both >= percent * (size[a] + size[b] - both)
                for x, y in zip(a[right].tolist(), b[right].tolist()):
                    if part[x] != part[y]:
                        own[own == part[y]] = part[x]
                        yield v[x], v[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _nodes(batches):
            for stretch in _stretches(table):
                out = list(forest(stretch))
                if out:
                    a, b = (np.array(side, np.int64) for side in zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["_a", "_b"])

    return run


def _token(coordinate: int | Column) -> Column:
    return F.substr(F.col("_sig"), F.lit(4 * coordinate + 1), F.lit(4))


def _branched(big: DataFrame, sets: DataFrame) -> DataFrame:
    """(_tree, _parent, _whole, _used, _v, _node): both children of each set of the nodes ``big``.

    The coordinates come from the node: its trees and nodes draw independently, never one in ``_used``.
    """
    def drawn(among: str, salt: int) -> Column:
        at = F.pmod(F.xxhash64("_tree", "_node", F.lit(salt)), F.size(among).cast("bigint"))
        return F.element_at(among, at.cast("int") + 1)

    rows = big.withColumn("_free", F.array_except(F.sequence(F.lit(TREES), F.lit(COORDINATES - 1)), "_used"))
    rows = rows.withColumn("_first", drawn("_free", 1)).withColumn("_free", F.array_remove("_free", F.col("_first")))
    pair = F.array("_first", drawn("_free", 2))
    rows = rows.select("_tree", F.col("_node").alias("_parent"), F.col("_size").alias("_whole"), "_v",
                       F.concat("_used", pair).alias("_used"), F.explode(pair).alias("_at"))
    return rows.join(sets, "_v").select("_tree", "_parent", "_whole", "_used", "_v", F.xxhash64(
        "_parent", "_at", _token(F.col("_at"))).alias("_node"))


def _leaves(sets: DataFrame, leaf: int, scratch: Scratch) -> DataFrame:
    """(_tree, _node, _v, _mask): the nodes to compare; _mask: the trees whose root with a set is compared whole."""
    roots = sets.select("_v", F.posexplode(F.array(*[
        F.xxhash64(F.lit(t), _token(t)) for t in range(TREES)])).alias("_tree", "_node"))
    sizes = roots.groupBy("_tree", "_node").agg(F.count("*").alias("_size")).where("_size > 1")
    level = scratch.stage(roots.join(sizes, ["_tree", "_node"]))
    small = F.col("_size") <= leaf
    whole = found = level.where(small).select("_tree", "_node", "_v")
    big = level.where(~small).withColumn("_used", F.array().cast("array<int>"))
    for depth in range(_LEVELS):
        if big.isEmpty():
            break
        below = scratch.stage(_branched(big, sets))
        sizes = scratch.stage(below.groupBy("_tree", "_parent", "_node").agg(
            F.count("*").alias("_size"), F.max("_whole").alias("_whole")))
        square = lambda c: F.col(c).cast("double") * F.col(c)
        shrunk = sizes.groupBy("_tree", "_parent").agg((2 * F.sum(square("_size")) <= F.max(square("_whole"))).alias("_ok"))
        shrunk = shrunk.where("_ok").select("_tree", "_parent")
        hot = big.join(shrunk.withColumnRenamed("_parent", "_node"), ["_tree", "_node"], "left_anti")
        if depth == 0:
            whole = whole.unionByName(hot.select("_tree", "_node", "_v"))
        found = found.unionByName(_blocks(hot, leaf))
        level = scratch.stage(below.drop("_whole").join(
            sizes.where("_size > 1").drop("_whole"), ["_tree", "_parent", "_node"]).join(
            shrunk, ["_tree", "_parent"], "left_semi").select("_tree", "_node", "_v", "_size", "_used"))
        found = found.unionByName(level.where(small).select("_tree", "_node", "_v"))
        big = level.where(~small)
    else:
        found = found.unionByName(_blocks(big, leaf))
    masks = whole.groupBy("_v").agg(F.sum(F.expr("shiftleft(1, _tree)")).alias("_mask"))
    return found.join(masks, "_v", "left").withColumn("_mask", F.coalesce("_mask", F.lit(0)).cast("bigint"))


def _blocks(big: DataFrame, leaf: int) -> DataFrame:
    """Nodes that are not branched, as nodes for each pair of their blocks."""
    half = F.greatest(F.lit(1), F.ceil(F.col("_size") / (leaf // 2 or 1))).cast("int")
    rows = big.withColumn("_of", half).withColumn("_block", F.pmod(F.xxhash64("_v"), F.col("_of")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_of") - 1))
    rows = rows.select("*", other.alias("_other"))
    return rows.select("_tree", F.xxhash64("_node", F.least("_block", "_other"), F.greatest("_block", "_other"))
                       .alias("_node"), "_v")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(_v, _root): the smallest vertex reachable from each vertex of the edges (_a, _b)."""
    both = scratch.stage(edges.unionByName(edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))).distinct())
    found = scratch.stage(both.groupBy(F.col("_a").alias("_v")).agg(F.min("_b").alias("_l")).select(
        "_v", F.least("_v", "_l").alias("_root")))
    while True:
        near = both.join(found.withColumnRenamed("_v", "_b"), "_b").groupBy(F.col("_a").alias("_v")).agg(
            F.min("_root").alias("_near"))
        low = found.join(near, "_v").select("_v", F.least("_root", "_near").alias("_low"), F.col("_root").alias("_old"))
        low = scratch.stage(low)
        jump = low.select(F.col("_v").alias("_low"), F.col("_low").alias("_next"))
        step = scratch.stage(low.join(jump, "_low").select(
            "_v", F.least("_low", "_next").alias("_root"), "_old"))
        if step.where("_root <> _old").isEmpty():
            return step.select("_v", "_root")
        found = step.select("_v", "_root")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, leaf: int = LEAF,
                    id_column: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_sha256, first) for each row of ``docs`` (id, text).

    ``first`` marks the rows that stand for their class: those with the smallest id and, among these, text digest.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.stage(_sketch(docs, words, id_column))
    sets = scratch.stage(rows.where("_n > 0 and _id is not null").groupBy("_key").agg(
        F.min(F.struct("_id", "_text")).alias("_first"), F.any_value("_sig").alias("_sig")).select(
        "_key", F.col("_first._id").alias("_id"), "_first", "_sig", F.monotonically_increasing_id().alias("_v")))
    tokens = sets.select("_v", "_sig")
    leaves = scratch.stage(_leaves(tokens, leaf, scratch))
    by_node = lambda df: df.repartition("_node").sortWithinPartitions("_node", "_v")
    marked = scratch.stage(by_node(leaves.join(tokens, "_v")).mapInArrow(
        _candidates, "_tree int, _node bigint, _v bigint"))
    wanted = sets.select("_v", "_id", "_key").join(marked.select("_v").distinct(), "_v", "left_semi")
    full = scratch.stage(_full_sets(docs, wanted, words, id_column))
    full_rows = marked.join(leaves.select("_tree", "_node", "_v", "_mask"), ["_tree", "_node", "_v"]).join(
        tokens, "_v").join(full, "_v")
    links = scratch.stage(by_node(full_rows).mapInArrow(_links(percent), "_a bigint, _b bigint").distinct())
    roots = components(links, scratch)
    members = sets.select("_v", "_first", "_key").join(roots, "_v", "left").withColumn("_root", F.coalesce("_root", "_v"))
    lowest = members.groupBy("_root").agg(F.min("_first").alias("_least"))
    classes = members.join(lowest, "_root").select("_key", "_least")
    out = rows.select("_id", "_text", "_n", F.when(F.col("_id").isNotNull() & (F.col("_n") > 0), F.col("_key")).alias("_key"))
    out = out.join(classes, "_key", "left").withColumn("_component", F.coalesce("_least._id", "_id"))
    return out.select(F.col("_id").alias(id_column), F.col("_n").alias("n_shingles"),
                      F.col("_component").alias("component_id"),
                      F.coalesce(F.col("_id") == F.col("_component"), F.lit(True)).alias("kept"), F.col("_text").alias("text_sha256"),
                      F.coalesce(F.struct("_id", "_text") == F.col("_least"), F.lit(True)).alias("first"))
