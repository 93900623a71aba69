"""Merkle manifest of a dataset with a proof for every row, by pointer jumping.

Rows become leaves, ordered within their group (language); every ``FAN`` consecutive nodes become the hash of
their digests, level by level, until one is left: the group's subroot. Subroots, ordered by group, go on in
the same way up to the root. A proof holds, level by level, the siblings left and right of a row's node.

Proofs are not walked level by level. Every node holds the segment of siblings on its way to an ancestor, at
first its parent. A self-join gives each node its ancestor's segment and ancestor: the distance doubles, so
log2(depth) joins reach the root. Nodes above the leaves jump; the leaves, seven eighths of all nodes,
come in with the last join, a run of siblings at a time, as their own segment is just the rest of their run.
The few nodes near the root that many others jump to are a small table, which adaptive execution broadcasts
once its size is known; below, an ancestor has few enough to share a task.

Positions come from range partitions and their sizes (``dense_ids``), so a group that holds a third of all
rows is spread like any other. Null groups come first, as do null ids in their group; equal ids go by leaf, wholly equal rows
are leaves of their own. A lone leaf is its own subroot and a lone subroot the root, with no siblings there. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.operators.dense_ids import dense_ids
from hiremart.sources.scratch import Scratch

FAN = 8
_TOP = -1  # the tree of the subroots
_PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def written(value: Column) -> Column:
    """A value as its UTF-8 byte count and itself, so that fields can't run into each other; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(F.concat(*[written(f) for f in fields]))


def folded(start: Column, path: Column) -> Column:
    """What a leaf and the siblings of its path hash to."""
    return F.aggregate(path, start, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _segment(digests: Column, place: Column) -> Column:
    """The others of a run of digests, left and right of the one at ``place``."""
    return F.struct(F.array_join(F.slice(digests, F.lit(1), place), "").alias("left"),
                    F.array_join(F.slice(digests, place + 2, F.lit(FAN)), "").alias("right"))


def _runs(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, n, run, members, digests): every ``FAN`` consecutive nodes of (tree, n, place, hash)."""
    member = F.struct("place", "hash", *carried)
    runs = nodes.groupBy("tree", "n", F.floor(F.col("place") / FAN).alias("run")).agg(
        F.sort_array(F.collect_list(member)).alias("members"))  # FAN rows at most
    return runs.withColumn("digests", F.transform("members", lambda m: m["hash"]))


def _parents(runs: DataFrame) -> DataFrame:
    """Nodes of the next level. A lone node stays what it is."""
    return runs.select("tree", F.ceil(F.col("n") / FAN).alias("n"), F.col("run").alias("place"), F.when(
        F.col("n") == 1, F.col("digests")[0]).otherwise(digest(F.array_join("digests", ""))).alias("hash"))


def _node(tree: str, level: int | Column, place: str) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.struct(F.col(tree).alias("tree"), level.alias("level"), F.col(place).alias("place"))


def _climb(nodes: DataFrame, largest: int, level: int, scratch: Scratch) -> tuple[list[DataFrame], list[DataFrame], int]:
    """All levels above ``nodes``: by level links to parents (tree, level, place, up, segs) and tops (tree, level, hash); levels made."""
    links, tops, made = [], [], 0
    while True:
        tops.append(nodes.where("n = 1").select("tree", F.lit(level + made).alias("level"), "hash"))
        if largest == 1:
            break
        runs = scratch.stage(_runs(nodes.where("n > 1")))
        members = runs.select("tree", "digests", "run", F.posexplode("members").alias("at", "m"))
        links.append(members.select(
            "tree", F.lit(level + made).alias("level"), "m.place", _node("tree", level + made + 1, "run").alias("up"),
            F.array(_segment(F.col("digests"), F.col("at"))).alias("segs")))
        nodes, largest, made = _parents(runs), -(-largest // FAN), made + 1
    return links, tops, made


def _jump(links: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """Links to the root: each join doubles the distance of every node that is not there yet."""
    done = 1
    while done < distance:
        up = links.select(_node("tree", F.col("level"), "place").alias("key"), F.col("up").alias("next"),
                          F.col("segs").alias("more"), F.col("rest").alias("left"))
        jumped = links.where("rest > 0").join(up, F.col("up") == F.col("key")).select(
            "tree", "level", "place", F.col("next").alias("up"), F.concat("segs", "more").alias("segs"), F.col("left").alias("rest"))
        links, done = scratch.stage(links.where("rest = 0").unionByName(jumped)), done * 2
    return links


def manifest(leaves: DataFrame, scratch: Scratch, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """``leaves`` (group, order, leaf and any other columns) with subroot, root and path.

    ``path`` is an array of (left, right): the concatenated digests of the siblings on either side, from the
    leaf's run up to the root's.
    """
    others = [c for c in leaves.columns if c not in (group, order, "leaf")]
    rows = scratch.stage(leaves.select(
        F.col(f"`{group}`").alias("g"), F.col(f"`{order}`").alias("o"), F.col("leaf").alias("hash"), F.struct(
        F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("others")))
    placed = dense_ids(rows, ["g", "o", "hash"], "position", "bigint", scratch)
    groups = placed.groupBy("g").agg(F.min("position").alias("from"), F.count("*").alias("n"))
    groups = scratch.stage(dense_ids(scratch.stage(groups), ["g"], "tree", "bigint", scratch))
    size = groups.agg(F.max("n").alias("n"), F.count("*").alias("trees")).first()
    if not size["trees"]:
        return leaves.withColumns({"subroot": F.lit(""), "root": F.lit(""), "path": F.array().cast(_PATH)})
    of = groups.select(F.col("g").alias("_g"), "from", "n", "tree")
    nodes = placed.join(of, placed["g"].eqNullSafe(of["_g"])).withColumn("place", F.col("position") - F.col("from"))
    runs = scratch.stage(_runs(nodes, "o", "g", "others"))

    links, tops, _ = _climb(_parents(runs), -(-size["n"] // FAN), 1, scratch)
    subroots = scratch.stage(reduce(DataFrame.unionByName, tops)).withColumnsRenamed({"level": "depth", "hash": "subroot"})
    first = subroots.select(F.lit(_TOP).cast("bigint").alias("tree"), F.lit(size["trees"]).cast("bigint").alias("n"),
                            (F.col("tree") - 1).alias("place"), F.col("subroot").alias("hash"))
    high, top, height = _climb(first, size["trees"], 0, scratch)
    root = reduce(DataFrame.unionByName, top).first()["hash"]

    # ``rest`` is the distance from a link's ancestor to the root. Subroots are the lowest nodes of the top tree.
    depth = subroots.select("tree", "depth")
    table = [part.join(depth, "tree").withColumn("rest", F.col("depth") - F.col("level") - 1 + height).drop("depth") for part in links]
    for level, part in enumerate(high):
        part = part.withColumn("rest", F.lit(height - 1 - level))
        if level == 0:
            part = part.join(depth.withColumnRenamed("tree", "_tree"), F.col("place") == F.col("_tree") - 1).select(
                F.col("_tree").alias("tree"), F.col("depth").alias("level"), F.lit(0).cast("bigint").alias("place"), "up", "segs", "rest")
        table.append(part)
    whole = runs.join(subroots.select("tree", "subroot"), "tree")
    if table:
        table = _jump(scratch.stage(reduce(DataFrame.unionByName, table)), _levels(size["n"]) + height, scratch)
        start = table.where((F.col("level") == 1) & (F.col("tree") != _TOP)).select(
            F.col("tree").alias("_tree"), F.col("place").alias("_place"), "segs")
        whole = whole.join(start, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_place")), "left")
    else:
        whole = whole.withColumn("segs", F.lit(None).cast(_PATH))
    none = F.array().cast(_PATH)
    member = F.posexplode("members").alias("at", "m")
    own = F.when(F.col("n") == 1, none).otherwise(F.array(_segment(F.col("digests"), F.col("at"))))
    return whole.select("n", "digests", "segs", "subroot", member).select(
        F.col("m.g").alias(group), F.col("m.o").alias(order), F.col("m.hash").alias("leaf"), *[F.col(f"m.others.c{i}").alias(c) for i, c in enumerate(others)],
        "subroot", F.lit(root).alias("root"), F.concat(own, F.coalesce("segs", none)).alias("path"))


def _levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out
