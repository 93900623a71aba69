"""Cheapest repair of the turn structure of conversations, by a run-length dynamic programme.

A conversation is legal when its role initials read ``(s?(ua)+)?``. Turns may be kept (K), rerolled to user
or assistant (R), deleted (D) or inserted with empty text (I), at the costs below; blank turns and repeats of
an earlier turn must be deleted, truncated ones that stay cost one more. Of the cheapest repairs the one whose
initials, in order, are ASCII-least is taken; the initials determine it.

* Turns become symbols: role class and fault. Repeated rows travel as one row and a number; a repeat within
  a conversation is found by joining turns with the first turn of their (role, text digest).
* Symbols are range-partitioned by conversation and turn, so that a conversation of any length is spread over
  tasks. Equal consecutive symbols are one run. A symbol's edits are a min-plus matrix over the four states
  of the pattern; a run advances the cost vector by the cached binary powers of that matrix.
* Going back over the runs gives the cost of finishing from every state; going forward, choices are unrolled,
  halving a run until a turn is left. A segment of a conversation cut by a partition's border is one
  matrix to its neighbours: the vectors after it come from them, then it is unrolled from every state.
* Texts meet the choices in one stream sorted by conversation and turn. One task streams a conversation
  without holding it, since its digest can't be taken in parts.

Rows: null roles and texts count as one space, null turns come first, null conversation ids are one conversation.
Equal turns go by role, then by digest of the text. A conversation without rows isn't in the report; an
empty table gives none. Only the four columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

from hiremart.llm.common import map_rows
from hiremart.sources.scratch import Scratch

# Fixed values of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
INITIALS, LEGAL_PAIRS = "sua", {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

FAR = 1 << 60
#: States of the pattern: nothing yet, after s, after u, after a. What may follow, and how costly it is to stop.
NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
STOP = (0, FAR, FAR, 0)
STATES = range(4)
INTACT, UNWANTED, OPEN = range(3)  # a symbol is three times the role class plus one of these
_BLOCK = 1024

Matrix = tuple[tuple[int, ...], ...]
Runs = list[list[int]]  # [symbol, length]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(row[k] + b[k][t] for k in STATES) for t in STATES) for row in a)


def apply(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(row[k] + v[k] for k in STATES) for row in a)


def _follow(state: int) -> tuple[str, int]:
    """The role that an inserted or rerolled turn takes here, and the state after it."""
    return next((role, NEXT[role][state]) for role in "ua" if NEXT[role][state] is not None)


@lru_cache(None)
def inserts() -> Matrix:
    """Any number of inserted turns."""
    out = [[0 if s == t else FAR for t in STATES] for s in STATES]
    for s in STATES:
        at, cost = s, 0
        for _ in STATES:
            at, cost = _follow(at)[1], cost + INSERT
            out[s][at] = min(out[s][at], cost)
    return tuple(map(tuple, out))


@lru_cache(None)
def edits(symbol: int) -> dict[str, tuple[tuple[int | None, int], ...]]:
    """State and cost after each edit of a turn, by state."""
    role, fault = symbol // 3, symbol % 3
    more = TRUNCATED if fault == OPEN else 0
    out = {"D": tuple((s, DELETE) for s in STATES)}
    if fault != UNWANTED:
        if role < len(INITIALS):
            out["K"] = tuple((NEXT[INITIALS[role]][s], more) for s in STATES)
        out["R"] = tuple((_follow(s)[1], REROLE + more) for s in STATES)
    return out


@lru_cache(None)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2**k equal symbols."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    step = [[min((c for to, c in (e[s] for e in edits(symbol).values()) if to == t), default=FAR) for t in STATES]
            for s in STATES]
    return times(inserts(), tuple(map(tuple, step)))


def _bits(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def back(symbol: int, length: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost of finishing from before a run, given that from after it."""
    return reduce(lambda v, k: apply(power(symbol, k), v), _bits(length), after)


def run_matrix(runs: Runs) -> Matrix:
    one = tuple(tuple(0 if s == t else FAR for t in STATES) for s in STATES)
    return reduce(lambda m, r: reduce(lambda a, k: times(a, power(r[0], k)), _bits(r[1]), m), runs, one)


def finish() -> tuple[int, ...]:
    return apply(inserts(), STOP)


@lru_cache(1 << 16)
def _turn(symbol: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """Choices for one turn and the inserts before it: among the cheapest, the least initial each time."""
    here, out = back(symbol, 1, after), ""
    while True:
        options = {a: (to, c + after[to]) for a, e in edits(symbol).items() for to, c in [e[state]] if to is not None}
        to = _follow(state)[1]
        options["I"] = (to, INSERT + here[to])
        initial = min(a for a, (_, c) in options.items() if c == here[state])
        out, state = out + initial, options[initial][0]
        if initial != "I":
            return out, state


def unroll(symbol: int, length: int, state: int, after: tuple[int, ...]) -> Iterator[str | int]:
    """Choices over a run, then the state after it."""
    if length == 1:
        least = min(after)
        yield from _turn(symbol, state, tuple(c - least for c in after))
        return
    half = length // 2
    *first, state = unroll(symbol, half, state, back(symbol, length - half, after))
    yield from first
    yield from unroll(symbol, length - half, state, after)


def walk(runs: Runs, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """Choices over all runs from ``state``, and the state after them."""
    vectors = [after]
    for symbol, length in reversed(runs):
        vectors.append(back(symbol, length, vectors[-1]))
    out = []
    for (symbol, length), v in zip(runs, reversed(vectors[:-1])):
        *made, state = unroll(symbol, length, state, v)
        out += made
    return "".join(out), state


def closing(state: int) -> str:
    """The inserts after the last turn."""
    out = ""
    while STOP[state]:
        out, state = out + "I", _follow(state)[1]
    return out


def _illegal(a: int, b: int) -> bool:
    return max(a, b) >= len(INITIALS) or INITIALS[a] + INITIALS[b] not in LEGAL_PAIRS


def illegal_pairs(runs: Runs) -> int:
    within = sum((n - 1) * _illegal(s // 3, s // 3) for s, n in runs)
    return within + sum(_illegal(a[0] // 3, b[0] // 3) for a, b in zip(runs, runs[1:]))


# ---- from rows to symbols

def _turn_order(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("given"), turn.alias("turn"))


def turns(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest) with nulls replaced."""
    space = F.lit(" ")
    return rows.select(F.col("conv_id").alias("conv"), "turn", F.coalesce("role", space).alias("role"),
                       F.coalesce("text", space).alias("text")).withColumn(
        "digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def symbols(rows: DataFrame) -> DataFrame:
    """Distinct turns: (conv, turn, role, digest, n, head, rest), a symbol for the first of ``n`` equal rows and for the rest."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    is_open = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    narrow = turns(rows).select("conv", "turn", "role", "digest", blank.alias("blank"), is_open.alias("open"))
    narrow = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n"))
    first = narrow.where("not blank").groupBy("conv", "role", "digest").agg(F.min(_turn_order(F.col("turn"))).alias("_first"))
    first = first.select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "_first")
    joined = narrow.join(first, narrow["conv"].eqNullSafe(first["_conv"]) & (narrow["role"] == first["_role"])
                         & (narrow["digest"] == first["_digest"]), "left")
    seen = F.coalesce(_turn_order(F.col("turn")) > F.col("_first"), F.lit(False))
    initial = F.substring("role", 1, 1)
    role = reduce(lambda c, i: c.when(initial == INITIALS[i], i), range(len(INITIALS)), F.when(F.lit(False), 0)).otherwise(len(INITIALS)) * 3
    head = F.when(F.col("blank") | seen, UNWANTED).when(F.col("open"), OPEN).otherwise(INTACT)
    return joined.select("conv", "turn", "role", "digest", "blank", "n", (role + head).alias("head"), (role + UNWANTED).alias("rest"))


def tallies(found: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation."""
    unwanted, head = F.col("head") % 3 == UNWANTED, F.col("head") % 3
    return found.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(unwanted, F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.count_if(head == OPEN).alias("truncated"))


# ---- choices

_SEGMENT = ("slot int, cut boolean, audit string, cost bigint, illegal bigint, symbols array<int>, lengths array<bigint>, "
            "matrix array<bigint>, ends array<int>")


def _segments(rows: DataFrame) -> DataFrame:
    """Sorted symbols to one row for each conversation in a partition; whole ones are solved."""
    def made(conv, slot: int, runs: Runs, cut: bool) -> dict:
        row = {"conv": conv, "slot": slot, "cut": cut, "illegal": illegal_pairs(runs), "audit": None, "cost": None,
               "symbols": None, "lengths": None, "matrix": None, "ends": None}
        if cut:
            row |= {"symbols": [r[0] for r in runs], "lengths": [r[1] for r in runs],
                    "matrix": [c for line in run_matrix(runs) for c in line], "ends": [runs[0][0] // 3, runs[-1][0] // 3]}
        else:
            audit, state = walk(runs, 0, finish())
            row |= {"audit": audit + closing(state), "cost": apply(run_matrix(runs), finish())[0]}
        return row

    def run(blocks):
        out, runs, now, first = [], [], None, True
        for b in blocks:
            for conv, slot, head, rest, n in zip(b["conv"], b["slot"], b["head"], b["rest"], b["n"]):
                if runs and conv != now:
                    out.append(made(now, slot, runs, first))
                    runs, first = [], False
                now, at = conv, slot
                for symbol, length in ((head, 1), (rest, n - 1)):
                    if runs and runs[-1][0] == symbol:
                        runs[-1][1] += length
                    elif length:
                        runs.append([symbol, length])
            if len(out) >= _BLOCK:
                yield {k: [r[k] for r in out] for k in out[0]}
                out = []
        if runs:  # the last one may go on in the next partition
            out.append(made(now, at, runs, True))
        if out:
            yield {k: [r[k] for r in out] for k in out[0]}

    kind = rows.schema["conv"].dataType.simpleString()
    keys = ["conv", "turn", "role", "digest"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("slot", F.spark_partition_id())
    return map_rows(placed.select("conv", "slot", "head", "rest", "n"), run, f"conv {kind}, {_SEGMENT}")


def _square(flat: list[int]) -> Matrix:
    return tuple(tuple(flat[i:i + 4]) for i in range(0, 16, 4))


def _joined(cut: DataFrame, scratch: Scratch) -> DataFrame:
    """Conversations cut by partition borders: (conv, audit, cost, illegal). A conversation has a segment in a partition at most."""
    kind = cut.schema["conv"].dataType.simpleString()

    def in_order(df: DataFrame, *columns: str) -> DataFrame:
        return df.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("slot", *columns))).alias("parts"))

    def vectors(blocks):
        """The cost of finishing from after each segment."""
        for b in blocks:
            out = {"_conv": [], "_slot": [], "after": []}
            for conv, parts in zip(b["conv"], b["parts"]):
                after = finish()
                for part in reversed(parts):
                    for name, value in (("_conv", conv), ("_slot", part["slot"]), ("after", list(after))):
                        out[name].append(value)
                    after = apply(_square(part["matrix"]), after)
            yield out

    def walks(blocks):
        for b in blocks:
            out = {"conv": b["conv"], "slot": b["slot"], "illegal": b["illegal"], "ends": b["ends"], "audits": [], "states": [], "costs": []}
            for syms, lengths, after in zip(b["symbols"], b["lengths"], b["after"]):
                runs, after = list(zip(syms, lengths)), tuple(after)
                ways = [walk(runs, s, after) for s in STATES]
                out["audits"].append([w[0] for w in ways])
                out["states"].append([w[1] for w in ways])
                out["costs"].append(list(apply(run_matrix(runs), after)))
            yield out

    def choose(blocks):
        for b in blocks:
            out = {"conv": b["conv"], "audit": [], "cost": [], "illegal": []}
            for parts in b["parts"]:
                state, made = 0, []
                for part in parts:
                    made.append(part["audits"][state])
                    state = part["states"][state]
                borders = sum(_illegal(x["ends"][1], y["ends"][0]) for x, y in zip(parts, parts[1:]))
                out["audit"].append("".join(made) + closing(state))
                out["cost"].append(parts[0]["costs"][0])
                out["illegal"].append(borders + sum(part["illegal"] for part in parts))
            yield out

    after = map_rows(in_order(cut, "matrix"), vectors, f"_conv {kind}, _slot int, after array<bigint>")
    both = cut.join(after, cut["conv"].eqNullSafe(after["_conv"]) & (cut["slot"] == after["_slot"]))
    walked = scratch.stage(map_rows(
        both.select("conv", "slot", "illegal", "ends", "symbols", "lengths", "after"), walks,
        f"conv {kind}, slot int, illegal bigint, ends array<int>, audits array<string>, states array<int>, costs array<bigint>"))
    return map_rows(in_order(walked, "illegal", "ends", "audits", "states", "costs"), choose,
                    f"conv {kind}, audit string, cost bigint, illegal bigint")


def report(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of (conv_id, turn, role, text)."""
    found = scratch.stage(symbols(rows))
    parts = scratch.stage(_segments(found))
    solved = parts.where("not cut").select("conv", "audit", "cost", "illegal").unionByName(_joined(parts.where("cut"), scratch))
    nothing = {c: F.lit(None).cast("bigint") for c in COUNTS}
    pieces = tallies(found).withColumns({"illegal": nothing["illegal"], "cost": nothing["cost"], "audit": F.lit(None).cast("string")})
    pieces = pieces.unionByName(solved.withColumns({c: nothing[c] for c in COUNTS[:4]}))
    return pieces.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.max(c).cast("bigint").alias(c) for c in COUNTS], F.max("audit").alias("audit"))


# ---- repaired rows

def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations, given their (conv_id, audit).

    Rows of a conversation are in one partition, in order.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    kept = turns(rows).select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    lead = {"turn": F.lit(None), "role": F.lit(None), "digest": F.lit(None), "kind": F.lit(0)}
    both = kept.unionByName(audits.select(F.col("conv_id").alias("conv"), F.col("audit").alias("text")).withColumns(
        {c: v.cast(kept.schema[c].dataType) for c, v in lead.items()}))
    stream = both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")

    def run(blocks):
        conv, audit, at, state, place = None, "", 0, 0, 0
        out: dict[str, list] = {"conv_id": [], "position": [], "role": [], "text": []}

        def put(role: str, text: str) -> None:
            nonlocal state, place
            state = NEXT[role[0]][state]
            for name, value in (("conv_id", conv), ("position", place), ("role", role), ("text", text)):
                out[name].append(value)
            place += 1

        def added() -> None:
            nonlocal at
            while audit[at:at + 1] == "I":
                put({"u": "user", "a": "assistant"}[_follow(state)[0]], "")
                at += 1

        for b in blocks:
            for key, is_row, role, text in zip(b["conv"], b["kind"], b["role"], b["text"]):
                if not is_row:
                    added()
                    conv, audit, at, state, place = key, text, 0, 0, 0
                    continue
                added()
                if audit[at] == "K":
                    put(role, text)
                elif audit[at] == "R":
                    put({"u": "user", "a": "assistant"}[_follow(state)[0]], text)
                at += 1
            yield out
            out = {name: [] for name in out}
        added()
        yield out

    return map_rows(stream.select("conv", "kind", "role", "text"), run, f"conv_id {kind}, position bigint, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of ``role:text`` lines, of rows as ``repaired`` gives them."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(blocks):
        now, taken = None, None
        for b in blocks:
            out = {"conv_id": [], "sha256": []}
            for conv, place, role, text in zip(b["conv_id"], b["position"], b["role"], b["text"]):
                if place == 0:
                    if taken:
                        out["conv_id"].append(now)
                        out["sha256"].append(taken.hexdigest())
                    now, taken = conv, hashlib.sha256()
                else:
                    taken.update(b"\n")
                taken.update(f"{role}:{text}".encode())
            yield out
        if taken:
            yield {"conv_id": [now], "sha256": [taken.hexdigest()]}

    return map_rows(rows, run, f"conv_id {kind}, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations damaged by the contract's rule, a function of conversation and turn; nulls become one space there and in texts."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("_how", F.crc32(key.cast("binary")) % 20).where("_how <> 0")
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times_ = F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("_how") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(times_)).drop("col")
