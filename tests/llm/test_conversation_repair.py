"""Conversation repair against a plain search for the cheapest, least edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hiremart.llm import conversation_repair as R
from hiremart.sources.scratch import Scratch
from tests.conftest import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def plain(rows):
    """Everything the contract asks of the rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        tail = text.rstrip(" \t\n\x0b\f\r")
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "" if tail[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def follow(said, role):
        return said + role if re.fullmatch("s?(ua)*u?", said + role) else None

    def short(said):  # what matters of the roles so far
        return said if len(said) < 2 else "ua" if said.endswith("a") else "u"

    @lru_cache(None)
    def best(i, said, inserted=0):
        """(cost, audit, roles) of the cheapest way on; more than three inserts in a row never help."""
        options = [(0, "", "")] if i == len(rows) and re.fullmatch("(s?(ua)+)?", said) else []
        for role in "ua":
            if follow(said, role) and inserted < 3:
                c, a, r = best(i, short(follow(said, role)), inserted + 1)
                options.append((c + 2, "I" + a, role + r))
        if i < len(rows):
            c, a, r = best(i + 1, said)
            options.append((c + 3, "D" + a, "-" + r))
            if faults[i] not in ("blank", "duplicate"):
                more, initial = faults[i] == "truncated", rows[i][2][:1]
                if initial and initial in "sua" and follow(said, initial):
                    c, a, r = best(i + 1, short(follow(said, initial)))
                    options.append((c + more, "K" + a, initial + r))
                for role in "ua":
                    if follow(said, role):
                        c, a, r = best(i + 1, short(follow(said, role)))
                        options.append((c + 2 + more, "R" + a, role + r))
        return min(options, default=(10 ** 9, "", ""))

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for said in ("", "s", "u", "ua"):
            best(i, said)
    cost, audit, roles = best(0, "")
    lines, i = [], 0
    for act, role in zip(audit, roles):
        name = {"u": "user", "a": "assistant"}.get(role)
        if act == "I":
            lines.append(f"{name}:")
            continue
        if act != "D":
            lines.append(f"{rows[i][2] if act == 'K' else name}:{rows[i][3]}")
        i += 1
    initials = [r[2][:1] for r in rows]
    known = [r[1] for r in rows if r[1] is not None]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = defaultdict(list, {r[0]: [] for r in rows})
    for r in damage(rows):
        groups[r[0]].append(r)
    return {k: plain(v) for k, v in groups.items()}


COLUMNS = [*R.COUNTS, "audit", "repaired_sha256"]


def run(spark, rows, folder, parts=3):
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "slot", "digest", "n", "kind", "audit", "sha256", "_how", "col"):
        table = table.withColumn(name, F.lit("clash"))
    table.repartition(parts).write.parquet(f"{folder}/conversations.parquet")
    found = entry.queries()["op12_conversation_repair"](spark, str(folder)).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found}


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op12_conversation_repair"](spark, SF).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == expected(rows)


def test_odd_conversations(spark, tmp_path):
    r = random.Random(4)
    rows = [(None, None, None, None), (None, 3, "user", "x."), (None, None, "", "?"), (1, 1, "user", None), (2, 5, "tool", "a.")]
    rows += [(c, r.choice([None, *range(12)]), r.choice(["user", "assistant", "system", "tool", "U", None]),
              r.choice(["Yes.", "no", " ", "", "Why? ", "a\n", "é!\x0b", "\x1c"])) for c in range(40, 90) for _ in range(r.randrange(1, 14))]
    rows += [(91, i, "user", f"{i}." * 9_000) for i in range(5)]
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows += [(10_000 + lost, 1, "user", "kept."), (lost, 1, "user", "gone.")]
    got = run(spark, rows, tmp_path)
    assert got == expected(rows) and got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


def test_long_conversations_over_many_partitions(spark, tmp_path):
    """Long runs of one symbol, and two conversations far longer than a partition."""
    r = random.Random(7)
    rows = [(1, i, "user", f"t{i // 3}.") for i in range(700)]
    rows += [(2, i, ("user", "assistant")[(i // 50 + i) % 2], f"t{i}" + r.choice([".", ""])) for i in range(900)]
    rows += [(3, 0, "user", "solo.")] + [(4, 7, "user", "again.")] * 60
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, tmp_path, 8) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(3))
def test_powers_and_segments(seed):
    r = random.Random(seed)
    for _ in range(300):
        runs = [[r.randrange(12), r.choice([1, 1, 2, 7, 40])] for _ in range(r.randrange(1, 6))]
        singles = [[s, 1] for s, n in runs for _ in range(n)]
        audit, state = R.walk(runs, 0, R.finish())
        assert (audit, state) == R.walk(singles, 0, R.finish()) and R.run_matrix(runs) == R.run_matrix(singles)
        cut = r.randrange(len(singles) + 1)
        after = R.apply(R.run_matrix(singles[cut:]), R.finish())
        head, middle = R.walk(singles[:cut], 0, after)
        tail, end = R.walk(singles[cut:], middle, R.finish())
        assert (head + tail, end) == (audit, state)
