"""Conversation repair against a memoised search over edit strings."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from touchtrail.llm import conversation_repair as repair

sys.setrecursionlimit(20_000)
SCHEMA = "conv_id long, turn long, role string, text string"
NAME = {"u": "user", "a": "assistant"}


def conversation_rows() -> list[tuple]:
    rng = random.Random(5)
    rows: list[tuple] = []
    texts = ["Yes.", "No!", "cut off", "", " \n\t", "Why? ", "Yes. And é…", None, "日本?", "a.b"]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    for conv in range(120):
        right = rng.random() < 0.4
        for turn in range(rng.randrange(0, 9)):
            role = ("user", "assistant")[turn % 2] if right else rng.choice(roles)
            number = None if rng.random() < 0.05 else turn + (turn > 3) * rng.randrange(3)
            rows.append((conv * 3, number, role, f"Text {rng.randrange(9)}." if right else rng.choice(texts)))
    rows += [(None, t, "user", "Hello.") for t in (3, None, 1)]
    rows += [(999, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(300)]
    rows += [(1000, None, None, None), rows[0], rows[0], rows[-1]]
    rows.append((1001, 0, "user", "long " * 200_000 + "."))
    return rows


def damaged(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(name.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        found[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(how, 1)
    return found


def repaired(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\f\r")
        again = (role, text) in seen
        seen.add((role, text))
        faults.append("b" if not shown else "d" if again else "t" if shown[-1] not in ".!?" else "")

    @functools.cache
    def best(i, state, inserts):
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(cost, letter, out, rest):
            options.append((cost + rest[0], letter + rest[1], out + rest[2]))

        if inserts < 4:
            add(3, "I", (f"{NAME[after]}:",), best(i, after, inserts + 1))
        if i < len(rows):
            _, role, text = rows[i]
            add(4, "D", (), best(i + 1, state, 0))
            if faults[i] not in ("b", "d"):
                extra = 3 * (faults[i] == "t")
                add(3 + extra, "R", (f"{NAME[after]}:{text}",), best(i + 1, after, 0))
                if role[:1] == after or (state, role[:1]) == ("", "s"):
                    add(extra, "K", (f"{role}:{text}",), best(i + 1, role[:1], 0))
        return min(options, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = (faults.count(f) for f in "bdt")
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.fixture(scope="module")
def conversations(spark):
    names = ("conv", "copies_", "fault", "block", "state", "again", "first", "d1", "rc")
    table = spark.createDataFrame(conversation_rows(), SCHEMA).repartition(3)
    return table.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))


@pytest.fixture(scope="module")
def expected():
    return sorted(((c, *repaired(rows)) for c, rows in damaged(conversation_rows()).items()), key=repr)


@pytest.mark.parametrize("spill", [repair.SPILL, 3, 1])
def test_repair(spark, conversations, expected, spill):
    found = repair.repair(repair.damaged(conversations), spill)
    assert found.columns[0] == "conv_id" and found.schema["conv_id"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert sum(e[6] for e in expected) > 1000 and max(len(e[7]) for e in expected) > 250


def test_small_batches_carry_the_state(spark, conversations, expected):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 2)
    try:
        found = repair.repair(repair.damaged(conversations)).collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(map(tuple, found), key=repr) == expected


def test_every_short_conversation():
    """All role and fault patterns of up to three rows, by the walk alone."""
    import itertools

    faults = {"": repair.SOUND, "t": repair.TRUNCATED, "b": repair.BLANK}
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("x{}.", "x{}", " ")]
    for n in range(4):
        for picked in itertools.product(kinds, repeat=n):
            rows = [(i, role, text.format(i)) for i, (role, text) in enumerate(picked)]
            walk = repair.Walk()
            for turn, role, text in rows:
                fault = "b" if text == " " else "" if text.endswith(".") else "t"
                if (role, text) in {(r, t) for i, r, t in rows if i < turn}:
                    walk.row(role, text, turn, repair.BLANK if fault == "b" else repair.DUPLICATE)
                else:
                    walk.row(role, text, turn, faults[fault])
            cost, state, tail, digest = walk.end()
            audit = repair.follow(bytes(walk.pointers), state)[0][::-1].decode() + tail
            assert (cost, audit, digest) == repaired(rows)[5:]


def test_rows_without_damage(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hi."), (2, 5, "assistant", "Well.")]
    found = {r["conv_id"]: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (found[1]["audit"], found[1]["cost"], found[1]["gaps"]) == ("KKK", 0, 0)
    assert (found[2]["audit"], found[2]["cost"]) == ("IK", 3)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damaged(empty)).count() == 0
