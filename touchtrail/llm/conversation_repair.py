"""Repair of conversations by the cheapest edits, streamed turn by turn.

A conversation is right if its roles read ``(s?(ua)+)?``: an optional system turn, then
user and assistant in turns. Rows are partitioned by conversation and sorted by turn, and
mapInPandas walks through them once, carrying the state of a dynamic programme from batch to
batch: for each of four grammar states the least cost of reaching it after the rows so far,
the rank of its edit string among the four, and a running hash of the repaired texts. No text
is held beyond its row.

Inserts are counted with the edit that follows them, so after a row every state's string ends
with that row's own edit. No such string is then the start of another one (it would have one
row edit fewer), two different states never have the same string, and ties are settled by
comparing (rank of the state before, letters added).

What was chosen for a row is four bytes of backpointers. They are followed when the
conversation ends. Those of a giant one leave the task as a row every SPILL turns, and a second
secondary-sorted stream of such rows alone follows them from the last block to the first; it
holds the edit string, one byte a turn, and one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import stored

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
# Grammar states: nothing yet, after a system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER,
        ("a", USER): ASSISTANT}
LEGAL = ("su", "ua", "au")
SPILL = 1 << 18
FOREVER = 1 << 62

# First fault of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


# -- edits of one row ------------------------------------------------------------------


def inserted(state: int, count: int) -> tuple[int, list[int]]:
    """The state after ``count`` inserts, and the roles inserted: the grammar leaves no choice."""
    roles = []
    for _ in range(count):
        state = NEXT[state]
        roles.append(state)
    return state, roles


def moves(initial: str, fault: int) -> list[tuple[int, int, int, str, list[int], int | None]]:
    """(state before, after, cost, letters, roles inserted, role of the row) of each edit.

    More than two inserts before a row only repeat a state at a higher cost. Of edits
    between the same two states, the cheapest with the least letters is enough.
    """
    best: dict[tuple[int, int], tuple] = {}
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for before, count, edit in product(range(4), range(3), (DELETE, KEEP, REROLE)):
        state, roles = inserted(before, count)
        cost, role = INSERT_COST * count, None
        if edit == DELETE:
            after, cost = state, cost + DELETE_COST
        elif fault in (BLANK, DUPLICATE):
            continue
        elif edit == KEEP:
            if (initial, state) not in KEPT:
                continue
            after, cost = KEPT[initial, state], cost + extra
            role = after
        else:
            after, cost = NEXT[state], cost + REROLE_COST + extra
            role = after
        found = (cost, INSERT * count + edit, roles, role)
        if (before, after) not in best or found[:2] < best[before, after][:2]:
            best[before, after] = found
    return [(b, a, *rest) for (b, a), rest in best.items()]


MOVES = {
    (initial, fault): moves(initial, fault)
    for initial, fault in product(("s", "u", "a", ""), (SOUND, BLANK, DUPLICATE, TRUNCATED))
}
# A backpointer: the state before in two bits, inserts in two, the edit in two.
EDITS = (DELETE, KEEP, REROLE)


def packed(before: int, letters: str) -> int:
    return before | (len(letters) - 1) << 2 | EDITS.index(letters[-1]) << 4


def follow(pointers: bytes, state: int) -> tuple[bytes, int]:
    """The letters of a block of backpointers, last first, and the state before the block."""
    out = bytearray()
    for at in range(len(pointers) - 4, -4, -4):
        p = pointers[at + state]
        out += EDITS[p >> 4].encode() + INSERT.encode() * (p >> 2 & 3)
        state = p & 3
    return bytes(out), state


# -- one conversation ------------------------------------------------------------------


class Walk:
    """State of the dynamic programme, and the counts, of the conversation under way."""

    def __init__(self) -> None:
        self.cost = [0, FOREVER, FOREVER, FOREVER]
        self.rank = [0, 0, 0, 0]
        self.hash = [hashlib.sha256() for _ in range(4)]
        self.pointers = bytearray()
        self.spilled = 0
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.initial: str | None = None
        self.turns: list[int] | None = None  # first, last, distinct

    def row(self, role: str, text: str, turn: int | None, fault: int) -> None:
        self.counts[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None:
            if self.turns is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1], self.turns[2] = turn, self.turns[2] + 1
        chosen: list[tuple | None] = [None] * 4
        for move in MOVES[initial if initial in ("s", "u", "a") else "", fault]:
            before, after, cost, letters = move[:4]
            if self.cost[before] >= FOREVER:
                continue
            found = (self.cost[before] + cost, self.rank[before], letters, move)
            if chosen[after] is None or found[:3] < chosen[after][:3]:
                chosen[after] = found
        told = b":" + text.encode()
        hashes = []
        for found in chosen:
            if found is None:
                hashes.append(hashlib.sha256())
                continue
            before, _, _, letters, roles, own = found[3]
            h = self.hash[before]
            if roles or own is not None:
                h = h.copy()
                first = before == START
                for r in roles:
                    h.update((b"" if first else b"\n") + NAMES[r] + b":")
                    first = False
                if own is not None:
                    h.update(b"" if first else b"\n")
                    h.update(NAMES[own] if letters[-1] == REROLE else role.encode())
                    h.update(told)
            hashes.append(h)
        order = sorted((f[1], f[2], s) for s, f in enumerate(chosen) if f)
        for rank, (_, _, state) in enumerate(order):
            self.rank[state] = rank
        self.cost = [f[0] if f else FOREVER for f in chosen]
        self.hash = hashes
        self.pointers += bytes(packed(f[3][0], f[2]) if f else 0 for f in chosen)

    def end(self) -> tuple[int, int, str, str]:
        """(cost, state before the last inserts, those inserts, hash) of the best repair."""
        found = []
        for before, count in product(range(4), range(3)):
            state, roles = inserted(before, count)
            if self.cost[before] < FOREVER and state in ACCEPTING:
                cost = self.cost[before] + INSERT_COST * count
                found.append((cost, self.rank[before], INSERT * count, before, roles))
        cost, _, letters, before, roles = min(found)
        h = self.hash[before].copy()
        first = before == START
        for r in roles:
            h.update((b"" if first else b"\n") + NAMES[r] + b":")
            first = False
        return cost, before, letters, h.hexdigest()


# -- streams ---------------------------------------------------------------------------

WALKED = (
    "conv string, block int, pointers binary, state int, tail string, gaps long, blank long, "
    "duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _walk(spill: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk, conv, at = Walk(), None, False
        last: tuple | None = None
        out: list[tuple] = []

        def spilled(w: Walk) -> tuple:
            row = (conv, w.spilled, bytes(w.pointers), *[None] * 10)
            w.spilled, w.pointers = w.spilled + 1, bytearray()
            return row

        def ended(w: Walk) -> tuple:
            cost, state, tail, digest = w.end()
            gaps = w.turns[1] - w.turns[0] + 1 - w.turns[2] if w.turns else 0
            faults = w.counts[BLANK], w.counts[DUPLICATE], w.counts[TRUNCATED]
            pointers, audit = bytes(w.pointers), None
            if not w.spilled:
                audit, pointers = (follow(pointers, state)[0][::-1].decode() + tail), None
            return (
                conv, w.spilled, pointers, state, tail, gaps, *faults, w.illegal, cost, audit, digest
            )

        columns = [c.split()[0] for c in WALKED.split(", ")]
        for batch in batches:
            for c, turn, has_turn, role, text, copies, fault, again in batch.itertuples(index=False):
                if not at or c != conv:
                    if at:
                        out.append(ended(walk))
                    walk, conv, at, last = Walk(), c, True, None
                for _ in range(copies):
                    this = (turn, has_turn, role, text)
                    first = fault
                    if fault != BLANK and (again or this == last):
                        first = DUPLICATE
                    last = this
                    walk.row(role, text, turn if has_turn else None, first)
                    if len(walk.pointers) >= 4 * spill:
                        out.append(spilled(walk))
            if out:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if at:
            yield pd.DataFrame([ended(walk)], columns=columns)

    return run


def _follow_back(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of each conversation, the last one first: (_conv, _audit)."""
    conv, at, state, parts = None, False, START, []

    def ended() -> tuple:
        return conv, b"".join(parts)[::-1].decode()

    for batch in batches:
        out = []
        for c, pointers, block_state, tail in batch.itertuples(index=False):
            if not at or c != conv:
                if at:
                    out.append(ended())
                conv, at, state, parts = c, True, int(block_state), [tail.encode()]
            letters, state = follow(pointers, state)
            parts.append(letters)
        if out:
            yield pd.DataFrame(out, columns=["_conv", "_audit"])
    if at:
        yield pd.DataFrame([ended()], columns=["_conv", "_audit"])


# -- operator --------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a fixed share of faults, by crc32(``conv_id:turn``) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it,
    4 makes its role user. A NULL is one space. ``copies`` says how often the row stands there,
    so a conversation keeps its id when all of its rows are dropped.
    """
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    how = F.col("_how")
    return (
        conversations.select(
            "conv_id", "turn",
            F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
            (F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20).alias("_how"),
        )
        .select(
            "conv_id",
            "turn",
            F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(how == 1, "")
            .when(how == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"),
        )
    )


def own_fault(text: Column) -> Column:
    """The fault that a text shows by itself."""
    last = F.substring(F.rtrim(text, F.lit(" \t\n\x0b\f\r")), -1, 1)
    return (
        F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    )


def repair(conversations: DataFrame, spill: int = SPILL) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``conversations`` has conv_id, turn, role, text and, optionally, ``copies`` (how often a row
    stands there, 0 for none); other columns are ignored. One row per conv_id, NULL included.
    Rows are read by turn, NULL turns first, equal turns by role and text. A NULL role or text
    is one space. An empty role has no initial and can only be reroled or deleted. Rows
    that repeat are duplicates; texts of any length pass through without being held. A
    conversation without rows has zeros, an empty audit and the hash of an empty text; an
    empty table gives no rows.
    """
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    id_type = conversations.schema["conv_id"].dataType
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        copies.cast("int").alias("copies"),
    ).withColumn("fault", own_fault(F.col("text")))

    # Role and text that stand at more than one turn: all but the first are duplicates. Rows of
    # one turn meet in the stream. Grouping is by digest and merges before the shuffle.
    digest = [F.xxhash64("role", "text").alias("d1"), F.xxhash64("text", "role", F.lit(1)).alias("d2")]
    rows = rows.select("*", *digest)
    keys = ["conv", "d1", "d2"]
    place = F.struct("has_turn", "turn")  # false, for NULL turns, comes first
    repeats = (
        rows.where("copies > 0")
        .groupBy(*keys)
        .agg(F.min(place).alias("first"), F.max(place).alias("final"))
        .where("first <> final")
        .select(F.coalesce("conv", F.lit("")).alias("rc"), F.col("conv").isNull().alias("rn"), "d1", "d2", "first")
    )
    joined = rows.join(
        repeats.withColumnsRenamed({"d1": "r1", "d2": "r2"}),
        (F.coalesce("conv", F.lit("")) == F.col("rc"))
        & (F.col("conv").isNull() == F.col("rn"))
        & (F.col("d1") == F.col("r1"))
        & (F.col("d2") == F.col("r2")),
        "left",
    ).select(
        "conv", "turn", "has_turn", "role", "text", "copies", "fault",
        F.coalesce(place > F.col("first"), F.lit(False)).alias("again"),
    )
    walked = stored(
        joined.repartition("conv")
        .sortWithinPartitions("conv", "has_turn", "turn", "role", "text")
        .mapInPandas(_walk(spill), WALKED),
        "conversations",
    )
    # Only conversations that spilled have pointers here; the last block knows the end state.
    audits = (
        walked.where("pointers IS NOT NULL")
        .repartition("conv")
        .sortWithinPartitions("conv", F.desc("block"))
        .select(
            "conv", "pointers",
            F.coalesce("state", F.lit(START)).alias("state"), F.coalesce("tail", F.lit("")).alias("tail"),
        )
        .mapInPandas(_follow_back, "_conv string, _audit string")
    )
    return (
        walked.where("state IS NOT NULL")
        .join(audits, F.col("conv").eqNullSafe(F.col("_conv")), "left")
        .select(
            F.col("conv").cast(id_type).alias("conv_id"),
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
            F.coalesce("audit", "_audit").alias("audit"),
            "repaired_sha256",
        )
    )
