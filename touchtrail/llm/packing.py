"""Packing token pieces into sequences: large-item matching, then best fit.

Pieces longer than a third of the capacity can share a sequence with one other such
piece at most, so they are matched greedily: the longest open one with the longest
that still fits. Shorter pieces then go, longest first, into the smallest gap that
holds them.

How the pieces of a corpus are packed depends only on how many pieces there are of
each length. The plan is therefore made on that histogram (at most ``capacity``
numbers) for whole *groups* of equal sequences at a time, and says for each length
which ranks go where. Pieces are ranked within their length by a window over bounded
chunks and find their place by a search in the plan: nothing but the histogram
reaches the driver, and no task sees more than its share of the pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, stored, table_batch, texts

SPECIAL = "<|endoftext|>"
# Characters for which both tokenizer libraries read the pre-token pattern alike.
COMMON = r"[^\x00-ɏ‐-‧]"
CHUNK_PIECES = 100_000


# -- tokens ---------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _encoder(path: str, ranks_path: str, pattern: str):
    import base64
    import os
    import re

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(path)
    special = np.array([exact.token_to_id(SPECIAL)], dtype="<u4")
    uncommon = re.compile(COMMON)

    def encode(text: str) -> np.ndarray:
        """Ids as the tokenizer file gives them, special strings included."""
        if uncommon.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        parts = []
        for i, part in enumerate(text.split(SPECIAL)):
            if i:
                parts.append(special)
            parts.append(np.asarray(fast.encode_to_numpy(part, disallowed_special=()), dtype="<u4"))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    return encode


def pieces(
    docs: DataFrame,
    tokenizer: tuple[str, str, str],
    capacity: int = 2048,
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the separator,
    cut into pieces of ``capacity``; the first piece holds what is left over.

    ``tokenizer``: tokenizer file, the same vocabulary as ranks, and its pattern; every
    executor needs the files. An empty or NULL text is the separator alone.
    """
    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("piece", pa.int32()),
            pa.field("start", pa.int64()),
            pa.field("length", pa.int64()),
            pa.field("ids_crc32", pa.int64()),
        ]
    )
    end = np.array([separator], dtype="<u4")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        encode = _encoder(*tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows: dict[str, list] = {n: [] for n in schema.names}
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    ids = np.concatenate((encode(text.as_py()), end))
                    head = (len(ids) - 1) % capacity + 1
                    cuts = [0, *range(head, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        values = (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                        for name, value in zip(schema.names, values):
                            rows[name].append(value)
                yield table_batch(schema, rows)

    return (
        texts(docs, id_col, text_col)
        .select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")
    )


# -- plan -----------------------------------------------------------------------------


@dataclass
class Group:
    """``count`` sequences with the same lengths in the same order."""

    count: int
    lengths: tuple[int, ...]
    gap: int

    def taking(self, count: int, lengths: tuple[int, ...]) -> Group:
        return Group(count, self.lengths + lengths, self.gap - sum(lengths))


def match_large(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Greedy matching of lengths above a third of the capacity."""
    left = {n: c for n, c in histogram.items() if 3 * n > capacity and c > 0}
    order = sorted(left, reverse=True)
    groups = []
    for long in order:
        for short in order:
            if not left[long]:
                break
            if short > long or long + short > capacity or not left[short]:
                continue
            pairs = left[long] // 2 if short == long else min(left[long], left[short])
            if pairs:
                left[long] -= pairs
                left[short] -= pairs
                groups.append(Group(pairs, (long, short), capacity - long - short))
        if left[long]:
            groups.append(Group(left[long], (long,), capacity - long))
            left[long] = 0
    return groups


def best_fit(groups: list[Group], histogram: dict[int, int], capacity: int) -> list[Group]:
    """Shorter pieces, longest first, each into the smallest gap that holds it.

    All pieces of a length are placed together: a gap takes as many as it holds, which
    is what placing them one by one does, as a gap just used is then the smallest.
    """
    by_gap: list[list[Group]] = [[] for _ in range(capacity + 1)]
    for g in groups:
        by_gap[g.gap].append(g)
    for length in sorted((n for n in histogram if 3 * n <= capacity), reverse=True):
        left = histogram[length]
        for gap in range(length, capacity + 1):
            while left and by_gap[gap]:
                g = by_gap[gap].pop()
                fit = gap // length
                full, rest = divmod(left, fit)
                used = min(g.count, full)
                if used:
                    by_gap[gap - fit * length].append(g.taking(used, (length,) * fit))
                    left -= used * fit
                if used < g.count:
                    remaining = g.count - used
                    if rest:  # one sequence takes the last few
                        by_gap[gap - rest * length].append(g.taking(1, (length,) * rest))
                        remaining -= 1
                        left = 0
                    if remaining:
                        by_gap[gap].append(Group(remaining, g.lengths, gap))
            if not left:
                break
        if left:
            fit = capacity // length
            full, rest = divmod(left, fit)
            empty = Group(1, (), capacity)
            if full:
                by_gap[capacity - fit * length].append(empty.taking(full, (length,) * fit))
            if rest:
                by_gap[capacity - rest * length].append(empty.taking(1, (length,) * rest))
    return [g for held in by_gap for g in held]


def plan(histogram: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset), by first rank.

    The piece of rank r goes to the last row with a first rank of at most r, into
    sequence ``first sequence + r - first rank``. The number of rows depends on the
    lengths that occur, not on the number of pieces.
    """
    groups = best_fit(match_large(histogram, capacity), histogram, capacity)
    rows: dict[int, list[tuple[int, int, int]]] = {}
    ranked: dict[int, int] = {}
    sequence = 0
    for g in groups:
        offset = 0
        for length in g.lengths:
            rank = ranked.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, offset))
            ranked[length] = rank + g.count
            offset += length
        sequence += g.count
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


# -- placement -------------------------------------------------------------------------


def place(
    cut: DataFrame, capacity: int = 2048, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece")
) -> DataFrame:
    """``cut`` with sequence_id and offset of every row.

    ``cut`` is read several times: pass a stored table. Every length must lie between 1
    and ``capacity``. Repeated rows are pieces of their own.
    """
    spark = cut.sparkSession
    total = cut.count()
    chunks = max(1, -(-total // CHUNK_PIECES))
    keyed = cut.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counted = stored(keyed.groupBy(length_col, "_chunk").count(), "packing-counts")
    # At most ``capacity`` rows come to the driver, whatever the corpus.
    histogram = {
        r[length_col]: r["n"] for r in counted.groupBy(length_col).agg(F.sum("count").alias("n")).collect()
    }
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    planned = spark.sparkContext.broadcast(plan(histogram, capacity))

    before = Window.partitionBy(length_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select(
        length_col, "_chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first")
    )
    within = Window.partitionBy(length_col, "_chunk").orderBy(*order)
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(within) - 1)
        .join(firsts, [length_col, "_chunk"])
        .withColumn("_rank", F.col("_rank") + F.col("_first"))
        .drop("_first", "_chunk")
        .select(*cut.columns, "_rank")
    )

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        rows = planned.value
        for batch in batches:
            lengths = batch.column(length_col).to_numpy(zero_copy_only=False)
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequences = np.empty(len(lengths), dtype=np.int64)
            offsets = np.empty(len(lengths), dtype=np.int64)
            for length in np.unique(lengths):
                here = np.flatnonzero(lengths == length)
                table = rows[int(length)]
                row = np.searchsorted(table[:, 0], ranks[here], side="right") - 1
                sequences[here] = table[row, 1] + ranks[here] - table[row, 0]
                offsets[here] = table[row, 2]
            kept = batch.drop_columns(["_rank"])
            yield kept.append_column("sequence_id", pa.array(sequences)).append_column(
                "offset", pa.array(offsets)
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    tokenizer: tuple[str, str, str],
    capacity: int = 2048,
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise, cut and place whole documents; one row per piece.

    No token is dropped or cut away: a document's pieces, in order, are its ids. An
    empty table gives an empty result.
    """
    cut = stored(
        pieces(docs, tokenizer, capacity, separator, id_col, text_col), "packing-pieces"
    )
    return place(cut, capacity)
