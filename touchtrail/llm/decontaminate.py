"""Benchmark decontamination: BM25 with block-max WAND, then overlap of both parts.

The test items form an inverted index; every passage of every training text is a query
against it. Impacts are divided by what an item would score against itself, so a score is
the share of an item's weight that a passage holds, and one threshold fits all items.

Passages overlap by half and are twice as long as the longest item of their index, so an
item within a text lies wholly within some passage. Block-max WAND finds the items: a
block of items is looked into only if the largest impacts a passage's terms have in it
add up to the threshold (tested for all passages and blocks of a text at once), and in a
live block cursors skip to the pivot. Every item at or above the threshold is returned.
It counts as leaked where its question (the leading words) and its answer (the trailing
words) both overlap with the passage.

The index is cut into shards by item length and bounded size. Term frequencies and the
average length are those of the whole benchmark, and passages those of a length class, so
scores do not depend on how it was cut. As many shards as fit the bound are broadcast
together and held against a text in one pass; only a larger benchmark takes further passes.
Texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, stored, texts
from touchtrail.llm.license_scan import words_of
from touchtrail.llm.rolling import binary_batch

BLOCKS = 64  # of consecutive items, at most; each term has a maximum in each of them
SHARD_BYTES = 8 << 20  # of item text in one broadcast index
PASS_BYTES = 16 << 20  # of item text held against a text in one pass
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Settings:
    """``threshold``: share of an item's BM25 weight a passage must hold.
    ``answer_share``: part of an item's words, at its end, that is taken as the answer.
    ``overlap``: share of the word triples of question and of answer to be found again."""

    threshold: float = 0.6
    answer_share: float = 0.25
    overlap: float = 0.5
    triple: int = 3


@dataclass(frozen=True)
class Statistics:
    """Of all items of the benchmark, and the longest of a length class, in words.

    ``frequency`` has at least the terms of the shard it is used for.
    """

    items: int
    average: float
    longest: int
    frequency: dict[bytes, int]


class Index:
    """Inverted index of a shard, in blocks of consecutive items.

    ``vocabulary`` numbers the terms. Term t has its postings at ``first[t]:first[t+1]``
    of ``items`` and ``impacts``, ascending by item, and its blocks, with the largest
    impact in each, at ``block_first[t]:block_first[t+1]`` of ``blocks`` and ``best``.
    """

    def __init__(
        self, ids: list[int], datas: list[bytes], settings: Settings, whole: Statistics | None = None
    ):
        # Items of like length have like impacts, which keeps block maxima tight.
        order = sorted(range(len(ids)), key=lambda i: len(words_of(datas[i])))
        self.ids = [ids[i] for i in order]
        words = [words_of(datas[i]) for i in order]
        longest = len(words[-1]) if words else 0
        self.block = max(4, -(-len(ids) // BLOCKS))
        self.n_blocks = -(-len(ids) // self.block)
        counts: dict[bytes, dict[int, int]] = {}
        for item, held in enumerate(words):
            for w in held:
                in_items = counts.setdefault(w, {})
                in_items[item] = in_items.get(item, 0) + 1
        if whole is None:  # the shard is the benchmark
            average = sum(map(len, words)) / max(1, len(words))
            frequency = {w: len(in_items) for w, in_items in counts.items()}
            whole = Statistics(len(ids), average, longest, frequency)
        self.longest = whole.longest
        own = [0.0] * len(ids)
        postings: list[list[tuple[int, float]]] = []
        for word, in_items in counts.items():
            seen = whole.frequency[word]
            weight = log(1 + (whole.items - seen + 0.5) / (seen + 0.5))
            row = []
            for item, n in sorted(in_items.items()):
                norm = K1 * (1 - B + B * len(words[item]) / whole.average)
                row.append((item, weight * n * (K1 + 1) / (n + norm)))
                own[item] += row[-1][1]
            postings.append(row)
        self.vocabulary = {w: i for i, w in enumerate(counts)}
        self.first = np.cumsum([0, *map(len, postings)])
        self.items = np.array([i for row in postings for i, _ in row], dtype=np.int64)
        self.impacts = np.array([v / own[i] for row in postings for i, v in row])
        blocks: list[dict[int, float]] = []
        for row in postings:
            best: dict[int, float] = {}
            for i, v in row:
                k = i // self.block
                best[k] = max(best.get(k, 0.0), v / own[i])
            blocks.append(best)
        self.block_first = np.cumsum([0, *map(len, blocks)])
        self.blocks = np.array([k for best in blocks for k in best], dtype=np.int64)
        self.best = np.array([v for best in blocks for v in best.values()])
        self.parts = [self._parts(w, settings) for w in words]

    @staticmethod
    def _parts(words: list[bytes], s: Settings) -> tuple[set, set]:
        cut = len(words) - max(1, int(len(words) * s.answer_share))
        return triples(words[:cut] or words, s.triple), triples(words[cut:], s.triple)


def triples(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    """Runs of ``size`` words; the words themselves, as one run, if fewer."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def above(index: Index, terms: np.ndarray, block: int, threshold: float) -> list[tuple[int, float]]:
    """(item, score) of every item of a block that reaches the threshold: WAND.

    Cursors are ordered by their item; the first whose bounds, the block maxima, add up to
    the threshold is the pivot, and items before it cannot reach it.
    """
    cursors = []  # [item, place, end, bound]
    low, high = block * index.block, (block + 1) * index.block
    for t in terms.tolist():
        a, b = index.first[t], index.first[t + 1]
        i, j = a + np.searchsorted(index.items[a:b], (low, high))
        if i < j:
            cursors.append([int(index.items[i]), int(i), int(j), float(index.impacts[i:j].max())])
    found = []

    def move(cursor: list, target: int) -> None:
        place = cursor[1]
        while place < cursor[2] and index.items[place] < target:
            place += 1
        cursor[1] = place
        cursor[0] = int(index.items[place]) if place < cursor[2] else high

    while True:
        cursors.sort()
        bound, pivot = 0.0, None
        for cursor in cursors:
            if cursor[0] == high:
                break
            bound += cursor[3]
            if bound >= threshold:
                pivot = cursor[0]
                break
        if pivot is None:
            return found
        if cursors[0][0] == pivot:
            there = [c for c in cursors if c[0] == pivot]
            score = sum(float(index.impacts[c[1]]) for c in there)
            if score >= threshold:
                found.append((pivot, score))
            for cursor in there:
                move(cursor, pivot + 1)
        else:
            for cursor in cursors:
                if cursor[0] < pivot:
                    move(cursor, pivot)


def live_blocks(
    index: Index, codes: np.ndarray, threshold: float
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, terms, blocks) of the passages of a text and the blocks of the index
    whose maxima, added over a passage's distinct terms, reach the threshold.

    This is the block-max test for all passages of a text at once; it leaves out no item
    that reaches the threshold.
    """
    stride = max(1, index.longest)
    count = max(1, -(-(len(codes) - stride) // stride))
    at = np.flatnonzero(codes >= 0)
    passage = np.concatenate((at // stride, at // stride - 1))
    pair = passage * len(index.vocabulary) + np.tile(codes[at], 2)
    pair = np.unique(pair[(passage >= 0) & (passage < count)])
    passage, term = np.divmod(pair, len(index.vocabulary))
    size = index.block_first[term + 1] - index.block_first[term]
    ends = np.cumsum(size)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.block_first[term] - ends + size, size)
    cell = np.repeat(passage * index.n_blocks, size) + index.blocks[place]
    bound = np.bincount(cell, weights=index.best[place], minlength=count * index.n_blocks)
    live = np.flatnonzero(bound >= threshold)
    if not len(live):
        return
    which, block = np.divmod(live, index.n_blocks)
    for k in np.unique(which).tolist():
        terms = term[np.searchsorted(passage, k) : np.searchsorted(passage, k, side="right")]
        yield k * stride, min(len(codes), (k + 2) * stride), terms, block[which == k]


def leaks_of(index: Index, words: list[bytes], s: Settings) -> dict[int, tuple]:
    """item -> (score, question overlap, answer overlap, start, end) of its best passage."""
    best: dict[int, tuple] = {}
    codes = np.fromiter(map(index.vocabulary.get, words, [-1] * len(words)), np.int64, len(words))
    # A little slack, as sums are taken in different orders.
    threshold = s.threshold - 1e-9
    for start, end, terms, blocks in live_blocks(index, codes, threshold):
        hits = [h for b in blocks.tolist() for h in above(index, terms, b, threshold)]
        if not hits:
            continue
        part = words[start:end]
        there = triples(part, s.triple)
        singles = set(part)
        for item, score in hits:
            shares = []
            for wanted in index.parts[item]:
                n = sum(t in there or (len(t) < s.triple and singles.issuperset(t)) for t in wanted)
                shares.append(n / len(wanted) if wanted else 0.0)
            if min(shares) >= s.overlap:
                value = (score, *shares, start, end)
                if item not in best or value[:3] > best[item][:3]:
                    best[item] = value
    return best


def length_class(n_chars: str = "n_chars") -> F.Column:
    """Items of a class differ in length by a factor of two at most (from 512 bytes on)."""
    return F.greatest(F.lit(9), F.ceil(F.log2(F.greatest(F.col(n_chars), F.lit(1))))).cast("int")


SCHEMA = pa.schema(
    [
        pa.field("doc_id", pa.int64()),
        pa.field("item_id", pa.int64()),
        pa.field("score", pa.float64()),
        pa.field("question_overlap", pa.float64()),
        pa.field("answer_overlap", pa.float64()),
        pa.field("start_word", pa.int64()),
        pa.field("end_word", pa.int64()),
    ]
)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per (document row, leaked item) with its best passage.

    Words are lower-cased runs of letters and digits. Items without words, NULL or not,
    cannot leak; documents without words hold none. Ties between passages go to the
    first. A repeated row or item is reported for each time it occurs, a NULL id as NULL.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    source = texts(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    items = stored(
        texts(benchmark, item_col, item_text_col)
        .select(F.col("doc_id").cast("long").alias("item_id"), "text")
        .withColumn("n_chars", F.octet_length("text").cast("long"))
        .withColumn("class", length_class()),
        "benchmark-items",
    )
    known = _Known(items)
    # Shards of bounded size pass through the driver, those of one pass at a time.
    found = None
    for passed in _passes(known.sizes()):
        indexes = []
        for kind, number, n in passed:
            chosen = (F.col("class") == kind) & (_shard(n) == number)
            shard = items.where(chosen).select("item_id", "text").collect()
            kept = [(r["item_id"], r["text"].encode()) for r in shard if words_of(r["text"].encode())]
            if kept:
                kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
                whole = known.of(kind, number, n)
                index = Index([i for i, _ in kept], [t for _, t in kept], settings, whole)
                indexes.append(spark.sparkContext.broadcast(index))
        if indexes:
            part = _against(source, indexes, settings)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], _ddl())
    return found


def _shard(n: int) -> F.Column:
    return F.pmod(F.xxhash64("item_id", "text"), F.lit(n))


def _passes(sizes: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """(class, shard, shards of the class) in groups that stay within PASS_BYTES."""
    group, held = [], 0.0
    for kind, size, n in sizes:
        for number in range(n):
            if group and held + size / n > PASS_BYTES:
                yield group
                group, held = [], 0.0
            group.append((kind, number, n))
            held += size / n
    if group:
        yield group


class _Known:
    """Statistics over all items, as Spark aggregates; a shard's terms are fetched with it."""

    def __init__(self, items: DataFrame):
        schema = pa.schema([
            pa.field("class", pa.int32()), pa.field("item_id", pa.int64()), pa.field("text", pa.string()),
            pa.field("word", pa.binary()), pa.field("n", pa.int64()),
        ])

        def run(batches: Batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    words = words_of(r["text"].encode())
                    # One row of each distinct word; the item's length with the first.
                    for k, w in enumerate(dict.fromkeys(words)):
                        rows.append((r["class"], r["item_id"], r["text"], w, 0 if k else len(words)))
                yield binary_batch(schema, rows)

        found = items.select("class", "item_id", "text").mapInArrow(
            run, "class int, item_id long, text string, word binary, n long"
        )
        key = F.xxhash64("item_id", "text").alias("key")
        self.terms = stored(found.select("class", key, "word", "n"), "benchmark-terms")
        self.classes = items.groupBy("class").agg(F.sum("n_chars").alias("size")).collect()
        longest = self.terms.groupBy("class").agg(F.max("n").alias("longest")).collect()
        self.longest = {r["class"]: r["longest"] for r in longest}
        total = self.terms.where("n > 0").agg(F.count("n").alias("items"), F.avg("n").alias("average")).first()
        self.items, self.average = total["items"], total["average"] or 1.0
        counts = self.terms.groupBy("word").agg(F.count(F.lit(1)).alias("seen"))
        self.frequency = stored(counts, "benchmark-frequencies")

    def sizes(self) -> list[tuple[int, int, int]]:
        return sorted((r["class"], r["size"], max(1, -(-r["size"] // SHARD_BYTES))) for r in self.classes)

    def of(self, kind: int, number: int, n: int) -> Statistics:
        own = self.terms.where(
            (F.col("class") == kind) & (F.pmod(F.col("key"), F.lit(n)) == number)
        ).select("word").distinct()
        rows = self.frequency.join(own, "word", "left_semi").collect()
        frequency = {bytes(r["word"]): r["seen"] for r in rows}
        return Statistics(self.items, self.average, self.longest[kind], frequency)


def _ddl() -> str:
    kinds = {pa.int64(): "long", pa.float64(): "double"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in SCHEMA)


def _against(source: DataFrame, indexes: list, settings: Settings) -> DataFrame:
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        shards = [index.value for index in indexes]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = words_of(text.as_buffer().to_pybytes())
                for shard in shards if words else ():
                    for item, value in sorted(leaks_of(shard, words, settings).items()):
                        rows.append((doc_id, shard.ids[item], *value))
            yield binary_batch(SCHEMA, rows)

    return source.mapInArrow(run, _ddl())
