"""A word model by deleted interpolation.

The probability of a word after its predecessor mixes three estimates: the bigram's and
the word's maximum likelihood in the training texts, and a uniform share for anything.
The mixture weights depend on how often the context was seen (a bucket per power of
two) and are learned by expectation-maximisation on texts deleted from the counts: one
fold of the training texts is left out of them, and its words choose the weights.

Counts follow the corpus, so they stay distributed. Texts are coded once, chunk by chunk
(a dictionary of word hashes and word numbers), into a table bucketed by chunk. A chunk
sends each distinct word and each distinct bigram once, with its counts, to a bucket of
the hash space (see ``rolling``); the bucket adds them up and answers every chunk that
asked. Joins with the coded texts need no shuffle of theirs. What reaches the driver is
four totals and a histogram of bounded size that the weights are fitted on.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.llm import rolling as r
from touchtrail.llm.common import Batches, stored

FOLDS = 10
EVALUATED = 0  # this fold is scored only
TUNED = 1  # this fold's words choose the weights; they count once those are fixed
END, START = r.U64(1), r.U64(2)  # hashes of the end token and of the place before a text
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
CODED_BYTES = 4 << 20
# Of a hash within its bucket: all of it for words, whose counts are exact; for bigrams, of
# which there are many more, about one count in 300,000 is shared.
WORD_BYTES, PAIR_BYTES = 8, 5
# Files of the coded table; a table cannot have more than 100,000 buckets. A file holds
# any number of chunks, which are read one at a time.
MOST_FILES = 20_000
TABLE_PREFIX = "lm_coded_"
BUCKETS = 24  # of context frequency
FINE = 4  # histogram steps per power of two
NEVER = -10_000  # an estimate of zero in the histogram

CODED = "chunk long, ids array<long>, folds binary, sizes binary, words binary, codes binary"
CODED_SCHEMA = pa.schema(
    [
        pa.field("chunk", pa.int64()),
        pa.field("ids", pa.list_(pa.int64())),
        pa.field("folds", pa.binary()),
        pa.field("sizes", pa.binary()),
        pa.field("words", pa.binary()),
        pa.field("codes", pa.binary()),
    ]
)
ASKED = "bucket int, chunk long, places binary, keys binary, fit binary, tuned binary, context binary, word binary"
ASKED_SCHEMA = pa.schema(
    [
        pa.field("bucket", pa.int32()),
        pa.field("chunk", pa.int64()),
        *(pa.field(n, pa.binary()) for n in ("places", "keys", "fit", "tuned", "context", "word")),
    ]
)
TOLD = (
    "chunk long, places binary, fit binary, tuned binary, cells binary, weights binary, "
    "types long, tokens long, fit_types long, fit_tokens long"
)
TOLD_SCHEMA = pa.schema(
    [
        pa.field("chunk", pa.int64()),
        *(pa.field(n, pa.binary()) for n in ("places", "fit", "tuned", "cells", "weights")),
        *(pa.field(n, pa.int64()) for n in ("types", "tokens", "fit_types", "fit_tokens")),
    ]
)


class Coded:
    """Word numbers of one chunk's texts, ends included."""

    def __init__(self, row: dict):
        self.chunk = row["chunk"]
        self.ids = row["ids"]
        self.folds = r.unsteps(row["folds"])
        self.sizes = r.unsteps(row["sizes"])
        self.words = r.unplanes(row["words"], "<u8")
        codes = memoryview(row["codes"])
        self.codes = r.unplanes(codes[1:], "<u4", codes[0]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        fold = self.folds[self.doc]
        self.learned = (fold != EVALUATED) & (fold != TUNED)
        self.tuned = fold == TUNED

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts and words of the distinct bigrams, and each token's bigram."""
        context = np.empty_like(self.codes)
        context[1:] = self.codes[:-1]
        context[np.cumsum(self.sizes) - self.sizes] = len(self.words)  # before a text
        distinct, which = np.unique(context << 32 | self.codes, return_inverse=True)
        return distinct >> 32, distinct & 0xFFFFFFFF, which


def code_width(words: int) -> int:
    """Bytes that number so many words; three are enough for nearly all chunks."""
    return 3 if words <= 1 << 24 else 4


def encode(rows: DataFrame) -> DataFrame:
    """The coded texts of (row, ord, doc_id, text, fold)."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, more in r.doc_chunks(batches, ("doc_id", "fold"), CODED_BYTES):
            data = LOWER[chunk.data]
            starts, ends = r.word_bounds(data)
            hashes = r.span_hashes(data, starts, ends)
            doc = np.searchsorted(chunk.first, starts, side="right") - 1
            sizes = np.bincount(doc, minlength=len(chunk.rows))
            tokens = np.insert(hashes, np.cumsum(sizes), END)
            words, codes, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            common_first = np.argsort(-counts, kind="stable")
            place = np.empty(len(words), dtype="<u4")
            place[common_first] = np.arange(len(words), dtype="<u4")
            width = code_width(len(words))
            yield r.binary_batch(
                CODED_SCHEMA,
                [
                    (
                        int(chunk.rows[0]),
                        more["doc_id"],
                        r.steps(np.array(more["fold"])),
                        r.steps(sizes + 1),
                        r.planes(words[common_first]),
                        bytes([width]) + r.planes(place[codes], width),
                    )
                ],
            )

    return rows.mapInArrow(run, CODED)


def _asked(
    coded: Coded, hashes: np.ndarray, fit: np.ndarray, tuned: np.ndarray, n_buckets: int,
    key_bytes: int, context: np.ndarray | None = None, word: np.ndarray | None = None,
) -> Iterator[tuple]:
    buckets = (hashes % r.U64(n_buckets)).astype(np.int32)
    keys = hashes >> r.U64(64 - 8 * key_bytes)
    for bucket, at in r.by_bucket(buckets):
        extra = (b"", b"")
        if context is not None:
            chosen = at[tuned[at] > 0]
            extra = (r.steps(context[chosen]), r.steps(word[chosen]))
        yield (
            bucket,
            coded.chunk,
            r.steps(at),
            r.planes(keys[at], key_bytes),
            r.steps(fit[at]),
            r.steps(tuned[at]),
            *extra,
        )


def _answered(batches: Batches, totals: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Sums over all chunks for every entry of a partition's buckets.

    With ``totals`` (words and distinct words without the tuned fold) the entries are
    bigrams, and the histogram for the weights is added.
    """
    key_bytes = WORD_BYTES if totals is None else PAIR_BYTES
    asked: list[tuple] = []
    for batch in batches:
        for p in batch.to_pylist():
            asked.append(
                (
                    p["bucket"],
                    p["chunk"],
                    r.unsteps(p["places"]),
                    r.unplanes(p["keys"], "<u8", key_bytes),
                    r.unsteps(p["fit"]),
                    r.unsteps(p["tuned"]),
                    r.unsteps(p["context"]) if p["context"] else None,
                    r.unsteps(p["word"]) if p["word"] else None,
                )
            )
    if not asked:
        return
    sizes = [len(a[2]) for a in asked]
    bucket = np.repeat(np.array([a[0] for a in asked], dtype=np.int32), sizes)
    keys, fit, tuned = (np.concatenate([a[i] for a in asked]) for i in (3, 4, 5))
    order, group = r.groups(keys, bucket)
    del bucket, keys
    n = int(group[-1]) + 1
    member = np.empty(len(order), dtype=np.int64)
    member[order] = group
    fit_sum = np.bincount(member, weights=fit, minlength=n).astype(np.int64)
    tuned_sum = np.bincount(member, weights=tuned, minlength=n).astype(np.int64)
    all_sum = fit_sum + tuned_sum
    cells = weights = b""
    if totals is not None:
        chosen = np.flatnonzero(tuned > 0)
        context = np.concatenate([a[6] for a in asked])
        word = np.concatenate([a[7] for a in asked])
        cells, weights = _histogram(
            fit_sum[member[chosen]], context, word, tuned[chosen], *totals
        )
    rows, at = [], 0
    stats = (int((all_sum > 0).sum()), int(all_sum.sum()), int((fit_sum > 0).sum()), int(fit_sum.sum()))
    for a, size in zip(asked, sizes):
        m = member[at : at + size]
        at += size
        rows.append(
            (a[1], r.steps(a[2]), r.steps(fit_sum[m]), r.steps(tuned_sum[m]), cells, weights, *stats)
        )
        cells = weights = b""
        stats = (0, 0, 0, 0)
        if len(rows) == 200:
            yield r.binary_batch(TOLD_SCHEMA, rows)
            rows = []
    yield r.binary_batch(TOLD_SCHEMA, rows)


def _bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two below its count."""
    seen = np.maximum(context, 1).astype(np.float64)
    return np.where(context > 0, np.minimum(BUCKETS - 1, 1 + np.floor(np.log2(seen))), 0).astype(
        np.int64
    )


def _estimates(pair, context, word, tokens: int, types: int) -> tuple[np.ndarray, ...]:
    two = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
    return two, word / max(tokens, 1), np.full(len(pair), 1.0 / (types + 1))


def _histogram(pair, context, word, weight, tokens: int, types: int) -> tuple[bytes, bytes]:
    two, one, none = _estimates(pair, context, word, tokens, types)

    def step(estimate: np.ndarray) -> np.ndarray:
        ratio = np.log2(np.maximum(estimate, 1e-300) / none)
        return np.where(estimate > 0, np.rint(ratio * FINE), NEVER).astype(np.int64)

    cell = np.stack((_bucket_of(context), step(two), step(one)), axis=1)
    cells, which = np.unique(cell, axis=0, return_inverse=True)
    sums = np.bincount(which.reshape(-1), weights=weight, minlength=len(cells))
    return r.steps(cells.reshape(-1)), r.steps(sums.astype(np.int64))


def fit_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """(BUCKETS, 3) weights by expectation-maximisation on (bucket, two, one) cells.

    A bucket without held-out words takes the weights of the next lower one with some.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    last = weights[0]
    for bucket in range(BUCKETS):
        here = cells[:, 0] == bucket
        if not here.any():
            weights[bucket] = last
            continue
        ratios = np.stack(
            [
                np.where(cells[here, i] == NEVER, 0.0, 2.0 ** (cells[here, i] / FINE))
                for i in (1, 2)
            ]
            + [np.ones(here.sum())],
            axis=1,
        )
        w = weights[bucket]
        for _ in range(rounds):
            shares = ratios * w
            shares /= shares.sum(axis=1, keepdims=True)
            w = counts[here] @ shares / counts[here].sum()
            w = (w + 1e-6) / (w + 1e-6).sum()  # nothing is impossible
        weights[bucket] = last = w
    return weights


def _known(told: list[dict], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts without and of the tuned fold, by place, from a chunk's answers."""
    fit, tuned = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for t in told:
        places = r.unsteps(t["places"])
        fit[places] = r.unsteps(t["fit"])
        tuned[places] = r.unsteps(t["tuned"])
    return fit, tuned


def _with_start(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Counts by word number with the place before a text, seen as often as ends."""
    ends = counts[words == END]
    return np.append(counts, ends[0] if len(ends) else 0)


def _told_by_chunk(told: DataFrame, name: str) -> DataFrame:
    return told.groupBy("chunk").agg(
        F.collect_list(F.struct("places", "fit", "tuned")).alias(name)
    )


def drop_tables(spark: SparkSession) -> list[str]:
    """Drop the coded tables of this and earlier runs; results not yet read need theirs."""
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith(TABLE_PREFIX)]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return names


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: np.ndarray | None = None
) -> DataFrame:
    """Scores of every text; fits the model on the way.

    doc_id, held_out, n_tokens, n_known, train_tokens, train_types, base_score (smoothed
    word counts alone), score (log10 probability under the mixture). Learns from texts
    whose crc32 of the id is not 0 modulo 10, and fixes the weights on those with 1. A
    NULL id counts as the empty string, so it is scored only. An empty or NULL text is
    its end token. One row per input row; an empty table has no rows, and with nothing
    to learn from every word has the uniform share. Given ``weights``, a row of three per
    context bucket, are used as they are.

    A chunk of about 4 MB of text is held as numpy arrays; one longer text is a chunk of its
    own and needs about 100 bytes of worker memory per byte. Leaves the coded texts and the
    counts in the session's shared folders, see :func:`drop_tables`.
    """
    spark = docs.sparkSession
    rows = r.numbered(docs, id_col, text_col, "lm-rows").withColumn(
        "fold", F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")
    )
    n_buckets = 2 * r.bucket_count(rows)
    files = min(MOST_FILES, max(n_buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"{TABLE_PREFIX}{uuid.uuid4().hex}"
    (
        encode(rows)
        .repartition(files, "chunk")
        .write.option("compression", "zstd")
        .bucketBy(files, "chunk")
        .saveAsTable(name)
    )
    coded = spark.table(name)

    def ask_words(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Coded(row)
                n = len(c.words)
                fit = np.bincount(c.codes[c.learned], minlength=n)
                tuned = np.bincount(c.codes[c.tuned], minlength=n)
                yield r.binary_batch(
                    ASKED_SCHEMA, list(_asked(c, r.mixed(c.words), fit, tuned, n_buckets, WORD_BYTES))
                )

    def tell_words(batches: Batches) -> Iterator[pa.RecordBatch]:
        return _answered(batches, None)

    asked = coded.mapInArrow(ask_words, ASKED).repartitionById(n_buckets, F.col("bucket"))
    words = stored(asked.mapInArrow(tell_words, TOLD), "lm-words")
    sums = words.agg(*(F.sum(c).alias(c) for c in ("types", "tokens", "fit_types", "fit_tokens"))).first()
    types, tokens, fit_types, fit_tokens = (v or 0 for v in sums)

    with_words = coded.join(_told_by_chunk(words, "words_told"), "chunk")

    def ask_pairs(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Coded(row)
                fit, _ = _known(row["words_told"], len(c.words))
                context, word, which = c.pairs()
                first = np.append(c.words, START)[context]
                with np.errstate(over="ignore"):
                    hashes = r.mixed(first * r.BASES[1] + c.words[word])
                learned = np.bincount(which[c.learned], minlength=len(word))
                tuned = np.bincount(which[c.tuned], minlength=len(word))
                asked_rows = _asked(
                    c, hashes, learned, tuned, n_buckets, PAIR_BYTES, _with_start(fit, c.words)[context], fit[word]
                )
                yield r.binary_batch(ASKED_SCHEMA, list(asked_rows))

    def tell_pairs(batches: Batches) -> Iterator[pa.RecordBatch]:
        return _answered(batches, (fit_tokens, fit_types))

    asked = with_words.mapInArrow(ask_pairs, ASKED).repartitionById(n_buckets, F.col("bucket"))
    pairs = stored(asked.mapInArrow(tell_pairs, TOLD), "lm-pairs")
    if weights is None:
        weights = fit_weights(*_cells(pairs))

    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("held_out", pa.bool_()),
            pa.field("n_tokens", pa.int64()),
            pa.field("n_known", pa.int64()),
            pa.field("train_tokens", pa.int64()),
            pa.field("train_types", pa.int64()),
            pa.field("base_score", pa.float64()),
            pa.field("score", pa.float64()),
        ]
    )

    def rate(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Coded(row)
                word_count = sum(_known(row["words_told"], len(c.words)))
                context, word, which = c.pairs()
                pair_count = sum(_known(row["pairs_told"], len(word)))
                before = _with_start(word_count, c.words)[context]
                estimates = _estimates(pair_count, before, word_count[word], tokens, types)
                mix = weights[_bucket_of(before)]
                p = sum(mix[:, i] * e for i, e in enumerate(estimates))
                seen = word_count[c.codes]
                base = np.log10((seen + 0.1) / (tokens + 0.1 * (types + 1)))
                n = len(c.sizes)

                def by_doc(values: np.ndarray) -> np.ndarray:
                    return np.bincount(c.doc, weights=values, minlength=n)

                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(v, f.type)
                        for f, v in zip(
                            schema,
                            (
                                c.ids,
                                c.folds == EVALUATED,
                                c.sizes,
                                by_doc(seen > 0).astype(np.int64),
                                np.full(n, tokens),
                                np.full(n, types),
                                by_doc(base),
                                by_doc(np.log10(p)[which]),
                            ),
                        )
                    ],
                    schema=schema,
                )

    return with_words.join(_told_by_chunk(pairs, "pairs_told"), "chunk").mapInArrow(
        rate,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "train_types long, base_score double, score double",
    )


def _cells(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The histogram of all buckets; its size is bounded by the steps of the estimates."""

    def unpack(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                cells = r.unsteps(p["cells"]).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in cells.T), pa.array(r.unsteps(p["weights"]))],
                    names=["bucket", "two", "one", "n"],
                )

    counted = (
        pairs.where("length(cells) > 0")
        .select("cells", "weights")
        .mapInArrow(unpack, "bucket long, two long, one long, n long")
        .groupBy("bucket", "two", "one")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    values = counted.to_numpy(dtype=np.int64).reshape(-1, 4)
    return values[:, :3], values[:, 3].astype(np.float64)
