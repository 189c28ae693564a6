"""Exact repeats of word windows, found with fixed-block anchors.

Every window of ``window`` words holds one whole block of the grid that cuts its
document into blocks of ``(window + 1) // 2`` words. So

1. the grid blocks of all documents are the index, and every rolling window of a
   block's length probes it; places whose block stands in the index somewhere else are
   anchors;
2. around each anchor the full windows are looked up among all such windows: those
   that occur twice or more repeat, and neighbours join to maximal exact repeats;
3. the words they cover are removed.

Both look-ups go through hash buckets of bounded size (see ``rolling``): step 1 may
take a place too many, as its hashes are short; step 2 decides, by more than 80 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm import rolling as r
from touchtrail.llm.common import Batches

PARCEL = "bucket int, rows binary, counts binary, places binary, short binary, long binary, seen binary, hits binary, row long"
PARCEL_SCHEMA = pa.schema(
    [
        pa.field("bucket", pa.int32()),
        pa.field("rows", pa.binary()),
        pa.field("counts", pa.binary()),
        pa.field("places", pa.binary()),
        pa.field("short", pa.binary()),
        pa.field("long", pa.binary()),
        pa.field("seen", pa.binary()),
        pa.field("hits", pa.binary()),
        pa.field("row", pa.int64()),
    ]
)
HITS_SCHEMA = pa.schema([pa.field("row", pa.int64()), pa.field("hits", pa.binary())])


PASSES = 8  # over a bucket's keys, an eighth at a time
PIECE = 128 << 10  # bytes of text whose words are hashed at once
SLICE = 64 << 10  # places of a bucket whose runs are made at once


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, a piece of the text at a time.

    ``span_hashes`` holds several 8-byte numbers per byte of its text, and a span's hash
    does not depend on where in the text it stands.
    """
    hashes = np.empty(len(starts), dtype=r.U64)
    cuts = np.searchsorted(starts, np.arange(0, len(data), PIECE))
    for a, b in zip(cuts, np.append(cuts[1:], len(starts))):
        if a < b:
            first = starts[a]
            hashes[a:b] = r.span_hashes(
                data[first : ends[b - 1]], starts[a:b] - first, ends[a:b] - first
            )
    return hashes


class Words:
    """Word starts, ends, hashes, and documents of a chunk."""

    def __init__(self, chunk: r.Chunk):
        self.starts, self.ends = r.word_bounds(chunk.data)
        self.hashes = word_hashes(chunk.data, self.starts, self.ends)
        self.doc = np.searchsorted(chunk.first, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(chunk.rows))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def whole(self, size: int) -> np.ndarray:
        """Which places start ``size`` words of one document."""
        n = max(0, len(self.doc) - size + 1)
        return self.doc[:n] == self.doc[size - 1 : size - 1 + n]


def parcels(
    chunk: r.Chunk, words: Words, places: np.ndarray, buckets: np.ndarray, short: np.ndarray,
    long: np.ndarray | None, n_buckets: int,
) -> Iterator[pa.RecordBatch]:
    """Resolve what repeats within the chunk, and send one witness of it and the rest.

    ``places``: word places in the chunk, ascending. Witnesses are marked as seen.
    """
    order, group = r.groups(short, buckets) if long is None else r.groups(short, long, buckets)
    size = np.bincount(group) if len(group) else np.empty(0, dtype=np.int64)
    repeated = np.zeros(len(places), dtype=bool)
    repeated[order] = size[group] > 1
    leader = np.zeros(len(places), dtype=bool)
    if len(order):
        leader[order[np.concatenate(([True], np.diff(group) > 0))]] = True
    doc = words.doc[places]
    inside = places - words.first[doc]
    row, hits = r.runs_by_row(chunk.rows[doc[repeated]], inside[repeated])
    spread = pa.array(row.to_numpy() % n_buckets)
    yield r.filled(PARCEL_SCHEMA, {"bucket": spread, "row": row, "hits": hits})
    sent = np.flatnonzero(~repeated | leader)
    found = []
    for bucket, part in r.by_bucket(buckets[sent]):
        at = sent[part]
        docs, counts = np.unique(doc[at], return_counts=True)
        found.append(
            (
                bucket,
                r.steps(chunk.rows[docs]),
                r.steps(counts),
                r.steps(inside[at]),
                r.planes(short[at]),
                b"" if long is None else r.planes(long[at]),
                np.packbits(repeated[at]).tobytes(),
                None,
                None,
            )
        )
    yield r.binary_batch(PARCEL_SCHEMA, found)


def look_up(batches: Batches, grid: int | None) -> Iterator[pa.RecordBatch]:
    """Places of a partition's buckets whose key occurs again.

    With ``grid``, one of the places must be a block of the index, or a witness.

    Two tasks and the JVM share an executor's memory, so what is held per place is little:
    its key, its number, and a mark; documents are found from their counts of places.
    """
    held: dict[int, dict[str, bytearray]] = {}  # grown in place, so nothing is joined later
    kinds: dict[str, np.dtype] = {}
    for batch in batches:
        passed = batch.column("hits").is_valid()
        yield batch.select(["row", "hits"]).filter(passed)
        # Row by row: as a list, all parcels of the batch would be held a second time.
        for i in np.flatnonzero(~passed.to_numpy(zero_copy_only=False)).tolist():
            p = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            places = r.unsteps(p["places"])
            part = {
                "rows": r.unsteps(p["rows"]),
                "counts": r.unsteps(p["counts"]).astype(np.uint32),
                "place": places.astype(np.uint32),
                "seen": np.unpackbits(
                    np.frombuffer(p["seen"], np.uint8), count=len(places)
                ).view(bool),
                "key": r.unplanes(p["short"], "<u4" if grid else "<u8"),
            }
            if not grid:
                part["long"] = r.unplanes(p["long"], "<u2")
            kinds = {name: values.dtype for name, values in part.items()}
            columns = held.setdefault(p["bucket"], {name: bytearray() for name in part})
            for name, values in part.items():
                columns[name] += values.tobytes()
    batch = passed = p = part = places = values = columns = None  # not needed any more
    while held:
        columns = held.popitem()[1]
        yield from occurring_again(
            {name: np.frombuffer(data, kinds[name]) for name, data in columns.items()}, grid
        )


def occurring_again(bucket: dict[str, np.ndarray], grid: int | None) -> Iterator[pa.RecordBatch]:
    """(row, runs of its places) for the places of one bucket whose key occurs again."""
    key, places, seen = bucket["key"], bucket["place"], bucket["seen"]
    found = np.zeros(len(key), dtype=bool)
    # Equal keys go to the same pass.
    share = key.view(np.uint8)[:: key.itemsize] % PASSES
    for number in range(PASSES):
        at = np.flatnonzero(share == number)
        order, group = r.groups(key[at]) if grid else r.groups(key[at], bucket["long"][at])
        at = at[order]
        size = np.bincount(group)
        hit = np.zeros(len(size), dtype=bool)
        if grid:
            hit[group[places[at] % grid == 0]] = True
            hit &= size > 1
        else:
            hit = size > 1
        hit[group[seen[at]]] = True
        found[at] = hit[group]
    found &= ~seen
    ends = np.cumsum(bucket["counts"], dtype=np.uint32)  # of the documents, in places
    for first in range(0, len(found), SLICE):
        at = np.flatnonzero(found[first : first + SLICE]) + first
        doc = np.searchsorted(ends, at.astype(np.uint32), side="right")
        row, hits = r.runs_by_row(bucket["rows"][doc], places[at].astype(np.int64))
        yield pa.RecordBatch.from_arrays([row, hits], schema=HITS_SCHEMA)


def remove_repeats(
    docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Words left of every document after all repeated windows are taken out.

    doc_id, n_words, n_removed, kept (the remaining words joined by one space), spans
    (array of first and end word of each removed run) and kept_sha256; one row per
    input row. A window repeats when the same words start anywhere else, in this or
    another document; every occurrence goes. Texts of fewer than ``window`` words are
    untouched. Empty and NULL texts have no words.

    A chunk of about 2 MB of text is held as numpy arrays; one longer text is a chunk
    of its own and needs about 60 bytes of worker memory per byte.
    """
    block = (window + 1) // 2
    rows = r.numbered(docs, id_col, text_col, "repeat-rows")
    n_buckets = r.bucket_count(rows)
    # Fewer windows than places are looked up, at twice the bytes each.
    n_window_buckets = max(4, n_buckets // 2)

    def probe(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, _ in r.doc_chunks(batches):
            words = Words(chunk)
            ok = words.whole(block)
            ok &= words.counts[words.doc[: len(ok)]] >= window
            places = np.flatnonzero(ok)
            h = r.mixed(r.rolled(words.hashes, block, r.BASES[1]))[places]
            buckets = (h % r.U64(n_buckets)).astype(np.int32)
            short = (h >> r.U64(32)).astype("<u4")
            yield from parcels(chunk, words, places, buckets, short, None, n_buckets)

    def extend(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, more in r.doc_chunks(batches, ("hits",)):
            if not any(more["hits"]):
                continue
            words = Words(chunk)
            near = np.zeros(len(words.doc), dtype=bool)
            for i, hits in enumerate(more["hits"]):
                if hits:
                    a, b = words.first[i], words.first[i + 1]
                    near[a:b] = r.marked(hits, b - a, before=window - block)
            ok = words.whole(window)
            places = np.flatnonzero(ok & near[: len(ok)])
            one = r.mixed(r.rolled(words.hashes, window, r.BASES[1]))[places]
            two = r.mixed(r.rolled(words.hashes, window, r.BASES[0]))[places]
            buckets = (two % r.U64(n_window_buckets)).astype(np.int32)
            long = (two >> r.U64(48)).astype("<u2")
            yield from parcels(chunk, words, places, buckets, one, long, n_window_buckets)

    def among_blocks(batches: Batches) -> Iterator[pa.RecordBatch]:
        return look_up(batches, block)

    def among_windows(batches: Batches) -> Iterator[pa.RecordBatch]:
        return look_up(batches, None)

    def looked_up(sent: DataFrame, look, n: int) -> DataFrame:
        dealt = sent.repartitionById(n, F.col("bucket"))
        found = dealt.mapInArrow(look, "row long, hits binary")
        return found.groupBy("row").agg(F.collect_list("hits").alias("hits"))

    anchors = looked_up(rows.mapInArrow(probe, PARCEL), among_blocks, n_buckets)
    # Both joins read the same shuffle of the texts.
    around = rows.join(anchors, "row", "left")
    repeats = looked_up(around.mapInArrow(extend, PARCEL), among_windows, n_window_buckets)

    out = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("n_words", pa.int64()),
            pa.field("n_removed", pa.int64()),
            pa.field("kept", pa.string()),
            pa.field("spans", pa.list_(pa.list_(pa.int64()))),
            pa.field("kept_sha256", pa.string()),
        ]
    )

    def cut(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                result = []
                for doc_id, text, hits in zip(
                    part.column("doc_id").to_pylist(),
                    part.column("text"),
                    part.column("hits").to_pylist(),
                ):
                    words = text.as_buffer().to_pybytes().split()
                    kept, spans = words, []
                    if hits:
                        gone = r.marked(hits, len(words), after=window - 1)
                        spans = r.to_runs(np.flatnonzero(gone)).tolist()
                        kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    joined = b" ".join(kept)
                    result.append(
                        (
                            doc_id,
                            len(words),
                            len(words) - len(kept),
                            joined.decode(),
                            spans,
                            hashlib.sha256(joined).hexdigest(),
                        )
                    )
                yield r.binary_batch(out, result)

    return rows.join(repeats, "row", "left").mapInArrow(
        cut,
        "doc_id long, n_words long, n_removed long, kept string, spans array<array<long>>, "
        "kept_sha256 string",
    )
