"""Removal of repeated substrings with longest-previous-factor arrays.

A byte goes when it lies in a string of ``length`` bytes that also starts in an earlier
document. In a suffix array, that is a suffix whose longest previous factor is at least
``length``: its nearest neighbours in suffix order that start earlier (the previous and
next smaller positions) are where its longest earlier match stands. Only matches of
``length`` bytes count, so suffixes are ordered by their first ``length`` bytes, by a
hash of them, and only suffixes that can have such a match are ordered at all:

1. Every ``length``-byte string holds an *anchor*, the smallest-hashed ``ANCHOR``-byte
   string in it, and so does every copy of it. Anchors of all documents, each with a hash
   of everything up to ``length`` bytes around it, meet in buckets of the hash space.
   Surroundings that are the same in an earlier document settle all their strings at once.
2. Where an anchor has several surroundings, the strings around it that are still open
   are ordered as suffixes of their bucket, and the longest previous factors decide.

The earliest document with a string is never settled by step 1 (a still earlier one would
hold it too), so step 2 always meets it. What repeats within a chunk is reduced to its
earliest document before anything is sent.
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

ANCHOR = 20

# Bytes of a hash that go through the shuffle; the bucket tells a few bits more.
AROUND_BYTES = 8
HEAD_BYTES = 8

PARCEL = (
    "bucket int, rows binary, orders binary, counts binary, places binary, keys binary, "
    "anchors binary, covered binary, row long"
)
PARCEL_SCHEMA = pa.schema(
    [
        pa.field("bucket", pa.int32()),
        pa.field("rows", pa.binary()),
        pa.field("orders", pa.binary()),
        pa.field("counts", pa.binary()),
        pa.field("places", pa.binary()),
        pa.field("keys", pa.binary()),
        pa.field("anchors", pa.binary()),
        pa.field("covered", pa.binary()),
        pa.field("row", pa.int64()),
    ]
)
FOUND = "row long, covered binary, open binary"
FOUND_SCHEMA = pa.schema(
    [
        pa.field("row", pa.int64()),
        pa.field("covered", pa.binary()),
        pa.field("open", pa.binary()),
    ]
)


# -- longest previous factors ------------------------------------------------------------


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest place to the left with a smaller value, or -1.

    All places jump along the answers of the places they have already looked at until
    none moves; equal values lie on one chain, so the jumps stay few.
    """
    n = len(values)
    answer = np.arange(-1, n - 1)
    active = np.flatnonzero(answer >= 0)
    while len(active):
        active = active[values[answer[active]] >= values[active]]
        answer[active] = answer[answer[active]]
        active = active[answer[active] >= 0]
    return answer


def previous_factors(
    key: np.ndarray, more: tuple[np.ndarray, ...], order: np.ndarray, length: int
) -> np.ndarray:
    """Longest previous factor of every suffix, cut at ``length``: ``length`` or 0.

    ``key`` and ``more`` are the hashed heads of the suffixes, ``order`` the place of their
    documents. The suffixes are sorted by head; neighbours with the same head share
    ``length`` bytes.
    """
    lpf = np.zeros(len(key), dtype=np.int64)
    if not len(key):
        return lpf
    suffixes = np.argsort(key)
    s = key[suffixes]
    equal = s[1:] == s[:-1]
    # A head that occurs once has no match: only the others need their exact order, with
    # documents in order within a head, so that nearest smaller places are close by.
    some = suffixes[np.append(equal, False) | np.insert(equal, 0, False)]
    some = some[np.lexsort((order[some], *(m[some] for m in more), key[some]))]
    if not len(some):
        return lpf
    changed = np.zeros(len(some), dtype=bool)
    for k in (key, *more):
        s = k[some]
        changed[1:] |= s[1:] != s[:-1]
    head, value = np.cumsum(changed), order[some]
    previous = nearest_smaller(value)
    following = len(value) - 1 - nearest_smaller(value[::-1])[::-1]
    matched = (previous >= 0) & (head[previous] == head)
    inside = following < len(value)
    matched[inside] |= head[following[inside]] == head[inside]
    lpf[some[matched]] = length
    return lpf


# -- parcels -----------------------------------------------------------------------------


def anchor_hashes(chunk: r.Chunk) -> np.ndarray:
    """Hash of the ANCHOR bytes at each place of the chunk; the largest one across documents."""
    h = r.mixed(r.rolled(chunk.data.astype(r.U64) + r.U64(1), ANCHOR, r.BASES[0]))
    ends = chunk.first[1:] - 1
    crossing = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(crossing, np.clip(ends - ANCHOR + 1, 0, len(h)), 1)
    np.add.at(crossing, np.clip(ends + 1, 0, len(h)), -1)
    h[np.cumsum(crossing[:-1]) > 0] = ~r.U64(0)
    return h


def anchored_by(chunk: r.Chunk, places: np.ndarray, length: int) -> np.ndarray:
    """Starts of the strings of the chunk whose own anchor stands at one of the places."""
    spread = length - ANCHOR + 1
    h = anchor_hashes(chunk)
    if len(h) < spread:
        return np.empty(0, dtype=np.int64)
    chosen = np.full(len(h), ~r.U64(0))
    chosen[places] = h[places]
    lowest = r.slid_min(h, spread)
    return np.flatnonzero((r.slid_min(chosen, spread) == lowest) & (lowest != ~r.U64(0)))


def anchors_of(chunk: r.Chunk, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in the chunk, hash) of every anchor of the chunk."""
    spread = length - ANCHOR + 1
    h = anchor_hashes(chunk)
    if len(h) < spread:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.astype(r.U64)
    ends = chunk.first[1:] - 1  # without the line end
    lowest = r.slid_min(h, spread)
    edge = np.zeros(spread - 1, dtype=r.U64)
    chosen = r.slid_max(np.concatenate((edge, lowest, edge)), spread) == h
    chosen &= h != ~r.U64(0)
    places = np.flatnonzero(chosen)
    doc = np.searchsorted(chunk.first, places, side="right") - 1
    long_enough = ends[doc] - chunk.first[doc] >= length
    return doc[long_enough], places[long_enough], h[places[long_enough]]


def parcels(
    chunk: r.Chunk, doc: np.ndarray, places: np.ndarray, keys: np.ndarray, key_bytes: int,
    anchors: np.ndarray | None, buckets: np.ndarray, n_buckets: int, length: int,
    done: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """Settle what an earlier document of the chunk covers; send the rest by bucket.

    ``done``: places of the chunk that are covered already.
    """
    more = (buckets,) if anchors is None else (anchors, buckets)
    settled = previous_factors(keys, more, chunk.orders[doc], length) >= length
    covered = places[settled] if done is None else np.union1d(done, places[settled])
    in_doc = np.searchsorted(chunk.first, covered, side="right") - 1
    row, hits = r.runs_by_row(chunk.rows[in_doc], covered - chunk.first[in_doc])
    spread = pa.array(row.to_numpy() % n_buckets)
    yield r.filled(PARCEL_SCHEMA, {"bucket": spread, "row": row, "covered": hits})
    inside = places - chunk.first[doc]
    rest = np.flatnonzero(~settled)
    found = []
    for bucket, part in r.by_bucket(buckets[rest]):
        at = rest[part]
        docs, counts = np.unique(doc[at], return_counts=True)
        found.append(
            (
                bucket,
                r.steps(chunk.rows[docs]),
                r.steps(chunk.orders[docs]),
                r.steps(counts),
                r.steps(inside[at]),
                r.planes(keys[at], key_bytes),
                None if anchors is None else r.planes(anchors[at]),
                None,
                None,
            )
        )
    yield r.binary_batch(PARCEL_SCHEMA, found)


def settle(batches: Batches, length: int, with_anchors: bool) -> Iterator[pa.RecordBatch]:
    """Covered places of a partition's buckets and, for anchors, those still open."""
    held: dict[str, list[np.ndarray]] = {}
    n_docs = 0
    key_bytes = AROUND_BYTES if with_anchors else HEAD_BYTES
    for batch in batches:
        passed, rest = r.take_passed(batch, "covered")
        yield r.filled(FOUND_SCHEMA, {n: passed.column(n) for n in ("row", "covered")})
        for p in rest:
            counts, places = r.unsteps(p["counts"]), r.unsteps(p["places"])
            docs = np.arange(n_docs, n_docs + len(counts), dtype=np.int32)
            n_docs += len(counts)
            part = {
                "rows": r.unsteps(p["rows"]),
                "orders": r.unsteps(p["orders"]),
                "doc": np.repeat(docs, counts),
                "place": places.astype(np.uint32),
                "key": r.unplanes(p["keys"], "<u8", key_bytes),
                "bucket": np.full(len(places), p["bucket"], dtype=np.int32),
            }
            if with_anchors:
                part["anchor"] = r.unplanes(p["anchors"], "<u4")
            for name, values in part.items():
                held.setdefault(name, []).append(values)
    if not held:
        return
    # One column at a time, so that little is held twice.
    joined = {name: np.concatenate(held.pop(name)) for name in list(held)}
    doc, key, bucket = joined["doc"], joined["key"], joined["bucket"]
    orders = joined["orders"][doc]
    more = (joined["anchor"], bucket) if with_anchors else (bucket,)
    covered = previous_factors(key, more, orders, length) >= length
    out = [("covered", covered)]
    if with_anchors:
        out.append(("open", _open(bucket, joined["anchor"], key, orders) & ~covered))
    for name, chosen in out:
        at = np.flatnonzero(chosen)
        row, hits = r.runs_by_row(joined["rows"][doc[at]], joined["place"][at].astype(np.int64))
        for first in range(0, len(row), 5000):
            yield r.filled(
                FOUND_SCHEMA, {"row": row.slice(first, 5000), name: hits.slice(first, 5000)}
            )


def _open(bucket: np.ndarray, anchors: np.ndarray, keys: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Places whose anchor has several surroundings and stands in several documents."""
    order, group = r.groups(bucket.astype(r.U64) << r.U64(32) | anchors)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    several = np.ones(len(first), dtype=bool)
    for values in (keys[order], orders[order]):
        several &= np.minimum.reduceat(values, first) != np.maximum.reduceat(values, first)
    result = np.empty(len(order), dtype=bool)
    result[order] = several[group]
    return result


# -- operator ----------------------------------------------------------------------------


def remove_repeats(
    docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts without the bytes that repeat ``length`` or more bytes of an earlier document.

    doc_id, n_bytes, n_removed, n_spans, spans (first and end byte of each removed run),
    kept (the remaining bytes, which need not be UTF-8) and kept_sha256; one row per
    input row. Documents are ordered by id, a NULL id comes last, rows with the same id
    do not remove each other's bytes. The first copy of a string stays. Texts are judged
    as they came in; empty, NULL and shorter ones are untouched.

    A chunk of about 2 MB of text is held as numpy arrays; one longer text is a chunk
    of its own and needs about 60 bytes of worker memory per byte.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    rows = r.numbered(docs, id_col, text_col, "lpf-rows")
    n_buckets = r.bucket_count(rows)
    before = length - ANCHOR

    def send_anchors(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, _ in r.doc_chunks(batches):
            doc, places, h = anchors_of(chunk, length)
            starts = np.maximum(chunk.first[doc], places - before)
            ends = np.minimum(chunk.first[doc + 1] - 1, places + length)
            around = r.span_hashes(chunk.data, starts, ends)
            around = r.mixed(around + (places - starts).astype(r.U64) * r.MIX[1])
            keys = around >> r.U64(64 - 8 * AROUND_BYTES)
            anchors = (h >> r.U64(32)).astype("<u4")
            buckets = (h % r.U64(n_buckets)).astype(np.int32)
            yield from parcels(
                chunk, doc, places, keys, AROUND_BYTES, anchors, buckets, n_buckets, length
            )

    def send_windows(batches: Batches) -> Iterator[pa.RecordBatch]:
        for chunk, more in r.doc_chunks(batches, ("covered", "open")):
            covered = np.zeros(len(chunk.data), dtype=bool)
            within = np.zeros(len(chunk.data), dtype=bool)
            open_ = np.zeros(len(chunk.data), dtype=bool)
            for i in range(len(chunk.datas)):
                a, n = int(chunk.first[i]), len(chunk.datas[i]) - length + 1
                if n <= 0:
                    continue
                within[a : a + n] = True
                # A covered anchor at p stands for all strings that start at p - before .. p,
                # an open one for those that have no anchor but it. Anchors may lie behind
                # the last start of a string.
                if more["covered"][i]:
                    hits = more["covered"][i]
                    covered[a : a + n] = r.marked(hits, n + before, before=before)[:n]
                if more["open"][i]:
                    open_[a : a + n + before] = r.marked(more["open"][i], n + before)
            if not (covered.any() or open_.any()):
                continue
            places = anchored_by(chunk, np.flatnonzero(open_), length)
            places = places[within[places] & ~covered[places]]
            values = chunk.data.astype(r.U64) + r.U64(1)
            heads = r.mixed(r.rolled(values, length, r.BASES[0]))[places]
            buckets = r.mixed(r.rolled(values, length, r.BASES[1]))[places] % r.U64(n_buckets)
            doc = np.searchsorted(chunk.first, places, side="right") - 1
            yield from parcels(
                chunk, doc, places, heads, HEAD_BYTES, None, buckets.astype(np.int32), n_buckets,
                length, np.flatnonzero(covered),
            )

    def among_anchors(batches: Batches) -> Iterator[pa.RecordBatch]:
        return settle(batches, length, True)

    def among_windows(batches: Batches) -> Iterator[pa.RecordBatch]:
        return settle(batches, length, False)

    def settled(sent: DataFrame, look) -> DataFrame:
        dealt = sent.repartitionById(n_buckets, F.col("bucket")).mapInArrow(look, FOUND)
        # NULLs are left out of the lists.
        return dealt.groupBy("row").agg(
            F.collect_list("covered").alias("covered"), F.collect_list("open").alias("open")
        )

    anchored = settled(rows.mapInArrow(send_anchors, PARCEL), among_anchors)
    # Both joins read the same shuffle of the texts.
    around = rows.join(anchored, "row", "left")
    repeats = settled(around.mapInArrow(send_windows, PARCEL), among_windows)

    out = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("n_bytes", pa.int64()),
            pa.field("n_removed", pa.int64()),
            pa.field("n_spans", pa.int64()),
            pa.field("spans", pa.list_(pa.list_(pa.int64()))),
            pa.field("kept", pa.binary()),
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
                    part.column("covered").to_pylist(),
                ):
                    data = text.as_buffer().to_pybytes()
                    kept, spans = data, []
                    if hits:
                        gone = r.marked(hits, len(data), after=length - 1)
                        spans = r.to_runs(np.flatnonzero(gone)).tolist()
                        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    result.append(
                        (
                            doc_id,
                            len(data),
                            len(data) - len(kept),
                            len(spans),
                            spans,
                            kept,
                            hashlib.sha256(kept).hexdigest(),
                        )
                    )
                yield r.binary_batch(out, result)

    return rows.join(repeats, "row", "left").mapInArrow(
        cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, "
        "kept binary, kept_sha256 string",
    )
