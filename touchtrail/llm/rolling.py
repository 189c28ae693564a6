"""Numpy helpers for operators that look at every window of every text.

A window is known by hashes computed for a whole chunk of documents at once. What goes
through a shuffle are *parcels*: for a chunk and a bucket of the hash space one row with
the chunk's entries in that bucket, each number array stored byte plane by byte plane so
that the shuffle's compression removes the high zeros. A chunk resolves what repeats
within it before anything is sent, so a window found in a third of all documents costs
one entry per chunk, not one per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, stored, texts

U64 = np.uint64
# Odd multipliers of the rolling polynomials and of the final mixing.
BASES = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
MIX = (U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53))
CHUNK = 2 << 20
BUCKET_BYTES = 32 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads the bits of 64-bit numbers."""
    h = h ^ (h >> U64(33))
    h *= MIX[0]
    h ^= h >> U64(33)
    h *= MIX[1]
    h ^= h >> U64(33)
    return h


def rolled(values: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every ``size`` consecutive values, by doubling."""
    if len(values) < size:
        return np.empty(0, dtype=U64)
    result: np.ndarray | None = None
    power, width, block = base, 1, values
    done, done_power = 0, U64(1)
    rest = size
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if result is None:
                    result, done, done_power = block, width, power
                else:  # block of ``width`` values after the ``done`` ones so far
                    n = len(values) - done - width + 1
                    result = result[:n] * power + block[done : done + n]
                    done += width
                    done_power = done_power * power
            rest >>= 1
            if rest:
                n = len(block) - width
                block = block[:n] * power + block[width : width + n]
                power = power * power
                width *= 2
    return result[: len(values) - size + 1]


def slid_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values."""
    width, block = 1, values
    while width * 2 <= size:
        block = np.minimum(block[:-width], block[width:])
        width *= 2
    if width < size:
        shift = size - width
        block = np.minimum(block[:-shift], block[shift:])
    return block


def slid_max(values: np.ndarray, size: int) -> np.ndarray:
    return ~slid_min(~values, size)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) of a byte array."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.concatenate(([True], space, [True]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, from differences of one running polynomial."""
    base = BASES[0]
    with np.errstate(over="ignore"):
        inverse = U64(pow(int(base), -1, 1 << 64))
        down = np.full(len(data) + 1, base, dtype=U64)
        down[0] = 1
        np.multiply.accumulate(down, out=down)
        running = np.concatenate(([U64(0)], np.cumsum((data.astype(U64) + U64(1)) * down[:-1])))
        up = np.full(len(data) + 1, inverse, dtype=U64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        h = (running[ends] - running[starts]) * up[starts]
        return mixed(h + (ends - starts).astype(U64) * MIX[0])


# -- parcels ---------------------------------------------------------------------------


def planes(values: np.ndarray, keep: int | None = None) -> bytes:
    """The bytes of the numbers, lowest bytes of all first; ``keep`` leaves out higher ones."""
    size = values.dtype.itemsize
    raw = values.view(np.uint8).reshape(len(values), size)[:, : keep or size]
    return np.ascontiguousarray(raw.T).tobytes()


def unplanes(data: bytes, dtype: str, keep: int | None = None) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    keep = keep or size
    stored_bytes = np.frombuffer(data, np.uint8).reshape(keep, -1)
    raw = np.zeros((stored_bytes.shape[1], size), dtype=np.uint8)
    raw[:, :keep] = stored_bytes.T
    return raw.view(dtype).reshape(-1)


def steps(values: np.ndarray) -> bytes:
    """Integers as differences, for increasing or slowly changing sequences."""
    v = values.astype(np.int64)
    with np.errstate(over="ignore"):
        d = np.diff(v, prepend=np.int64(0))
    d = ((d << 1) ^ (d >> 63)).view(U64)  # small negatives become small too
    width = max(1, -(-int(d.max()).bit_length() // 8)) if len(d) else 1
    return bytes([width]) + planes(d, width)


def unsteps(data: bytes) -> np.ndarray:
    d = unplanes(memoryview(data)[1:], "<u8", data[0])
    d = (d >> U64(1)).astype(np.int64) ^ -(d & U64(1)).astype(np.int64)
    with np.errstate(over="ignore"):
        return np.cumsum(d)


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indexes in ascending order) of every bucket that occurs."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(buckets[part[0]]), part


def to_runs(positions: np.ndarray) -> np.ndarray:
    """Ascending distinct positions as (start, end) rows of consecutive runs."""
    if not len(positions):
        return np.empty((0, 2), dtype=np.int64)
    cut = np.flatnonzero(np.diff(positions) != 1)
    starts = positions[np.concatenate(([0], cut + 1))]
    ends = positions[np.concatenate((cut, [len(positions) - 1]))] + 1
    return np.stack((starts, ends), axis=1)


MOST = 0xFFFF


def marked(stored_runs: list[bytes], size: int, before: int = 0, after: int = 0) -> np.ndarray:
    """Which of ``size`` places lie in one of the stored runs, each run widened by
    ``before`` places to the left and ``after`` to the right."""
    pairs = np.frombuffer(b"".join(stored_runs), "<u2").reshape(-1, 2).astype(np.int64)
    counts = np.array([len(data) // 4 for data in stored_runs])
    moved = np.cumsum(pairs.sum(axis=1))
    last = np.cumsum(counts)
    earlier = np.where(last > counts, moved[last - counts - 1], 0)
    ends = moved - np.repeat(earlier, counts)
    real = pairs[:, 1] > 0
    starts, ends = (ends - pairs[:, 1])[real], ends[real]
    level = np.bincount(np.clip(starts - before, 0, size), minlength=size + 1)
    level -= np.bincount(np.clip(ends + after, 0, size), minlength=size + 1)
    return np.cumsum(level[:size]) > 0


def runs_by_row(rows: np.ndarray, positions: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(row, its runs of positions as bytes) for positions that ascend within a row and
    rows that stand together.

    A run is two 16-bit numbers: the gap since the end of the run before it, and its
    length. Longer gaps and runs take several pairs.
    """
    if not len(rows):
        return pa.array([], pa.int64()), pa.array([], pa.binary())
    new_row = rows[1:] != rows[:-1]
    cut = np.flatnonzero(new_row | (positions[1:] != positions[:-1] + 1))
    first = np.concatenate(([0], cut + 1))
    starts, ends = positions[first], positions[np.concatenate((cut, [len(rows) - 1]))] + 1
    of_run = rows[first]
    begins = np.concatenate(([True], of_run[1:] != of_run[:-1]))
    gaps = starts - np.where(begins, 0, np.concatenate(([0], ends[:-1])))
    lengths = ends - starts
    bridges, rests = gaps // MOST, (lengths - 1) // MOST
    size = bridges + 1 + rests
    offset = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(offset, size)
    of_pair = np.repeat(bridges, size)
    pairs = np.zeros((len(at), 2), dtype="<u2")
    pairs[at < of_pair, 0] = MOST
    pairs[at > of_pair, 1] = MOST
    pairs[at == of_pair, 0] = gaps - bridges * MOST
    pairs[at == of_pair, 1] = lengths - rests * MOST
    offsets = np.append(offset[begins], len(at)).astype(np.int32) * 4
    binary = pa.Array.from_buffers(
        pa.binary(),
        int(begins.sum()),
        [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs.tobytes())],
    )
    return pa.array(of_run[begins], pa.int64()), binary


def filled(schema: pa.Schema, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of the given columns, NULL in all others."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema],
        schema=schema,
    )


def take_passed(batch: pa.RecordBatch, name: str) -> tuple[pa.RecordBatch, list[dict]]:
    """Rows that carry finished hits in column ``name``, and the parcels among the rest."""
    passed = batch.column(name).is_valid()
    return batch.filter(passed), batch.filter(pc.invert(passed)).to_pylist()


def groups(key: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number along the order) of equal rows of keys.

    Rows are sorted by ``key`` alone; the other keys sort only what is equal in it.
    """
    order = np.argsort(key)
    s = key[order]
    equal = s[1:] == s[:-1]
    if more and equal.any():
        some = np.flatnonzero(np.append(equal, False) | np.insert(equal, 0, False))
        members = order[some]
        order[some] = members[np.lexsort((*(m[members] for m in more[::-1]), key[members]))]
    changed = np.zeros(len(order), dtype=bool)
    changed[1:] = ~equal
    for k in more:
        s = k[order]
        changed[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(changed)


# -- chunks ----------------------------------------------------------------------------


class Chunk:
    """Documents laid end to end, each with a line end: ``data`` (bytes), ``rows``,
    ``orders`` and ``first``, the start of each document and, last, the end of all."""

    def __init__(self, rows: list[int], orders: list[int], datas: list[bytes]):
        self.rows = np.array(rows, dtype=np.int64)
        self.orders = np.array(orders, dtype=np.int64)
        self.datas = datas
        # A line end after each document keeps words of neighbours apart.
        self.first = np.concatenate(([0], np.cumsum([len(d) + 1 for d in datas]))).astype(np.int64)
        self.data = np.frombuffer(b"\n".join([*datas, b""]), np.uint8)


def doc_chunks(batches: Batches, extra: tuple[str, ...] = (), size: int = CHUNK) -> Iterator[tuple[Chunk, dict]]:
    """Chunks of about ``size`` bytes of (row, ord, text) batches, with further columns."""
    rows: list[int] = []
    orders: list[int] = []
    datas: list[bytes] = []
    more: dict[str, list] = {n: [] for n in extra}
    held = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("row", "ord", *extra)]
        for i, text in enumerate(batch.column("text")):
            rows.append(columns[0][i])
            orders.append(columns[1][i])
            datas.append(text.as_buffer().to_pybytes())
            for n, c in zip(extra, columns[2:]):
                more[n].append(c[i])
            held += len(datas[-1]) + 16
            if held >= size:
                yield Chunk(rows, orders, datas), more
                rows, orders, datas, held = [], [], [], 0
                more = {n: [] for n in extra}
    if rows:
        yield Chunk(rows, orders, datas), more


def numbered(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """(row, ord, doc_id, text): ``row`` tells rows apart, ``ord`` orders documents.

    Both are the id where ids are unique and not NULL. Otherwise rows get numbers of
    their own, fixed by storing them; a NULL id comes after all others.
    """
    plain = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    doubtful = plain.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if doubtful.isEmpty():
        return plain.select(F.col("doc_id").alias("row"), F.col("doc_id").alias("ord"), "doc_id", "text")
    last = F.lit((1 << 63) - 1)
    return stored(
        plain.select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce("doc_id", last).alias("ord"),
            "doc_id",
            "text",
        ),
        name,
    )


def bucket_count(rows: DataFrame) -> int:
    """Buckets for the windows of all texts, a bounded share of the bytes for each."""
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(8, -(-total // BUCKET_BYTES))


def binary_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
