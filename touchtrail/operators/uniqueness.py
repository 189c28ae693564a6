"""Duplicated keys of many tables without shuffling the keys.

Every key is hashed to a cell of a space so large that hardly any two keys share one. What
goes through the shuffle is which cells occur, once or more than once, in sorted runs of a
task: two to four bytes a key, whatever the keys are made of, and two entries per task for a
key that holds a third of all rows. Cells that turn out to be taken twice, by one key or by
two, are sent back, and only rows in such cells are counted by their keys, exactly.

Few cells are sent back as they are. Many become a bitmap of a fixed size, which lets rows of
some other cells pass as well: these are counted too, and found to be alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.sources.store import materialize

Claim = tuple[DataFrame, str]

HELD = 1 << 21  # cells that a task sorts at once, and about as many per range
# Cells shared by different keys stay below this number on average, at any number of keys.
SHARED = 1 << 22
SENT_BACK = 1 << 22  # cells that are broadcast, 32 MB of them
SIEVE_BITS = 28  # the bitmap of more cells has 2 to the power of this, 32 MB
BLOCK_BITS = 15  # of the bitmap in one row


def _bits(keys: int) -> tuple[int, int]:
    """Bits of a cell, and its upper bits that name a range."""
    space = max(1 << 16, 16 * keys, keys * keys / (2 * SHARED))
    return min(62, ceil(log2(space))), max(0, ceil(log2(max(1, keys / HELD))))


def _packed(cells: np.ndarray, start: int) -> bytes:
    """Sorted cells as differences, lowest bytes of all first, in as few bytes as they need."""
    gaps = np.diff(cells, prepend=np.uint64(start)).astype("<u8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(data: bytes, start: int) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    raw[:, :width] = planes.T
    return np.cumsum(raw.view("<u8").reshape(-1)) + np.uint64(start)


def shared_cells(hashes: DataFrame, bits: int, range_bits: int) -> DataFrame:
    """(cell) of every cell that more than one row of ``h`` falls in."""
    shift, own = np.uint64(64 - bits), bits - range_bits

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flushed() -> pa.RecordBatch:
            cells, times = np.unique(np.concatenate(held), return_counts=True)
            cells = np.repeat(cells, np.minimum(times, 2))
            ranges = cells >> np.uint64(own)
            first = np.flatnonzero(np.diff(ranges, prepend=~ranges[:1]))
            parts = np.split(cells, first[1:])
            names = ranges[first].tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array([_packed(c, n << own) for c, n in zip(parts, names)], pa.binary())],
                names=["range", "cells"],
            )

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("h").to_numpy().view(np.uint64) >> shift)
                count += batch.num_rows
            if count >= HELD:
                yield flushed()
                held, count = [], 0
        if count:
            yield flushed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def shared() -> pa.RecordBatch:
            cells = np.sort(np.concatenate(held))
            again = np.unique(cells[1:][cells[1:] == cells[:-1]])
            return pa.RecordBatch.from_arrays([pa.array(again.view(np.int64))], names=["cell"])

        for batch in batches:
            for n, data in zip(batch.column("range").to_pylist(), batch.column("cells")):
                if n != name and held:
                    yield shared()
                    held = []
                name = n
                held.append(_unpacked(data.as_buffer().to_pybytes(), n << own))
        if held:
            yield shared()

    return (
        hashes.select("h")
        .mapInArrow(send, "range long, cells binary")
        .repartition("range")
        .sortWithinPartitions("range")
        .mapInArrow(meet, "cell long")
    )


def sieve(cells: DataFrame, bits: int, sieve_bits: int) -> DataFrame:
    """(block, words): a bitmap of the upper ``sieve_bits`` bits of the cells, in rows of 4 KB.

    A task has a row for every block it saw a cell of. Stored cells of a range stand together,
    so there is hardly more than one row a block; blocks without a cell have none.
    """
    dropped, per_block = np.uint64(bits - sieve_bits), min(sieve_bits, BLOCK_BITS)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros((1 << (sieve_bits - per_block), 1 << max(0, per_block - 6)), dtype=np.uint64)
        flat, seen = words.reshape(-1), np.zeros(len(words), dtype=bool)
        for batch in batches:
            place = batch.column("cell").to_numpy().view(np.uint64) >> dropped
            np.bitwise_or.at(flat, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
            seen[place >> np.uint64(per_block)] = True
        blocks = np.flatnonzero(seen)
        for some in np.array_split(blocks, len(blocks) // 1024 + 1):
            ends = np.arange(len(some) + 1, dtype=np.int32) * words.shape[1]
            held = pa.ListArray.from_arrays(pa.array(ends), pa.array(words[some].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), held], names=["block", "words"])

    return cells.mapInArrow(mark, "block long, words array<long>")


def _through_sieve(rows: DataFrame, h: Column, cells: DataFrame, bits: int) -> DataFrame:
    """Rows whose hash falls in one of the cells, and some more."""
    sieve_bits = min(bits, SIEVE_BITS)
    marked = materialize(sieve(cells, bits, sieve_bits), "sieve")
    place = F.shiftrightunsigned(h, 64 - sieve_bits)
    word = F.get("words", F.shiftright(place, 6).bitwiseAND((1 << (BLOCK_BITS - 6)) - 1))
    hit = F.getbit(word, place.bitwiseAND(63).cast("int")) == 1
    block = F.shiftright(place, min(sieve_bits, BLOCK_BITS))
    return rows.join(F.broadcast(marked), (block == F.col("block")) & hit, "left_semi")


def duplicated_keys(claims: Mapping[str, Claim], null_is_key: bool = False) -> DataFrame:
    """(check_name, duplicated): keys that more than one row has, for every (table, column).

    Tables are read twice, all claims on one table at once. A NULL is no key unless
    ``null_is_key``.
    """
    names = list(claims)
    by_table: dict[int, tuple[DataFrame, list[tuple[int, str]]]] = {}
    for number, (df, column) in enumerate(claims.values()):
        by_table.setdefault(id(df), (df, []))[1].append((number, column))
    pairs = []
    for df, columns in by_table.values():
        listed = ", ".join(f"{n}, CAST(`{c}` AS STRING)" for n, c in columns)
        found = df.selectExpr(f"stack({len(columns)}, {listed}) AS (number, value)")
        pairs.append(found if null_is_key else found.where("value IS NOT NULL"))
    every = reduce(DataFrame.unionByName, pairs)
    keys = sum(df.count() * len(columns) for df, columns in by_table.values())
    bits, range_bits = _bits(keys)

    h = F.xxhash64("number", "value")
    cells = materialize(shared_cells(every.select(h.alias("h")), bits, range_bits), "shared-cells")
    if cells.count() <= SENT_BACK:
        cell: Column = F.shiftrightunsigned(h, 64 - bits)
        chosen = every.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left_semi")
    else:
        chosen = _through_sieve(every, h, cells, bits)
    counted = (
        chosen.groupBy("number", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
        .groupBy("number")
        .agg(F.count(F.lit(1)).alias("duplicated"))
    )
    spark = every.sparkSession
    all_names = spark.createDataFrame(list(enumerate(names)), "number int, check_name string")
    return all_names.join(counted, "number", "left").select(
        "check_name", F.coalesce("duplicated", F.lit(0)).cast("bigint").alias("duplicated")
    )
