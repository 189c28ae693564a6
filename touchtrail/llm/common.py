"""Small helpers shared by the text operators.

Conventions of all operators of this package:

* An operator reads only the id and the text column it is told to; other columns,
  whatever their names, are ignored. Results carry the id as ``doc_id``.
* A NULL text is an empty text. Rows are never merged: a repeated row is a document
  of its own. A NULL id is passed through as NULL.
* ASCII white space is ``\\x20 \\x09-\\x0D``; a word is a run of other characters.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchtrail.sources.store import scratch_path

Batches = Iterable[pa.RecordBatch]

# Work is cut into chunks of about this many bytes, so that the numpy temporaries of
# a task stay small whatever the batch size is.
CHUNK_BYTES = 1 << 20


def texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, text) with NULL texts as empty ones, and the ``carried`` columns."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *carried,
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def with_row(docs: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """The rows with a number of their own, ``name``: the id, where ids are unique and not NULL.

    Otherwise rows get other numbers, fixed by storing them.
    """
    doubtful = docs.groupBy(F.col(id_col)).count().where(F.col("count") > 1)
    if doubtful.isEmpty() and docs.where(F.col(id_col).isNull()).isEmpty():
        return docs.withColumn(name, F.col(id_col).cast("long"))
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    For results with several readers: later steps start from files every executor
    sees, so a lost executor costs one step at most.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, dict]:
    """As :func:`stored`, with aggregates of the rows taken while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return stored(df.observe(seen, *measures), name), seen.get


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def table_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema
    )


def chunks(batches: Batches) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) in chunks of about CHUNK_BYTES."""
    for batch in batches:
        ids, sizes, out = [], 0, []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            ids.append(doc_id)
            out.append(data)
            sizes += len(data)
            if sizes >= CHUNK_BYTES:
                yield ids, out
                ids, sizes, out = [], 0, []
        if ids:
            yield ids, out


def runs(batches: Batches, keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Consecutive rows with equal keys, of batches sorted by the keys.

    Only the current run is held; callers bound the run length beforehand.
    """
    held: list[dict[str, np.ndarray]] = []

    def joined() -> dict[str, np.ndarray]:
        return {n: np.concatenate([h[n] for h in held]) for n in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
        changed = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            changed |= columns[k][1:] != columns[k][:-1]
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            part = {n: c[a:b] for n, c in columns.items()}
            if held and any(held[-1][k][-1] != part[k][0] for k in keys):
                yield joined()
                held = []
            held.append(part)
    if held:
        yield joined()
