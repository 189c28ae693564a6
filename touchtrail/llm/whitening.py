"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The components are the right singular vectors of the centred rows A. They come from the
recurrences

    A v_j = alpha_j u_j + beta_{j-1} u_{j-1},    A' u_j = alpha_j v_j + beta_j v_{j+1},

whose two products are computed where the rows are, in one scan of blocks of rows: a task
applies A, and A' to the result, and sends back sums whose size follows the dimension, not
the rows. A left vector u_j has an entry per row and is never stored: it is A g_j for a
vector g_j of the rows' dimension, which the driver keeps, so a block can recompute its
part of every earlier u. Both families are fully reorthogonalised against all earlier
vectors, the left ones with the scalar products measured in the same scan (a second scan
where they turn out large). What is left is a small matrix, bidiagonal but for rounding; its
singular value decomposition yields components and deviations.

Rows are whole numbers, so the column sums are exact, rows are centred exactly before
anything is multiplied, and the squared distance from the mean is an exact number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, stored, table_batch
from touchtrail.llm.embedding_collisions import finite

SCALE = 1024
SHIFT = 100_000
BLOCK_BYTES = 1 << 20
SEED = 11
# A direction counts as exhausted below this share of the largest singular value.
EXHAUSTED = 1e-12
# Reorthogonalisation is repeated while it removes more than this share of a vector.
REMOVED = 1e-3
ENTRY_LIMIT = 1 << 52


# -- blocks of whole numbers -----------------------------------------------------------


def whole_numbers(column: pa.Array, dimension: int) -> np.ndarray:
    """floor(1024 * c) + 100000 of every component, as longs."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    scaled = np.floor(values.astype(np.float64).reshape(-1, dimension) * SCALE)
    if scaled.size and np.abs(scaled).max() >= ENTRY_LIMIT:
        raise ValueError("A component is too large: 1024 times it must stay below 2 ** 52")
    return scaled.astype(np.int64) + SHIFT


def blocks(vectors: DataFrame, dimension: int) -> DataFrame:
    """(ids, data): about a megabyte of rows each, as eight-byte numbers."""
    schema = pa.schema([pa.field("ids", pa.list_(pa.int64())), pa.field("data", pa.binary())])
    size = max(1, BLOCK_BYTES // (8 * dimension))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                x = whole_numbers(part.column("embedding"), dimension)
                ids = part.column("vec_id").to_pylist()
                yield table_batch(schema, {"ids": [ids], "data": [x.astype("<i8").tobytes()]})

    return vectors.select("vec_id", "embedding").mapInArrow(run, "ids array<long>, data binary")


def _numbers(value: pa.Scalar, dimension: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<i8").reshape(-1, dimension)


def _sums(table: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Rows and exact column sums; a partial sum of a block fits a long, their sum need not."""
    schema = pa.schema([pa.field("at", pa.int64()), pa.field("part", pa.int64())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                x = _numbers(data, dimension)
                sums = np.concatenate([x.sum(axis=0), [len(x)]])
                yield table_batch(schema, {"at": np.arange(dimension + 1), "part": sums})

    total = (
        table.select("data")
        .mapInArrow(run, "at long, part long")
        .groupBy("at")
        .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        .collect()  # one row per dimension
    )
    found = {r["at"]: int(r["total"]) for r in total}
    return found.get(dimension, 0), [found.get(i, 0) for i in range(dimension)]


@dataclass(frozen=True)
class Centre:
    """The exact mean ``sums / n``, as its whole part and the rest."""

    n: int
    sums: tuple[int, ...]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows: an exact difference of whole numbers, less a fraction below one."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n * x - S) ** 2, exact, as decimal(38, 0)."""
        wide = pa.decimal128(38, 0)
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        apart = x - whole  # n * x - S = n * apart - rest, with 0 <= rest < n
        largest = int(np.abs(apart).max()) if apart.size else 0
        if len(self.sums) * (self.n * (largest + 1)) ** 2 < 1 << 63:
            d = self.n * apart - rest
            return pa.array((d * d).sum(axis=1), pa.int64()).cast(wide)
        exact = self.n * apart.astype(object) - rest.astype(object)
        return pa.array([Decimal(int(v)) for v in (exact * exact).sum(axis=1)], wide)


# -- bidiagonalisation -----------------------------------------------------------------


def scan(table: DataFrame, centre: Centre, left: np.ndarray, towards: np.ndarray) -> np.ndarray:
    """[A'u, U'u, u'u] of u = A ``towards``, U = A ``left``: one pass over the blocks.

    Sums leave a task as one row per number, added up in the shuffle; their count is the
    dimension and the number of earlier vectors.
    """
    schema = pa.schema([pa.field("at", pa.int64()), pa.field("part", pa.float64())])
    dimension = len(towards)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimension + left.shape[1] + 1)
        for batch in batches:
            for data in batch.column("data"):
                a = centre.rows(_numbers(data, dimension))
                u = a @ towards
                back = u @ a
                # The earlier vectors' parts, recomputed for these rows: (A G)' u.
                total += np.concatenate([back, (a @ left).T @ u, [u @ u]])
        yield table_batch(schema, {"at": np.arange(len(total)), "part": total})

    rows = (
        table.select("data")
        .mapInArrow(run, "at long, part double")
        .groupBy("at")
        .agg(F.sum("part").alias("total"))
        .collect()
    )
    result = np.zeros(dimension + left.shape[1] + 1)
    for r in rows:
        result[r["at"]] = r["total"]
    return result


def bidiagonalise(
    table: DataFrame, centre: Centre, steps: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(V, H): orthonormal columns, and U'A V, upper bidiagonal up to rounding.

    Runs until the row space is exhausted (or ``steps`` are done): a vanishing alpha or beta
    closes an invariant subspace, and the next vector is a new one, orthogonal to all before.
    Repeated singular values are found that way too.
    """
    dimension = len(centre.sums)
    rng = np.random.default_rng(SEED)
    right = np.zeros((dimension, 0))  # v_j
    left = np.zeros((dimension, 0))  # g_j, with u_j = A g_j
    back = np.zeros((dimension, 0))  # A' u_j
    shares = np.zeros((0, 0))  # H
    largest = 0.0

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    def fresh() -> np.ndarray | None:
        if right.shape[1] >= dimension:
            return None
        v = orthogonal(rng.standard_normal(dimension))
        return v / np.linalg.norm(v)

    v = fresh()
    while v is not None and (steps is None or right.shape[1] < steps):
        towards, share = v, np.zeros(left.shape[1])
        while True:
            seen = scan(table, centre, left, towards)
            z, c, square = seen[:dimension], seen[dimension:-1], seen[-1]
            # Sums of squares minus what lies in the span of the earlier vectors.
            norm = np.sqrt(max(square - c @ c, 0.0))
            towards, z, share = towards - left @ c, z - back @ c, share + c
            if np.linalg.norm(c) <= REMOVED * norm or norm <= EXHAUSTED * max(largest, norm):
                break
        largest = max(largest, norm, float(np.abs(share).max(initial=0.0)))
        right = np.column_stack([right, v])
        grown = np.zeros((left.shape[1] + 1, right.shape[1]))
        grown[: shares.shape[0], : shares.shape[1]] = shares
        grown[: len(share), -1] = share
        if norm <= EXHAUSTED * largest or not norm:
            # v maps into the span of the earlier vectors: no new left vector.
            shares = grown[:-1]
            v = fresh()
            continue
        grown[-1, -1] = norm
        shares = grown
        left = np.column_stack([left, towards / norm])
        back = np.column_stack([back, z / norm])
        following = orthogonal(z / norm)
        beta = np.linalg.norm(following)
        v = following / beta if beta > EXHAUSTED * largest else fresh()
    return right, shares


@dataclass(frozen=True)
class Whitening:
    """Unit eigenvectors (columns) of the covariance, falling eigenvalues, and its trace."""

    dimension: int
    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ self.components / np.sqrt(self.eigenvalues)


def fit(table: DataFrame, dimension: int, components: int, steps: int | None = None) -> Whitening:
    n, sums = _sums(table, dimension)
    centre = Centre(n, tuple(sums))
    right, shares = bidiagonalise(table, centre, steps) if n else (np.zeros((dimension, 0)),) * 2
    _, deviations, turned = np.linalg.svd(shares, full_matrices=False)
    found = deviations**2 / max(n, 1)
    kept = int((deviations[:components] > 1e-10 * deviations.max(initial=0.0)).sum())
    vectors = right @ turned[:kept].T
    # Either sign would do: the entry of largest size is positive.
    strongest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[strongest, np.arange(kept)])
    return Whitening(dimension, centre, vectors, found[:kept], float(found.sum()))


def identity_error(table: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened rows' covariance minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    schema = pa.schema([pa.field("at", pa.int64()), pa.field("part", pa.float64())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            for data in batch.column("data"):
                w = model.whiten(_numbers(data, model.dimension))
                total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield table_batch(schema, {"at": np.arange(len(total)), "part": total})

    rows = (
        table.select("data")
        .mapInArrow(run, "at long, part double")
        .groupBy("at")
        .agg(F.sum("part").alias("total"))
        .collect()
    )
    total = np.zeros(k + k * k)
    for r in rows:
        total[r["at"]] = r["total"]
    mean = total[:k] / model.centre.n
    covariance = total[k:].reshape(k, k) / model.centre.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


# -- operator --------------------------------------------------------------------------


def whiten(
    vectors: DataFrame,
    components: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    steps: int | None = None,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row per usable vector and component, components numbered from 1 by falling
    eigenvalue. A vector that is NULL, empty, or holds NULL or non-finite components is left
    out, and so are vectors of another dimension than the most common one (of equally
    common ones the smallest). Repeated rows count each time; a NULL id stays NULL. Directions
    without variance give no component: equal vectors, or a single one, give no rows, nor
    does an empty table. ``deviation`` is an exact decimal(38,0). ``steps`` bounds the
    Lanczos steps for very long vectors; by default they run until the space is exhausted.
    Memory on the driver: three matrices of dimension by steps.
    """
    spark = vectors.sparkSession
    out = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")
    ).where(finite(F.col("embedding")))
    common = (
        rows.groupBy(F.size("embedding").alias("dimension"))
        .count()
        .orderBy(F.desc("count"), "dimension")
        .first()
    )
    if common is None:
        return spark.createDataFrame([], out)
    dimension = common["dimension"]
    table = stored(blocks(rows.where(F.size("embedding") == dimension), dimension), "whitening")
    model = fit(table, dimension, components, steps)
    error = identity_error(table, model)
    k = len(model.eigenvalues)
    explained = model.eigenvalues / model.trace if k else model.eigenvalues
    schema = pa.schema([
        pa.field("vec_id", pa.int64()), pa.field("component", pa.int32()), pa.field("n", pa.int64()),
        pa.field("deviation", pa.decimal128(38, 0)), pa.field("whitened", pa.float64()),
        pa.field("explained", pa.float64()), pa.field("identity_error", pa.float64()),
    ])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("data")):
                x = _numbers(data, dimension)
                w = model.whiten(x)
                every = np.repeat(np.arange(len(x)), k)
                yield table_batch(schema, {
                    "vec_id": ids.values.take(pa.array(every)),
                    "component": np.tile(np.arange(1, k + 1), len(x)),
                    "n": np.full(len(x) * k, model.centre.n),
                    "deviation": model.centre.deviations(x).take(pa.array(every)),
                    "whitened": w.ravel(),
                    "explained": np.tile(explained, len(x)),
                    "identity_error": np.full(len(x) * k, error),
                })

    return table.mapInArrow(run, out)
