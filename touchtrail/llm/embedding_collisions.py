"""Near-duplicate vectors from counted collisions of sorted one-dimensional projections.

A projection on a random direction keeps similar vectors close, so every vector opens a
window around its own value and counts in how many projections another one stands in it.
One projection alone tells little: its window still holds a third of all vectors. Each of
the ``tables`` therefore sorts its projection within cells, which are the strongest of a
set of random directions, a few times over. A pair collides in a table if it has the cell
and the window in common; pairs with ``needed`` collisions or more are verified by their
cosine in double precision.

Directions are independent Gaussians, so the chance of a collision depends on the cosine
of a pair alone, never on the data, and the count is binomial: the number of tables is
calibrated so that a pair just at the threshold is counted often enough with a probability
of RECALL, closer pairs with more. Cells, and with them tables, follow the number of
vectors, so a vector meets about as many strangers whatever the size of the table.

Groups are kept from producing all their pairs:

* equal vectors are one vector with a number of copies;
* vectors within half the threshold's angle of one pivot form a *ball*. All of its
  members link, by the triangle inequality, so its links are counted and not listed.
  Balls collide as one entry, which covers the interval of its members' values;
* a hot cell is compared in pairs of blocks, and so are the members of two balls, whose
  links leave the task as sums per vector and one edge per pair of balls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, exp, lgamma, log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, runs, stored, table_batch
from touchtrail.llm.components import components
from touchtrail.llm.rolling import U64, mixed
from touchtrail.llm.simhash import block_pairs

RECALL = 0.9995
NEEDED = 2
SEED = 13
BLOCK = 1024
# Rounds in which dense places are contracted to balls, and the least vectors of such a place.
ROUNDS = 3
DENSE = 3
# Rounding of double dot products cannot carry a ball's members over this margin.
MARGIN = 1e-9
PAIRS_AT_ONCE = 1 << 19
TRIALS = 20_000


# -- calibration -----------------------------------------------------------------------


@dataclass(frozen=True)
class Calibration:
    """``picks`` times the strongest of ``directions``, one sorted projection, per table."""

    picks: int
    directions: int
    window: float
    tables: int
    needed: int
    chance: float  # of a collision in one table, for a pair at the threshold


def same_pick(directions: int, cosine: float) -> float:
    """Chance that a pair has the same strongest direction, simulated with a fixed seed."""
    rng = np.random.default_rng(SEED)
    x = rng.standard_normal((TRIALS, directions), dtype=np.float32)
    y = cosine * x + sqrt(1 - cosine**2) * rng.standard_normal(x.shape, dtype=np.float32)
    a, b = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1)
    row = np.arange(TRIALS)
    # Three standard errors down, so that the promised recall is met.
    share = float(np.mean((a == b) & (x[row, a] * y[row, b] > 0)))
    return max(1e-6, share - 3 * sqrt(share * (1 - share) / TRIALS))


def in_window(window: float, cosine: float) -> float:
    spread = sqrt(2 * (1 - cosine))
    return erf(window / spread / sqrt(2)) if spread else 1.0


def missed(tables: int, chance: float, needed: int) -> float:
    """P(fewer than ``needed`` collisions in ``tables``)."""
    if chance >= 1:
        return 0.0
    return sum(
        exp(
            lgamma(tables + 1) - lgamma(k + 1) - lgamma(tables - k + 1)
            + k * log(chance) + (tables - k) * log1p(-chance)
        )
        for k in range(min(needed, tables + 1))
    )


def calibrate(vectors: int, least: float, needed: int = NEEDED) -> Calibration:
    """The cheapest tables that keep RECALL at the threshold.

    Cost is counted in bytes per vector: its entries, and the chance collisions with
    unrelated vectors that a table of ``vectors`` vectors brings, each with its share of the
    counting. Related vectors collide more often than by chance, so these weigh much.
    """
    best: tuple[float, Calibration] | None = None
    for directions in (8, 12, 16, 24, 32, 48, 64):
        pick = same_pick(directions, least)
        for picks in range(1, 9):
            strangers = vectors / (2 * directions) ** picks
            for widths in (1.5, 2.0, 2.5):
                window = widths * sqrt(2 * (1 - least))
                chance = pick**picks * in_window(window, least)
                tables = needed
                while missed(tables, chance, needed) > 1 - RECALL and tables < 5_000:
                    tables = ceil(tables * 1.05) + 1
                cost = tables * (48 + 4 * picks + 64 * strangers * in_window(window, 0.0))
                found = Calibration(picks, directions, window, tables, needed, chance)
                if tables < 5_000 and (best is None or cost < best[0]):
                    best = (cost, found)
    assert best
    return best[1]


# -- projections -----------------------------------------------------------------------


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors in double precision), one item per dimension."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for dimension in np.unique(lengths):
        at = np.flatnonzero(lengths == dimension)
        rows = values[offsets[at][:, None] + np.arange(dimension)[None, :]].astype(np.float64)
        yield at, unit(rows)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares stay in range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def cells(units: np.ndarray, table: int, picks: int, directions: int) -> np.ndarray:
    """A 64-bit name of each vector's cell in a table."""
    dimension = units.shape[1]
    key = np.full(len(units), U64(table + (dimension << 32)))
    for pick in range(picks):
        rng = np.random.default_rng((SEED, dimension, table, pick))
        towards = units @ rng.standard_normal((dimension, directions))
        strongest = np.abs(towards).argmax(axis=1)
        sign = towards[np.arange(len(units)), strongest] > 0
        key = mixed(key) + (2 * strongest + sign).astype(U64)
    return mixed(key).view(np.int64)


def projection(dimension: int, table: int) -> np.ndarray:
    return np.random.default_rng((SEED + 1, dimension, table)).standard_normal(dimension)


def keyed_vectors(vectors: DataFrame, table: int, picks: int, directions: int) -> DataFrame:
    """(node, key) with the cell of each vector in one table."""
    schema = pa.schema([pa.field("node", pa.int64()), pa.field("key", pa.int64())])

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            for at, units in matrices(batch.column("embedding")):
                keys = cells(units, table, picks, directions)
                yield table_batch(schema, {"node": node[at], "key": keys})

    return vectors.select("node", "embedding").mapInArrow(run, "node long, key long")


def entries(balled: DataFrame, plan: Calibration) -> DataFrame:
    """(key, ball, low, high): where each ball stands in the cells of every table."""
    schema = pa.schema(
        [pa.field("key", pa.int64()), pa.field("ball", pa.int64()), pa.field("value", pa.float64())]
    )

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball = batch.column("ball").to_numpy()
            for at, units in matrices(batch.column("embedding")):
                for table in range(plan.tables):
                    # Tables of the contraction come first, these are independent of them.
                    number = ROUNDS + table
                    keys = cells(units, number, plan.picks, plan.directions)
                    value = units @ projection(units.shape[1], number)
                    yield table_batch(schema, {"key": keys, "ball": ball[at], "value": value})

    return (
        balled.select("ball", "embedding")
        .mapInArrow(run, "key long, ball long, value double")
        .groupBy("key", "ball")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )


# -- balls -----------------------------------------------------------------------------


def finite(vector: Column) -> Column:
    """Neither NULL nor empty, and every component is a finite number."""
    numbers = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(numbers & (F.size(vector) > 0), F.lit(False))


def usable(vector: Column) -> Column:
    """Finite and not zero."""
    return finite(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def _cosine(a: Column, b: Column) -> Column:
    """In double precision, of vectors with one dimension."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.sqrt(dot(a, a)) / F.sqrt(dot(b, b))


def contract(vectors: DataFrame, count: int, least: float) -> DataFrame:
    """(node, ball) of the vectors that stand within half the threshold's angle of a pivot.

    Dense cells are found by their counts; the pivot of a cell is its smallest node, one
    that has a ball already before others. Vectors that no round takes stay on their own,
    which costs comparisons later but no links.
    """
    half = sqrt((1 + least) / 2) + MARGIN
    picks = max(1, ceil(log(max(count, 2)) / log(128)))
    taken = None
    late = 1 << 62
    for table in range(ROUNDS):
        keyed = keyed_vectors(vectors, table, picks, 64)
        order = F.col("node") + F.lit(late)
        if taken is not None:
            pivots = taken.select(F.col("ball").alias("node")).distinct().withColumn("old", F.lit(True))
            keyed = keyed.join(taken.select("node"), "node", "left_anti").join(pivots, "node", "left")
            order = F.when(F.col("old"), F.col("node")).otherwise(order)
        else:
            keyed = keyed.withColumn("old", F.lit(None).cast("boolean"))
        keyed = stored(keyed, "collision-cells")
        dense = (
            keyed.groupBy("key")
            .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
            .where(F.col("n") >= DENSE)
            .select("key", F.col("first").bitwiseAND(late - 1).alias("ball"))
        )
        # Both tables are one row per dense cell; its members are spread by their own node.
        pivots = dense.join(vectors.select(F.col("node").alias("ball"), F.col("embedding").alias("pivot")), "ball")
        members = (
            keyed.where("old IS NULL")
            .join(pivots, "key")
            .where("node <> ball")
            .join(vectors.select("node", "embedding"), "node")
            .where(F.size("embedding") == F.size("pivot"))
            .where(_cosine(F.col("embedding"), F.col("pivot")) >= half)
            .select("node", "ball")
        )
        members = stored(members, "collision-balls")
        taken = members if taken is None else taken.unionByName(members)
    return taken


# -- collisions ------------------------------------------------------------------------


def whole_runs(batches: Batches, keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of sorted batches cut at the borders of runs, with the number of each run."""
    rest: dict[str, np.ndarray] | None = None

    def numbered(part: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        changed = np.zeros(len(part[keys[0]]), dtype=bool)
        for k in keys:
            changed[1:] |= part[k][1:] != part[k][:-1]
        return part | {"run": np.cumsum(changed)}

    for batch in batches:
        if not batch.num_rows:
            continue
        part = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
        if rest is not None:
            part = {n: np.concatenate([rest[n], c]) for n, c in part.items()}
        run = numbered(part)["run"]
        last = np.searchsorted(run, run[-1])
        if last:
            yield numbered({n: c[:last] for n, c in part.items()})
        rest = {n: c[last:] for n, c in part.items()}
    if rest is not None:
        yield numbered(rest)


def window_pairs(part: dict[str, np.ndarray], window: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of one run whose intervals are at most ``window`` apart.

    Rows are sorted by run and ``low``, so the partners of a row follow it in one stretch.
    """
    low, high, run = part["low"], part["high"], part["run"]
    step = 2 * (np.abs(low).max() + np.abs(high).max() + window) + 1
    ends = np.searchsorted(run * step + low, run * step + high + window, side="right")
    many = ends - np.arange(len(low)) - 1
    total = np.cumsum(many)
    first = 0
    while first < len(many):
        before = total[first] - many[first]
        last = max(first + 1, int(np.searchsorted(total, before + PAIRS_AT_ONCE, side="right")))
        count = many[first:last]
        left = np.repeat(np.arange(first, last), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        first = last
        if len(left):
            yield left, right


def collisions(placed: DataFrame, plan: Calibration) -> DataFrame:
    """(a, b) with a < b: balls that collide in ``needed`` tables or more."""
    dealt = block_pairs(placed, "ball", BLOCK)
    schema = pa.schema([pa.field("a", pa.int64()), pa.field("b", pa.int64())])
    keys = ["key", "lo", "hi"]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for part in whole_runs(batches, keys):
            ball, own = part["ball"], part["own"]
            within = part["lo"] == part["hi"]  # rows of one block meet there only
            for left, right in window_pairs(part, plan.window):
                ok = within[left] | (own[left] != own[right])
                a, b = ball[left[ok]], ball[right[ok]]
                yield table_batch(schema, {"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return (
        dealt.repartition(*(F.col(k) for k in keys))
        .sortWithinPartitions(*keys, "low")
        .mapInArrow(run, "a long, b long")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= plan.needed)
        .select("a", "b")
    )


# -- verification ----------------------------------------------------------------------


def verified(pairs: DataFrame, balled: DataFrame, sizes: DataFrame, least: float) -> DataFrame:
    """(kind, x, y): kind 0, links of vector x to vectors of other balls; kind 1, linked balls.

    The larger ball of a pair is the host; all guests of a host are one pool, and both are
    cut into blocks, so that a task compares two blocks and every pair of vectors meets in
    exactly one task.
    """
    size = sizes.select("ball", "members")
    sized = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b")
    host_is_a = F.col("na") >= F.col("nb")
    hosted = sized.select(
        F.when(host_is_a, F.col("a")).otherwise(F.col("b")).alias("host"),
        F.when(host_is_a, F.col("b")).otherwise(F.col("a")).alias("guest"),
        F.greatest("na", "nb").alias("n_host"),
        F.least("na", "nb").alias("n_guest"),
    )
    hosts = hosted.groupBy("host").agg(
        F.ceil(F.max("n_host") / BLOCK).cast("int").alias("host_blocks"),
        F.ceil(F.sum("n_guest") / BLOCK).cast("int").alias("guest_blocks"),
    )
    hosts = stored(hosts, "collision-hosts")
    member = balled.select("ball", "node", "embedding", "copies")

    def dealt(rows: DataFrame, own: str, other: str, is_guest: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.select(
            "host", "ball", "node", "embedding", "copies", own, other,
            F.lit(is_guest).alias("is_guest"), mine.alias("mine"), theirs.alias("theirs"),
        ).select(
            "host", "ball", "node", "embedding", "copies", "is_guest",
            F.when(F.col("is_guest") == 1, F.col("theirs")).otherwise(F.col("mine")).alias("host_block"),
            F.when(F.col("is_guest") == 1, F.col("mine")).otherwise(F.col("theirs")).alias("guest_block"),
        )

    host_rows = hosts.join(member, hosts["host"] == member["ball"])
    guest_rows = hosted.select("host", "guest").join(hosts, "host").join(
        member, F.col("guest") == member["ball"]
    )
    both = dealt(host_rows, "host_blocks", "guest_blocks", 0).unionByName(
        dealt(guest_rows, "guest_blocks", "host_blocks", 1)
    )
    schema = pa.schema([pa.field(n, pa.int64()) for n in ("kind", "x", "y")])
    keys = ["host", "host_block", "guest_block"]

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        count = 0
        for rows in runs(batches, keys):
            for found in _block_links(rows, least):
                held.append(found)
                count += len(found[1])
            if count > 50_000:
                yield _found(schema, held)
                held, count = [], 0
        if held:
            yield _found(schema, held)

    return (
        both.repartition(*(F.col(k) for k in keys))
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "kind long, x long, y long")
    )


def _found(schema: pa.Schema, held: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return table_batch(schema, {
        "kind": np.concatenate([np.full(len(x), kind) for kind, x, _ in held]),
        "x": np.concatenate([x for _, x, _ in held]),
        "y": np.concatenate([y for _, _, y in held]),
    })


def _block_links(
    rows: dict[str, np.ndarray], least: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    lengths = np.fromiter(map(len, rows["embedding"]), np.int64, len(rows["node"]))
    for dimension in np.unique(lengths):
        guest = rows["is_guest"] == 1
        hosts = np.flatnonzero((lengths == dimension) & ~guest)
        guests = np.flatnonzero((lengths == dimension) & guest)
        if not len(hosts) or not len(guests):
            continue
        x = unit(np.stack(rows["embedding"][hosts]).astype(np.float64))
        y = unit(np.stack(rows["embedding"][guests]).astype(np.float64))
        linked = (x @ y.T) >= least
        for of, to, near in ((hosts, guests, linked), (guests, hosts, linked.T)):
            links = near @ rows["copies"][to].astype(np.int64)
            some = links > 0
            yield 0, rows["node"][of[some]], links[some]
        balls = np.unique(rows["ball"][guests[linked.any(axis=0)]])
        yield 1, np.full(len(balls), rows["host"][0]), balls


# -- operator --------------------------------------------------------------------------


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Two rows link if the cosine of their vectors, in double precision, is at least
    ``least`` (above 0). ``n_links`` counts other rows, copies included; ``component_id`` is
    the smallest id reachable, ``kept`` whether it is the row's own. A vector that is NULL,
    empty, zero, or holds NULL or non-finite components links with nothing and is kept;
    vectors of different dimensions never link. Repeated rows stay and link with each other;
    a row without an id takes part and gets its component's id, NULL if no row of it has one
    (kept then, as all rows of such a component). An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")
    )
    good = usable(F.col("embedding"))
    distinct = (
        rows.where(good)
        .groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    )
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "collision-vectors")
    taken = contract(nodes, nodes.count(), least)
    balled = stored(
        nodes.join(taken, "node", "left").withColumn("ball", F.coalesce("ball", "node")),
        "collision-members",
    )
    sizes = stored(
        balled.groupBy("ball").agg(
            F.count(F.lit(1)).alias("members"),
            F.sum("copies").alias("rows"),
            F.min("first_id").alias("first_id"),
        ),
        "collision-sizes",
    )
    plan = calibrate(sizes.count(), least)
    pairs = stored(collisions(entries(balled, plan), plan), "collision-pairs")
    found = stored(verified(pairs, balled, sizes, least), "collision-links")

    edges = found.where("kind = 1").select("x", "y").distinct()
    linked = components(edges)
    named = sizes.join(linked, sizes["ball"] == linked["node"], "left").select(
        "ball", "rows", "first_id", F.coalesce("component", "ball").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    links = found.where("kind = 0").groupBy(F.col("x").alias("node")).agg(F.sum("y").alias("across"))
    labels = (
        balled.join(named.join(smallest, "root").select("ball", "rows", "component_id"), "ball")
        .join(links, "node", "left")
        .select(
            "embedding",
            (F.col("rows") - 1 + F.coalesce("across", F.lit(0))).alias("n_links"),
            "component_id",
        )
    )
    # Stored, so that the join with the rows can split a vector of many copies.
    labels = stored(labels, "collision-labels")
    known = rows.where(good).join(labels, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
