"""Vector operators against dense linear algebra on small tables."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.llm import embedding_collisions, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = ("node", "ball", "key", "value", "copies", "own", "n", "component", "row")


def vector_rows() -> list[tuple]:
    rng = np.random.default_rng(3)
    rows: list[list | None] = [list(v) for v in rng.standard_normal((120, 12)).round(3)]
    # Groups of near copies, some tight enough for a ball and some only in a chain.
    for spread, many in ((0.05, 40), (0.35, 40), (0.2, 5)):
        middle = rng.standard_normal(12)
        rows += [list((middle + spread * rng.standard_normal(12)).round(3)) for _ in range(many)]
    rows += [rows[3]] * 30 + [list(2.0 * np.array(rows[4]))]
    rows += [None, [], [0.0] * 12, [1.0, None] + [0.5] * 10, [math.nan] + [1.0] * 11, [math.inf] + [1.0] * 11]
    return [(i * 7 % 1009, v and [None if x is None else float(x) for x in v], 0) for i, v in enumerate(rows)]


@pytest.fixture(scope="module")
def vectors(spark):
    table = spark.createDataFrame(vector_rows(), SCHEMA).repartition(3)
    return table.select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHING)))


@pytest.fixture(scope="module")
def untidy_vectors(spark):
    rows = vector_rows()
    rows += [rows[0], rows[130], (None, rows[131][1], None), (None, None, None), (5001, [1.0, 2.0], 1), (5002, [2.0, 4.1], 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def collected(table) -> list[tuple]:
    return [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]


def sound(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


# -- near-duplicates ---------------------------------------------------------------------


def linked_rows(rows, least):
    n = len(rows)
    good = [i for i in range(n) if sound(rows[i][1]) and any(rows[i][1])]
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, i in enumerate(good):
        x = np.array(rows[i][1])
        for j in good[a + 1 :]:
            y = np.array(rows[j][1])
            if len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    smallest: dict[int, int] = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), vec_id), vec_id)
    return [
        (vec_id, links[i], smallest.get(find(i)), vec_id == smallest.get(find(i)))
        for i, (vec_id, _) in enumerate(rows)
    ]


@pytest.mark.parametrize("name", ["vectors", "untidy_vectors"])
@pytest.mark.parametrize("least", [0.9, 0.97])
def test_links_and_components(request, name, least):
    table = request.getfixturevalue(name)
    expected = linked_rows(collected(table), least)
    found = embedding_collisions.near_duplicates(table, least).collect()
    assert Counter(map(tuple, found)) == Counter(expected)
    assert max(e[1] for e in expected) >= 30


def test_blocks_change_nothing(vectors, monkeypatch):
    expected = Counter(map(tuple, embedding_collisions.near_duplicates(vectors).collect()))
    monkeypatch.setattr(embedding_collisions, "BLOCK", 4)
    monkeypatch.setattr(embedding_collisions, "PAIRS_AT_ONCE", 7)
    assert Counter(map(tuple, embedding_collisions.near_duplicates(vectors).collect())) == expected


def test_without_balls_every_link_is_found_by_collisions(vectors, monkeypatch):
    expected = Counter(map(tuple, embedding_collisions.near_duplicates(vectors).collect()))
    monkeypatch.setattr(embedding_collisions, "DENSE", 10**9)
    assert Counter(map(tuple, embedding_collisions.near_duplicates(vectors).collect())) == expected


@pytest.mark.parametrize("least", [0.8, 0.9, 0.95])
@pytest.mark.parametrize("vectors_in_table", [1_000, 1_000_000])
def test_calibrated_count_reaches_its_recall(least, vectors_in_table):
    """Pairs exactly at the threshold, hashed by the operator's own functions."""
    plan = embedding_collisions.calibrate(vectors_in_table, least)
    rng = np.random.default_rng(17)
    pairs, dimension = 1_500, 48
    x = rng.standard_normal((pairs, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((pairs, dimension))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = least * x + math.sqrt(1 - least**2) * y
    counted = np.zeros(pairs, dtype=int)
    for table in range(plan.tables):
        same = embedding_collisions.cells(x, table, plan.picks, plan.directions)
        same = same == embedding_collisions.cells(y, table, plan.picks, plan.directions)
        direction = embedding_collisions.projection(dimension, table)
        counted += same & (np.abs(x @ direction - y @ direction) <= plan.window)
    assert (counted >= plan.needed).mean() >= 0.997


def test_tables_follow_the_number_of_vectors():
    """Strangers met per vector stay within bounds while the table grows a millionfold."""
    for n in (10**3, 10**6, 10**9):
        plan = embedding_collisions.calibrate(n, 0.9)
        met = plan.tables * n / (2 * plan.directions) ** plan.picks
        assert met < 1_500 and embedding_collisions.missed(plan.tables, plan.chance, plan.needed) < 0.001


def test_large_components_stay_in_range(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, -1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["component_id"] for r in embedding_collisions.near_duplicates(table).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


# -- whitening ---------------------------------------------------------------------------


def whole(rows) -> tuple[list, np.ndarray]:
    dimension = Counter(len(v) for _, v in rows if sound(v)).most_common(1)[0][0]
    used = [(i, v) for i, v in rows if sound(v) and len(v) == dimension]
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in used], dtype=np.int64)
    return [i for i, _ in used], x


@pytest.mark.parametrize("name", ["vectors", "untidy_vectors"])
def test_whitening(request, name):
    table = request.getfixturevalue(name)
    rows = sorted(collected(table), key=repr)
    ids, x = whole(rows)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    trace = (centred**2).sum() / n
    expected = centred @ vectors / np.sqrt(values)
    found = whitening.whiten(table).collect()
    assert len(found) == n * 8
    # Signs are free but the same for all rows: compare sorted columns under either sign.
    for c in range(8):
        of = [r for r in found if r["component"] == c + 1]
        ours = np.array(sorted(r["whitened"] for r in of))
        theirs = np.sort(expected[:, c])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs[::-1]).max()) < 1e-9
        assert of[0]["explained"] == pytest.approx(values[c] / trace, rel=1e-9)
        assert {r["n"] for r in of} == {n} and of[0]["identity_error"] < 1e-9
    deviations = Counter((i, int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)))) for i, row in zip(ids, x))
    assert Counter((r["vec_id"], int(r["deviation"])) for r in found if r["component"] == 1) == deviations


def test_repeated_eigenvalues_and_missing_directions(spark):
    """Opposite unit vectors: three equal variances, one larger, and dimensions without any."""
    rows = []
    for axis, size in ((0, 1.0), (1, 1.0), (2, 1.0), (3, 4.0)):
        for sign in (1, -1):
            v = [0.0] * 6
            v[axis] = sign * size
            rows.append((len(rows), v))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = whitening.whiten(table).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4}
    shares = {r["component"]: r["explained"] for r in found}
    assert shares == pytest.approx({1: 16 / 19, 2: 1 / 19, 3: 1 / 19, 4: 1 / 19}, rel=1e-9)
    assert max(r["identity_error"] for r in found) < 1e-9


def test_deviation_beyond_a_long_is_exact():
    n = 10**11
    centre = whitening.Centre(n, (n * 100_000 + 7, n * 99_000 + 3))
    x = np.array([[100_512, 98_000], [100_000, 99_000]])
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert [int(v) for v in centre.deviations(x).to_pylist()] == exact
    assert exact[0] > 1 << 63


def test_tables_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    alike = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(4)], SCHEMA)
    unusable = spark.createDataFrame([(1, None, 0), (2, [None], 0), (3, [], 0)], SCHEMA)
    for table in (empty, alike, unusable):
        assert whitening.whiten(table).count() == 0
    assert embedding_collisions.near_duplicates(empty).count() == 0
    assert {tuple(r) for r in embedding_collisions.near_duplicates(unusable).collect()} == {
        (i, 0, i, True) for i in (1, 2, 3)
    }
    assert {tuple(r) for r in embedding_collisions.near_duplicates(alike).collect()} == {
        (i, 3, 0, i == 0) for i in range(4)
    }
