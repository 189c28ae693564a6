"""Duplicated keys from shared cells, against plain counts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.operators import uniqueness as u


def plain(claims, null_is_key):
    found = {}
    for name, (df, c) in claims.items():
        rows = df if null_is_key else df.where(F.col(c).isNotNull())
        found[name] = rows.groupBy(c).count().where("count > 1").count()
    return found


def found(claims, null_is_key=False):
    return {r["check_name"]: r["duplicated"] for r in u.duplicated_keys(claims, null_is_key).collect()}


@pytest.fixture(scope="module")
def claims(spark):
    keys = spark.range(40_000, numPartitions=6).select(
        F.concat(F.lit("key-"), F.col("id") % 39_000).alias("few"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hot"),
        F.when(F.col("id") % 100 > 0, F.col("id")).alias("gaps"),
        "id",
        F.lit(None).cast("int").alias("nothing"),
    )
    none = keys.limit(0)
    one = keys.limit(1)
    return {c: (keys, c) for c in keys.columns} | {"none": (none, "id"), "one": (one, "few"), "null": (one, "nothing")}


@pytest.mark.parametrize("null_is_key", [False, True])
def test_same_as_plain_counts(claims, null_is_key):
    expected = plain(claims, null_is_key)
    assert found(claims, null_is_key) == expected
    assert expected["few"] == 1000 and expected["hot"] == 1 and expected["nothing"] == null_is_key


def test_many_ranges_small_tasks_and_a_shuffled_reply(claims, monkeypatch):
    expected = plain(claims, False)
    monkeypatch.setattr(u, "HELD", 500)
    monkeypatch.setattr(u, "SENT_BACK", 3)
    assert u._bits(200_000)[1] >= 8
    assert found(claims) == expected


def test_crowded_cells_only_cost_counting(claims, monkeypatch):
    """Nearly all keys share cells: the exact counts decide."""
    expected = plain(claims, False)
    monkeypatch.setattr(u, "_bits", lambda keys: (12, 3))
    assert found(claims) == expected


@pytest.mark.parametrize("seed", range(5))
def test_cells_pack_and_unpack(seed):
    rng = np.random.default_rng(seed)
    start = int(rng.integers(0, 1 << 50))
    cells = np.sort(rng.integers(0, 1 << int(rng.integers(1, 50)), 300, dtype=np.uint64)) + np.uint64(start)
    assert (u._unpacked(u._packed(cells, start), start) == cells).all()


def test_space_keeps_shared_cells_few():
    for keys in (10, 10**6, 10**9, 10**11):
        bits, ranges = u._bits(keys)
        assert ranges <= bits <= 62 and keys / 2**ranges <= u.HELD
        assert keys * keys / 2 ** (bits + 1) <= max(u.SHARED, keys / 16)


def shuffled_bytes(spark, run):
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        quantiles = spark._sc._gateway.new_array(spark._jvm.double, 0)
        stages = store.stageList(None, False, False, quantiles, None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_little_is_shuffled(spark):
    keys = spark.range(400_000, numPartitions=8).select(
        F.concat(F.lit("customer-"), F.md5(F.col("id").cast("string"))).alias("k"))
    ours = shuffled_bytes(spark, lambda: u.duplicated_keys({"k": (keys, "k")}).collect())
    plainly = shuffled_bytes(
        spark, lambda: keys.groupBy("k").count().where("count > 1").agg(F.count("k")).collect())
    assert 0 < ours < plainly / 5


def test_many_shared_cells_do_not_send_all_keys(spark, monkeypatch):
    """Beyond SENT_BACK cells only rows that the sieve lets pass are shuffled."""
    keys = spark.range(400_000, numPartitions=8).select(
        F.concat(F.lit("customer-"), F.md5((F.col("id") % 380_000).cast("string"))).alias("k"))
    monkeypatch.setattr(u, "SENT_BACK", 1000)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as for tables too large to broadcast
    try:
        rows = []
        ours = shuffled_bytes(spark, lambda: rows.extend(u.duplicated_keys({"k": (keys, "k")}).collect()))
        plainly = shuffled_bytes(
            spark, lambda: keys.groupBy("k").count().where("count > 1").agg(F.count("k")).collect())
    finally:
        spark.conf.set(threshold, usual)
    assert rows[0]["duplicated"] == 20_000
    assert 0 < ours < plainly / 2


@pytest.mark.parametrize("sieve_bits", [3, 9, 16, 18])
def test_sieve_holds_all_cells_and_few_others(spark, sieve_bits, monkeypatch):
    """Small and large bitmaps, with and without false hits: counts stay exact."""
    hashed = spark.range(3000, numPartitions=5).select("id", F.xxhash64("id").alias("h"))
    cells = hashed.where("id < 50").select(F.shiftrightunsigned("h", 64 - 20).alias("cell"))
    monkeypatch.setattr(u, "SIEVE_BITS", sieve_bits)
    passed = {r["id"] for r in u._through_sieve(hashed, F.col("h"), cells, 20).collect()}
    assert passed >= set(range(50))
    top = {r["p"] for r in hashed.where("id < 50").select(F.shiftrightunsigned("h", 64 - sieve_bits).alias("p")).collect()}
    also = hashed.where(F.shiftrightunsigned("h", 64 - sieve_bits).isin(*top)).collect()
    assert passed == {r["id"] for r in also}
