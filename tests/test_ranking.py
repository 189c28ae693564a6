"""Global ranks over range partitions."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import anomalies, ranking


@pytest.mark.parametrize("rows", [0, 1, 7, 3000])
def test_ranks_are_positions_in_the_order(spark, rows):
    rng = random.Random(rows)
    data = [(rng.choice([1.5, 2.0, 2.0, 9.0]), f"c{rng.randrange(40)}", i) for i in range(rows)]
    df = spark.createDataFrame(data, "z double, channel string, month int").repartition(5)
    got = ranking.global_rank(df, [F.col("z").desc(), F.col("channel").asc(), F.col("month").asc()], "rank", "r")
    expected = sorted(data, key=lambda r: (-r[0], r[1], r[2]))
    found = sorted(map(tuple, got.collect()), key=lambda r: r[3])
    assert found == [(*r, i) for i, r in enumerate(expected, 1)]


def test_a_million_equal_values_are_spread_evenly(spark):
    panel = spark.range(1_000_000).select(
        F.concat(F.lit("c"), (F.col("id") % 1000).cast("string")).alias("channel"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 1000).cast("int")).alias("month_start_date"),
        F.lit(-4.0).alias("z_score"), F.lit(True).alias("is_anomaly"))
    ranked = anomalies.rank_anomalies(panel)
    done = ranked.agg(F.countDistinct("anomaly_rank"), F.min("anomaly_rank"), F.max("anomaly_rank")).first()
    assert tuple(done) == (1_000_000, 1, 1_000_000)
    first = ranked.where("anomaly_rank <= 2").orderBy("anomaly_rank").select("channel", "month_start_date").collect()
    assert [r["channel"] for r in first] == ["c0", "c0"] and first[0][1] < first[1][1]
    sizes = [r["n"] for r in ranking.placed(
        panel.repartition(8).select("channel", "month_start_date", F.abs("z_score").alias("s")),
        [F.col("s").desc(), F.col("channel").asc(), F.col("month_start_date").asc()],
    ).groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * statistics.median(sizes)
