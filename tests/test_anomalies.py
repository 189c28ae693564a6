"""Panel, z-score, ranking and explanations."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchtrail.config import ANOMALY
from touchtrail.operators import anomalies
from touchtrail.plans import registry
from touchtrail.sources.store import materialize


def months(n, start=2023):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def panel(spark, **series):
    rows = [(m, channel, float(v)) for channel, values in series.items()
            for m, v in zip(months(len(values)), values)]
    return spark.createDataFrame(rows, "month_start_date date, channel string, monthly_revenue double")


def scored(spark, **series):
    return anomalies.channel_anomalies(panel(spark, **series)).orderBy(
        "channel", "month_start_date").collect()


SPIKE = [90, 100, 95, 105, 100, 98, 102, 250]


def test_known_spike(spark):
    assert (ANOMALY.window, ANOMALY.threshold, ANOMALY.severe_above) == (6, 2.75, 3.5)
    first, last = scored(spark, blog=SPIKE)
    assert not first["is_anomaly"] and first["anomaly_rank"] is None
    assert last["is_anomaly"] and last["anomaly_direction"] == "positive"
    assert last["anomaly_rank"] == 1 and last["severity"] == "severe"
    assert last["expected_revenue"] == last["rolling_mean"] == pytest.approx(100)
    assert last["revenue_difference"] == pytest.approx(150)
    assert last["explanation"].startswith(
        "Blog revenue in Aug 2023 was 150.0% above the 6-month average "
        "(actual $250 vs expected $100, difference $150). This is a severe positive anomaly (z=")
    assert last["explanation"].endswith(", rank 1).")
    assert first["explanation"] == (
        "Blog revenue in Jul 2023 was close to the 6-month baseline "
        "(actual $102 vs expected $98).")


def test_flat_window_has_no_z_score(spark):
    (row,) = scored(spark, blog=[5] * 6 + [50])
    assert row["rolling_std"] == 0.0 and row["z_score"] is None
    assert (row["severity"], row["anomaly_direction"], row["is_anomaly"]) == ("normal", "normal", False)
    assert row["deviation_percent"] == pytest.approx(900)


def test_zero_mean_window_has_no_deviation(spark):
    (row,) = scored(spark, blog=[1, -1, 1, -1, 1, -1, 10])
    assert row["deviation_percent"] is None and row["is_anomaly"]
    assert " was n/a above the " in row["explanation"]


def test_severity_bounds(spark):
    # Mean 0 and deviation 1 in the window, so the last value is the z-score.
    for value, severity in ((2.74, "normal"), (2.75, "moderate"), (3.5, "moderate"), (3.51, "severe"),
                            (-2.75, "moderate"), (-4, "severe")):
        (row,) = scored(spark, blog=[1, -1, 1, -1, 1, -1, value])
        assert row["severity"] == severity
        assert row["is_anomaly"] == (severity != "normal")
        expected = "normal" if severity == "normal" else ("positive" if value > 0 else "negative")
        assert row["anomaly_direction"] == expected


def test_short_series_and_excluded_channels_are_left_out(spark):
    assert scored(spark, short=[1, 2, 3, 4, 5, 6], Unknown=SPIKE) == []


def test_ranks_follow_strength_then_channel_then_month(spark):
    base = [1, -1, 1, -1, 1, -1]
    rows = scored(spark, c=base + [9], a=base + [-9], b=base + [30], d=base + [3], e=base + [2])
    ranks = {r["channel"]: r["anomaly_rank"] for r in rows}
    assert ranks == {"b": 1, "a": 2, "c": 3, "d": 4, "e": None}


def test_bucketed_ranks_equal_one_global_order(spark):
    """Many flagged rows over many buckets, with ties."""
    df = spark.range(3000).select(
        F.concat(F.lit("c"), (F.col("id") % 13).cast("string")).alias("channel"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("month_start_date"),
        (F.floor(F.rand(3) * 500) / 10 * F.when(F.col("id") % 2 == 0, 1).otherwise(-1)).alias("z_score"),
    ).withColumn("is_anomaly", F.abs("z_score") >= 2.75)
    df = materialize(df, "rank_check")
    got = anomalies.rank_anomalies(df).where("is_anomaly").collect()
    expected = sorted(got, key=lambda r: (-abs(r["z_score"]), r["channel"], r["month_start_date"]))
    assert [r["anomaly_rank"] for r in expected] == list(range(1, len(expected) + 1))
    assert len(got) > 2000


def test_panel_is_dense_over_observed_months_only(spark):
    months_seen = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-03-01')) AS month_start_date")
    channels = spark.sql("SELECT explode(array('blog', 'podcast', 'unknown')) AS channel_key")
    revenue = spark.sql("SELECT DATE'2024-03-01' AS month_start_date, 'blog' AS channel, 7D AS monthly_revenue")
    got = {(str(r[0]), r[1]): r[2] for r in anomalies.dense_panel(months_seen, channels, revenue).collect()}
    assert got == {("2024-01-01", "blog"): 0.0, ("2024-03-01", "blog"): 7.0,
                   ("2024-01-01", "podcast"): 0.0, ("2024-03-01", "podcast"): 0.0}


def test_invariants_on_the_test_tables(spark, sf_dir):
    rows = registry.stored_anomalies(spark, sf_dir).collect()
    summary = registry.anomaly_summary(spark, sf_dir).first()
    assert summary["rows_written"] == len(rows) > 0
    assert summary["rows_written"] < summary["channels_analyzed"] * summary["months_analyzed"]
    assert len({(r["channel"], r["month_start_date"]) for r in rows}) == len(rows)
    assert all(r["channel"] != "unknown" and r["rolling_mean"] is not None for r in rows)
    assert all((r["z_score"] is None) == (not r["rolling_std"]) for r in rows)
    assert all(r["is_anomaly"] == (r["z_score"] is not None and abs(r["z_score"]) >= 2.75) for r in rows)
    assert all((r["anomaly_rank"] is not None) == r["is_anomaly"] for r in rows)
    assert all(r["explanation"] for r in rows)
    ranked = sorted((r for r in rows if r["is_anomaly"]), key=lambda r: r["anomaly_rank"])
    strengths = [abs(r["z_score"]) for r in ranked]
    assert strengths == sorted(strengths, reverse=True)


def test_flat_and_balanced_channels_have_no_score_or_deviation(spark, sf_dir):
    from touchtrail.plans import registry

    rows = registry.odd_channel_anomalies(spark, sf_dir)
    flat = rows.where("channel = 'blog'")
    assert flat.count() == flat.where("z_score IS NULL AND NOT is_anomaly").count() > 0
    balanced = rows.where("channel = 'podcast' AND is_anomaly AND deviation_percent IS NULL")
    assert balanced.count() == balanced.where("explanation LIKE '% was n/a %'").count() > 0
