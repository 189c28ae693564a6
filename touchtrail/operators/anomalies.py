"""Lagged rolling z-score over a dense key x month panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.config import ANOMALY, AnomalyConfig
from touchtrail.functions.text import fixed, money, month_label, title_label
from touchtrail.operators.dimensions import with_calendar
from touchtrail.operators.ranking import global_rank

PANEL_COLUMNS = ("month_start_date", "channel", "monthly_revenue")


def _excluded(key: Column, config: AnomalyConfig) -> Column:
    return F.lower(key).isin([k.lower() for k in config.excluded_keys])


def monthly_channel_revenue(
    cells: DataFrame, dates: DataFrame, config: AnomalyConfig = ANOMALY
) -> DataFrame:
    """Last-touch revenue per month and channel, without the excluded channels."""
    channel = F.col("last_touch_channel")
    kept = cells.where(~_excluded(channel, config))
    return (
        with_calendar(
            kept, dates, "revenue_date_key", "user_id", month_start_date="month_start_date"
        )
        .groupBy("month_start_date", channel.alias("channel"))
        .agg(F.sum("revenue_amount").cast("double").alias("monthly_revenue"))
    )


def dense_panel(
    months: DataFrame, channels: DataFrame, revenue: DataFrame, config: AnomalyConfig = ANOMALY
) -> DataFrame:
    """Every observed month for every channel; absent revenue is 0.

    The list of months is bounded by the calendar, so it travels as one array
    value and each channel row is expanded where it is.
    """
    spine = months.agg(F.array_sort(F.collect_set("month_start_date"))).scalar()
    key = F.col("channel_key")
    grid = (
        channels.where(~_excluded(key, config))
        .select(key.alias("channel"), spine.alias("_months"))
        .select("channel", F.explode("_months").alias("month_start_date"))
    )
    return grid.join(revenue, ["month_start_date", "channel"], "left").select(
        "month_start_date",
        "channel",
        F.coalesce("monthly_revenue", F.lit(0.0)).alias("monthly_revenue"),
    )


def rolling_baseline(panel: DataFrame, config: AnomalyConfig = ANOMALY) -> DataFrame:
    """Mean and population deviation of the ``window`` months before each month.

    Months without a full window are left out.
    """
    prior = (
        Window.partitionBy("channel")
        .orderBy("month_start_date")
        .rowsBetween(-config.window, -1)
    )
    x = F.col("monthly_revenue")
    return (
        panel.where(~_excluded(F.col("channel"), config))
        .select(
            *PANEL_COLUMNS,
            F.avg(x).over(prior).alias("rolling_mean"),
            F.stddev_pop(x).over(prior).alias("rolling_std"),
            F.count(x).over(prior).alias("_seen"),
        )
        .where(F.col("_seen") == config.window)
        .drop("_seen")
    )


def score(baseline: DataFrame, config: AnomalyConfig = ANOMALY) -> DataFrame:
    """z-score, deviation, flag, severity and direction."""
    x, mean, std, z = (
        F.col("monthly_revenue"), F.col("rolling_mean"), F.col("rolling_std"), F.col("z_score"),
    )
    flagged = F.coalesce(F.abs(z) >= config.threshold, F.lit(False))
    return (
        baseline.withColumns(
            {
                "expected_revenue": mean,
                "revenue_difference": x - mean,
                "z_score": F.when(std != 0, (x - mean) / std),
                "deviation_percent": F.when(mean != 0, (x - mean) / mean * 100),
            }
        )
        .withColumn("is_anomaly", flagged)
        .withColumns(
            {
                "severity": F.when(~F.col("is_anomaly"), "normal")
                .when(F.abs(z) <= config.severe_above, "moderate")
                .otherwise("severe"),
                "anomaly_direction": F.when(~F.col("is_anomaly"), "normal")
                .when(z > 0, "positive")
                .when(z < 0, "negative")
                .otherwise("normal"),
            }
        )
    )


def rank_anomalies(scored: DataFrame) -> DataFrame:
    """Rank flagged rows by |z|, largest first; ties by channel, then month.

    Ranks are global but no task sees all rows, however many share one |z|: see
    :func:`touchtrail.operators.ranking.global_rank`.
    """
    flagged = scored.where("is_anomaly").select(
        "channel", "month_start_date", F.abs("z_score").alias("_strength")
    )
    order = [F.col("_strength").desc(), F.col("channel").asc(), F.col("month_start_date").asc()]
    ranks = global_rank(flagged, order, "anomaly_rank", "anomaly-ranks").select(
        "channel", "month_start_date", F.col("anomaly_rank").cast("int")
    )
    return scored.join(ranks, ["channel", "month_start_date"], "left")


def explanation(config: AnomalyConfig = ANOMALY) -> Column:
    """One sentence per scored month; its wording is a fixed value."""
    months = config.window
    label = title_label(F.col("channel"))
    month = month_label(F.col("month_start_date"))
    actual, expected = money(F.col("monthly_revenue")), money(F.col("expected_revenue"))
    opening = F.concat(label, F.lit(" revenue in "), month, F.lit(" was "))
    ordinary = F.concat(
        opening,
        F.lit(f"close to the {months}-month baseline (actual "),
        actual, F.lit(" vs expected "), expected, F.lit(")."),
    )
    deviation = F.coalesce(
        F.concat(fixed(F.abs(F.col("deviation_percent")), 1), F.lit("%")), F.lit("n/a")
    )
    side = F.when(F.col("anomaly_direction") == "positive", "above").otherwise("below")
    unusual = F.concat(
        opening, deviation, F.lit(" "), side,
        F.lit(f" the {months}-month average (actual "), actual,
        F.lit(" vs expected "), expected,
        F.lit(", difference "), money(F.col("revenue_difference")),
        F.lit("). This is a "), F.col("severity"), F.lit(" "), F.col("anomaly_direction"),
        F.lit(" anomaly (z="), fixed(F.col("z_score"), 2),
        F.lit(", rank "), F.col("anomaly_rank").cast("string"), F.lit(")."),
    )
    return F.when(F.col("is_anomaly"), unusual).otherwise(ordinary)


def channel_anomalies(panel: DataFrame, config: AnomalyConfig = ANOMALY) -> DataFrame:
    """Scored, ranked and explained months of a panel (month_start_date, channel, revenue)."""
    ranked = rank_anomalies(score(rolling_baseline(panel, config), config))
    return ranked.select(
        "month_start_date",
        "channel",
        "monthly_revenue",
        "expected_revenue",
        "revenue_difference",
        "rolling_mean",
        "rolling_std",
        "z_score",
        "deviation_percent",
        "is_anomaly",
        "severity",
        "anomaly_direction",
        "anomaly_rank",
        explanation(config).alias("explanation"),
    )


def anomaly_summary(panel: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Channels and months analysed, rows scored, anomalies found: one row."""
    analysed = panel.agg(
        F.countDistinct("channel").alias("channels_analyzed"),
        F.countDistinct("month_start_date").alias("months_analyzed"),
    )
    found = anomalies.agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.coalesce(F.sum(F.col("is_anomaly").cast("bigint")), F.lit(0)).alias("anomalies_detected"),
    )
    return analysed.select(
        "channels_analyzed",
        "months_analyzed",
        found.select("rows_written").scalar().alias("rows_written"),
        found.select("anomalies_detected").scalar().alias("anomalies_detected"),
    )
