"""Revenue joined to journeys, at record grain and at pre-aggregated cell grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.config import SKEW, SkewConfig
from touchtrail.functions.columns import date_key, month_key
from touchtrail.operators.skew import lookup_join

# Journey columns carried to revenue, with their name in the result.
_CARRIED = {
    "signup_date": "signup_date",
    "first_touch_channel": "first_touch_channel",
    "last_touch_channel": "last_touch_channel",
    "first_touch_resolved_channel": "first_touch_resolved_channel",
    "last_touch_resolved_channel": "last_touch_resolved_channel",
    "first_touch_attribution_reason": "first_touch_attribution_reason",
    "last_touch_attribution_reason": "last_touch_attribution_reason",
    "first_touch_campaign_id": "first_touch_campaign",
    "last_touch_campaign_id": "last_touch_campaign",
    "has_channel_conflict": "has_channel_conflict",
    "missing_utm_flag": "missing_utm_flag",
    "first_touch_campaign_match_status": "first_touch_campaign_match_status",
    "last_touch_campaign_match_status": "last_touch_campaign_match_status",
    "campaign_match_status": "campaign_match_status",
    "attribution_confidence": "attribution_confidence",
}


def attributed_revenue(
    revenue: DataFrame, journeys: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Every revenue record with its user's journey; the record grain is kept.

    The one large-to-large join: unless journeys are few, hot users are split over salts.
    """
    carried = journeys.where(F.col("user_id").isNotNull()).select(
        "user_id",
        *[F.col(c).alias(name) for c, name in _CARRIED.items()],
        F.lit(True).alias("_has_journey"),
    )
    joined = lookup_join(revenue, carried, ["user_id"], ["revenue_id"], "left", config=config)
    return joined.select(
        "revenue_id",
        "user_id",
        "company_id",
        "revenue_amount",
        "revenue_month",
        "is_recurring",
        *_CARRIED.values(),
        F.col("_has_journey").isNull().alias("missing_journey_flag"),
    )


def attribution_cells(revenue: DataFrame, journeys: DataFrame) -> DataFrame:
    """Revenue summed to user x company x month x recurring, then joined to journeys.

    For summaries: a user's records collapse to at most months x companies x 2
    rows before the join, so no user key can be hot, and the result stays
    partitioned by user for the distinct-customer counts that follow. Columns are
    those of the revenue fact, with ``record_count`` records per row.
    """
    sums = revenue.groupBy("user_id", "company_id", "revenue_month", "is_recurring").agg(
        F.sum("revenue_amount").alias("revenue_amount"),
        F.count(F.lit(1)).alias("record_count"),
    )
    carried = journeys.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("_user"),
        F.col("signup_date"),
        F.col("first_touch_resolved_channel").alias("first_touch_channel"),
        F.col("last_touch_resolved_channel").alias("last_touch_channel"),
        "first_touch_campaign_id",
        "last_touch_campaign_id",
    )
    return sums.join(carried, sums["user_id"] == carried["_user"], "left").select(
        "user_id",
        "company_id",
        date_key("revenue_month").alias("revenue_date_key"),
        month_key("signup_date").alias("cohort_key"),
        "first_touch_channel",
        "last_touch_channel",
        "first_touch_campaign_id",
        "last_touch_campaign_id",
        "revenue_amount",
        "is_recurring",
        "record_count",
    )


def as_cells(fact: DataFrame) -> DataFrame:
    """A stored revenue fact in cell form: one record per row."""
    return fact.withColumn("record_count", F.lit(1).cast("bigint"))
