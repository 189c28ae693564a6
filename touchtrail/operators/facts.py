"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.config import SKEW, SkewConfig
from touchtrail.functions.columns import (
    compound_key,
    date_key,
    month_key,
    month_start,
    safe_ratio,
    zero_if_null,
)
from touchtrail.operators import intervals
from touchtrail.operators.skew import is_small, plain_join


def fct_attributed_revenue(attributed: DataFrame) -> DataFrame:
    return attributed.select(
        "revenue_id",
        "user_id",
        "company_id",
        date_key("revenue_month").alias("revenue_date_key"),
        date_key("signup_date").alias("signup_date_key"),
        month_key("signup_date").alias("cohort_key"),
        F.col("first_touch_resolved_channel").alias("first_touch_channel"),
        F.col("last_touch_resolved_channel").alias("last_touch_channel"),
        F.col("first_touch_campaign").alias("first_touch_campaign_id"),
        F.col("last_touch_campaign").alias("last_touch_campaign_id"),
        "first_touch_attribution_reason",
        "last_touch_attribution_reason",
        "revenue_amount",
        "is_recurring",
        "has_channel_conflict",
        "missing_utm_flag",
        "first_touch_campaign_match_status",
        "last_touch_campaign_match_status",
        "campaign_match_status",
        "attribution_confidence",
    )


def touch_totals(cells: DataFrame, first: str, last: str, key: str) -> DataFrame:
    """Revenue, distinct customers and records per key value, for both touch models.

    Each cell is read once and counted under its first and its last key. Customers
    are counted in two levels (key and user, then key), so a hot key is spread
    over its users and a NULL user is not a customer.
    """
    models = F.inline(
        F.array(
            F.struct(F.lit(True).alias("is_first"), F.col(first).alias(key)),
            F.struct(F.lit(False).alias("is_first"), F.col(last).alias(key)),
        )
    )
    per_user = (
        cells.select("user_id", "revenue_amount", "record_count", models)
        .where(F.col(key).isNotNull())
        .groupBy("is_first", key, "user_id")
        .agg(F.sum("revenue_amount").alias("revenue"), F.sum("record_count").alias("records"))
    )
    measures = []
    for prefix, chosen in (("first_touch", F.col("is_first")), ("last_touch", ~F.col("is_first"))):
        measures += [
            F.sum(F.when(chosen, F.col("revenue"))).alias(f"{prefix}_revenue"),
            F.count(F.when(chosen, F.col("user_id"))).alias(f"{prefix}_customers"),
            F.sum(F.when(chosen, F.col("records"))).alias(f"{prefix}_records"),
        ]
    return per_user.groupBy(key).agg(*measures)


def fct_campaign_roi(campaigns: DataFrame, cells: DataFrame) -> DataFrame:
    """Budget, attributed revenue, customers, ROAS and ROI of every campaign."""
    totals = touch_totals(
        cells, "first_touch_campaign_id", "last_touch_campaign_id", "campaign_id"
    )
    first, last = zero_if_null("first_touch_revenue"), zero_if_null("last_touch_revenue")
    budget = F.col("budget_usd")

    def roi(revenue: Column) -> Column:
        return safe_ratio(revenue - budget, budget, 4)

    return campaigns.join(totals, "campaign_id", "left").select(
        "campaign_id",
        "channel",
        "target_company_id",
        date_key("start_date").alias("start_date_key"),
        date_key("end_date").alias("end_date_key"),
        budget,
        first.alias("first_touch_attributed_revenue"),
        last.alias("last_touch_attributed_revenue"),
        zero_if_null("first_touch_customers").alias("first_touch_customers"),
        zero_if_null("last_touch_customers").alias("last_touch_customers"),
        safe_ratio(first, budget, 4).alias("first_touch_roas"),
        safe_ratio(last, budget, 4).alias("last_touch_roas"),
        roi(first).alias("first_touch_roi"),
        roi(last).alias("last_touch_roi"),
    )


def fct_content_performance(
    content: DataFrame, campaigns: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Content count, views, clicks and CTR per month, channel and matched campaign.

    With few campaigns each content row is matched where it is. With many, content
    is first summed per channel, slug and day, all the match needs: a join key (slug
    and channel) then has one row per day, so none can be hot in the shuffle join. Where
    many campaigns share slug and channel, these days meet campaigns through an index of days.
    """
    crowded = intervals.most_shared(campaigns, ["campaign_slug", "channel"]) >= config.crowded
    small = not crowded and is_small(campaigns, config)
    items = content.select(
        "channel", "utm_campaign", "publish_date", F.lit(1).cast("bigint").alias("items"),
        "views", "clicks",
    )
    found = campaigns.where(F.col("campaign_slug").isNotNull() & F.col("channel").isNotNull()).select(
        F.col("campaign_slug").alias("utm_campaign"),
        "channel",
        "campaign_id",
        F.col("start_date").alias("_from"),
        F.col("end_date").alias("_to"),
    )
    if small:
        found = F.broadcast(found)
    else:
        items = items.groupBy("channel", "utm_campaign", "publish_date").agg(
            F.sum("items").alias("items"),
            F.sum("views").alias("views"),
            F.sum("clicks").alias("clicks"),
        )
    keys = ["utm_campaign", "channel"]
    if crowded:
        # Items are one row per slug, channel and day: what finds no campaign is what is left.
        index = intervals.indexed(found, "_from", "_to")
        met = intervals.alive(items, index, keys, "publish_date", "_from", "_to")
        by_day = [*keys, "publish_date"]
        unmet = items.join(met.select(*by_day).distinct(), by_day, "left_anti")
        matched = met.drop("_from", "_to").unionByName(
            unmet.withColumn("campaign_id", F.lit(None).cast("string"))
        )
    else:
        matched = plain_join(
            items,
            found,
            keys,
            "left",
            lambda left, right: left["publish_date"].between(right["_from"], right["_to"]),
        )
    month = F.col("publish_month")
    grouped = (
        matched.withColumn("publish_month", month_start("publish_date"))
        .groupBy("publish_month", "channel", "campaign_id")
        .agg(
            F.sum("items").alias("content_count"),
            F.sum("views").alias("views"),
            F.sum("clicks").alias("clicks"),
        )
    )
    return grouped.select(
        compound_key(
            month, "channel", F.coalesce("campaign_id", F.lit("NO_CAMPAIGN"))
        ).alias("content_performance_key"),
        date_key(month).alias("publish_month_date_key"),
        "channel",
        "campaign_id",
        "content_count",
        "views",
        "clicks",
        safe_ratio("clicks", "views", 6).alias("click_through_rate"),
    )
