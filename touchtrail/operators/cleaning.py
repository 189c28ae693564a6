"""Staging: one narrow projection per raw table, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.functions.columns import (
    MONEY,
    blank_to_null,
    canonical_channel,
    clean_id,
    lower_label,
    month_start,
    safe_date,
    safe_month,
    slugify,
)


def stage_campaigns(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean_id("campaign_id").alias("campaign_id"),
        blank_to_null("campaign_name").alias("campaign_name"),
        slugify("campaign_name").alias("campaign_slug"),
        canonical_channel("channel").alias("channel"),
        F.col("budget_usd").cast(MONEY).alias("budget_usd"),
        safe_date("start_date").alias("start_date"),
        safe_date("end_date").alias("end_date"),
        clean_id("target_company_id").alias("target_company_id"),
    )


def stage_content(raw: DataFrame) -> DataFrame:
    dated = raw.withColumn("publish_date", safe_date("publish_date"))
    return dated.select(
        clean_id("content_id").alias("content_id"),
        canonical_channel("channel").alias("channel"),
        "publish_date",
        month_start("publish_date").alias("publish_month"),
        F.col("views").cast("bigint").alias("views"),
        F.col("clicks").cast("bigint").alias("clicks"),
        canonical_channel("utm_source").alias("utm_source"),
        slugify("utm_campaign").alias("utm_campaign"),
    )


def stage_revenue(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean_id("revenue_id").alias("revenue_id"),
        clean_id("company_id").alias("company_id"),
        clean_id("user_id").alias("user_id"),
        safe_month("month").alias("revenue_month"),
        F.col("revenue_amount").cast(MONEY).alias("revenue_amount"),
        F.col("is_recurring").cast("boolean").alias("is_recurring"),
    )


def stage_signups(raw: DataFrame) -> DataFrame:
    dated = raw.withColumn("signup_date", safe_date("signup_date"))
    return dated.select(
        clean_id("user_id").alias("user_id"),
        "signup_date",
        month_start("signup_date").alias("signup_month"),
        clean_id("company_id").alias("company_id"),
        # Referral labels keep their spelling: aliases apply to channels only.
        lower_label("referral_source").alias("referral_source"),
        canonical_channel("utm_source").alias("utm_source"),
        lower_label("utm_medium").alias("utm_medium"),
        slugify("utm_campaign").alias("utm_campaign"),
        canonical_channel("first_touch_channel").alias("first_touch_channel"),
        canonical_channel("last_touch_channel").alias("last_touch_channel"),
    )

