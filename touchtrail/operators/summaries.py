"""Business summaries by channel, campaign, company and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.config import SKEW, SkewConfig
from touchtrail.functions.columns import safe_ratio, zero_if_null
from touchtrail.operators.dimensions import with_calendar
from touchtrail.operators.facts import touch_totals
from touchtrail.operators.skew import lookup_join


def channel_performance(
    channels: DataFrame, cells: DataFrame, content: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """One row per channel: both touch models, content engagement, campaign budget.

    ``campaigns`` is any table with one row per campaign, its channel and budget.
    """
    touches = touch_totals(cells, "first_touch_channel", "last_touch_channel", "channel_key")
    content_totals = content.groupBy(F.col("channel").alias("channel_key")).agg(
        F.sum("content_count").alias("content_count"),
        F.sum("views").alias("views"),
        F.sum("clicks").alias("clicks"),
    )
    campaign_totals = campaigns.groupBy(F.col("channel").alias("channel_key")).agg(
        F.count(F.lit(1)).alias("campaign_count"),
        F.sum("budget_usd").alias("campaign_budget_usd"),
    )
    joined = channels
    for totals in (touches, content_totals, campaign_totals):
        joined = joined.join(totals, "channel_key", "left")
    views, clicks = zero_if_null("views"), zero_if_null("clicks")
    return joined.select(
        "channel_key",
        "channel_name",
        "channel_group",
        zero_if_null("first_touch_revenue").alias("first_touch_revenue"),
        zero_if_null("last_touch_revenue").alias("last_touch_revenue"),
        zero_if_null("first_touch_customers").alias("first_touch_customers"),
        zero_if_null("last_touch_customers").alias("last_touch_customers"),
        zero_if_null("first_touch_records").alias("first_touch_revenue_records"),
        zero_if_null("last_touch_records").alias("last_touch_revenue_records"),
        zero_if_null("content_count").alias("content_count"),
        views.alias("views"),
        clicks.alias("clicks"),
        safe_ratio(clicks, views, 6).alias("click_through_rate"),
        zero_if_null("campaign_count").alias("campaign_count"),
        zero_if_null("campaign_budget_usd").alias("campaign_budget_usd"),
    )


def campaign_performance(
    roi: DataFrame,
    channels: DataFrame,
    companies: DataFrame,
    dates: DataFrame,
    config: SkewConfig = SKEW,
) -> DataFrame:
    """Campaign ROI with names and dates; campaigns without a known channel or date drop out."""
    names = channels.select(F.col("channel_key").alias("channel"), "channel_name")
    targets = companies.select(
        F.col("company_id").alias("target_company_id"),
        F.col("company_name").alias("target_company_name"),
    )
    # Every lookup key is a column of ``roi``, so hot keys are counted there.
    named = lookup_join(roi, names, ["channel"], ["campaign_id"], "inner", config=config)
    named = lookup_join(
        named, targets, ["target_company_id"], ["campaign_id"], config=config, keys_from=roi
    )
    for role in ("start", "end"):
        named = with_calendar(
            named, dates, f"{role}_date_key", "campaign_id", config, roi,
            **{f"{role}_date": "date_day"},
        )
    return named.select(
        "campaign_id",
        F.col("channel").alias("channel_key"),
        "channel_name",
        "target_company_id",
        "target_company_name",
        "start_date",
        "end_date",
        "budget_usd",
        "first_touch_attributed_revenue",
        "last_touch_attributed_revenue",
        "first_touch_customers",
        "last_touch_customers",
        "first_touch_roas",
        "last_touch_roas",
        "first_touch_roi",
        "last_touch_roi",
        safe_ratio("budget_usd", "first_touch_customers", 2).alias("first_touch_cost_per_customer"),
        safe_ratio("budget_usd", "last_touch_customers", 2).alias("last_touch_cost_per_customer"),
        (F.col("last_touch_attributed_revenue") - F.col("first_touch_attributed_revenue")).alias(
            "attribution_revenue_difference"
        ),
    )


def company_metrics(cells: DataFrame) -> DataFrame:
    """Revenue composition, customers and channel breadth per company.

    Customers are counted in two levels (company and user, then company), so a hot
    company is spread over its users. Channel breadth is a second scan of three
    columns that shrinks to channel pairs inside each task; it costs less than
    repeating every row once per distinct count.
    """
    amount = F.col("revenue_amount")

    def part(condition: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(0))

    sums = {
        "total_revenue": F.sum(amount),
        "recurring_revenue": part(F.col("is_recurring")),
        "initial_revenue": part(~F.col("is_recurring")),
        "revenue_record_count": F.sum("record_count"),
        "first_touch_campaign_revenue": part(F.col("first_touch_campaign_id").isNotNull()),
        "last_touch_campaign_revenue": part(F.col("last_touch_campaign_id").isNotNull()),
    }
    per_user = cells.groupBy("company_id", "user_id").agg(
        *[total.alias(name) for name, total in sums.items()]
    )
    measures = (
        per_user.where(F.col("company_id").isNotNull())
        .groupBy("company_id")
        .agg(*[F.sum(name).alias(name) for name in sums], F.count("user_id").alias("customer_count"))
    )
    pairs = cells.select("company_id", "first_touch_channel", "last_touch_channel").distinct()
    breadth = pairs.groupBy("company_id").agg(
        F.countDistinct("first_touch_channel").alias("first_touch_channel_count"),
        F.countDistinct("last_touch_channel").alias("last_touch_channel_count"),
    )
    return measures.join(breadth, "company_id", "left")


def company_revenue_analysis(companies: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per company with its share of all revenue.

    ``metrics`` is read twice (rows and grand total): pass a stored table.
    """
    known = companies.select("company_id")
    grand_total = (
        metrics.join(known, "company_id", "left_semi").agg(F.sum("total_revenue")).scalar()
    )
    total, customers = zero_if_null("total_revenue"), zero_if_null("customer_count")
    plain = (
        "recurring_revenue",
        "initial_revenue",
        "revenue_record_count",
        "customer_count",
        "first_touch_channel_count",
        "last_touch_channel_count",
        "first_touch_campaign_revenue",
        "last_touch_campaign_revenue",
    )
    return companies.join(metrics, "company_id", "left").select(
        "company_id",
        "company_name",
        "industry",
        total.alias("total_revenue"),
        *[zero_if_null(c).alias(c) for c in plain],
        safe_ratio(total, customers, 2).alias("average_revenue_per_customer"),
        safe_ratio(total, grand_total, 6).alias("portfolio_revenue_share"),
    )


def monthly_metrics(
    cells: DataFrame, dates: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Revenue composition, active and new customers per calendar month.

    Counted per month and user first: a user is new in the month of their cohort.
    """
    amount = F.col("revenue_amount")
    dated = with_calendar(
        cells, dates, "revenue_date_key", "user_id", config,
        month_key="month_key", month_start_date="month_start_date",
    )
    per_user = (
        dated.groupBy("month_key", "month_start_date", "user_id")
        .agg(
            F.min("revenue_date_key").alias("month_date_key"),
            F.sum(amount).alias("total_revenue"),
            F.sum(F.when(F.col("is_recurring"), amount).otherwise(0)).alias("recurring_revenue"),
            F.sum(F.when(~F.col("is_recurring"), amount).otherwise(0)).alias("initial_revenue"),
            F.sum("record_count").alias("revenue_record_count"),
            F.max(F.col("cohort_key") == F.col("month_key")).alias("_is_new"),
        )
    )
    return per_user.groupBy("month_key", "month_start_date").agg(
        F.min("month_date_key").alias("month_date_key"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("recurring_revenue").alias("recurring_revenue"),
        F.sum("initial_revenue").alias("initial_revenue"),
        F.sum("revenue_record_count").alias("revenue_record_count"),
        F.count("user_id").alias("active_customers"),
        F.count(F.when(F.col("_is_new"), F.col("user_id"))).alias("new_customers"),
    )


def monthly_revenue_customer_growth(
    cells: DataFrame, dates: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Monthly metrics with change against the previous observed month.

    The window has no partition: its input is one row per calendar month.
    """
    order = Window.orderBy("month_key")
    total, active = F.col("total_revenue"), F.col("active_customers")
    prior_total, prior_active = F.col("_prior_total"), F.col("_prior_active")
    with_prior = monthly_metrics(cells, dates, config).select(
        "*",
        F.lag("total_revenue").over(order).alias("_prior_total"),
        F.lag("active_customers").over(order).alias("_prior_active"),
    )
    return with_prior.select(
        "month_key",
        "month_date_key",
        "month_start_date",
        "total_revenue",
        "recurring_revenue",
        "initial_revenue",
        "revenue_record_count",
        "active_customers",
        "new_customers",
        (total - prior_total).alias("revenue_change"),
        safe_ratio(total - prior_total, prior_total, 6).alias("revenue_growth_rate"),
        (active - prior_active).alias("customer_change"),
        safe_ratio(active - prior_active, prior_active, 6).alias("customer_growth_rate"),
    )
