"""Parameterised reads over the stored tables.

An empty selection means "all". Filters are plain predicates on scan columns, so
they reach the Parquet scan. Sorting is left to the caller's sink (``ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.config import SKEW, UNKNOWN, SkewConfig
from touchtrail.functions.columns import ratio, zero_if_null
from touchtrail.functions.text import money, percent
from touchtrail.operators.dimensions import with_calendar
from touchtrail.operators.facts import touch_totals
from touchtrail.operators.skew import lookup_join

Selection = Sequence[str] | None

TOUCH_LABELS = {"first_touch_revenue": "First Touch", "last_touch_revenue": "Last Touch"}

CAMPAIGN_MEASURES = (
    "last_touch_roi",
    "first_touch_roi",
    "last_touch_attributed_revenue",
    "first_touch_attributed_revenue",
    "budget_usd",
)
TOP_CAMPAIGNS = 15


def selected(df: DataFrame, column: str, values: Selection) -> DataFrame:
    """Rows whose column is in the selection; everything when nothing is selected."""
    return df.where(F.col(column).isin(list(values))) if values else df


def touched_by(df: DataFrame, channel_keys: Selection) -> DataFrame:
    """Rows whose first or last channel is selected."""
    if not channel_keys:
        return df
    keys = list(channel_keys)
    return df.where(
        F.col("first_touch_channel").isin(keys) | F.col("last_touch_channel").isin(keys)
    )


def filter_options(companies: DataFrame, channels: DataFrame) -> DataFrame:
    """Selectable companies and channels: (kind, key, name)."""
    return companies.select(
        F.lit("company").alias("kind"), F.col("company_id").alias("key"),
        F.col("company_name").alias("name"),
    ).unionByName(
        channels.select(
            F.lit("channel").alias("kind"), F.col("channel_key").alias("key"),
            F.col("channel_name").alias("name"),
        )
    )


def revenue_detail(
    fact: DataFrame, companies: DataFrame, dates: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Revenue records with company name and month; unknown companies or dates drop out."""
    names = companies.where(F.col("company_id").isNotNull()).select("company_id", "company_name")
    named = lookup_join(fact, names, ["company_id"], ["revenue_id"], "inner", config=config)
    dated = with_calendar(
        named, dates, "revenue_date_key", "revenue_id", config, fact, revenue_month="date_day"
    )
    return dated.select(
        "revenue_id",
        "user_id",
        "company_id",
        "company_name",
        "revenue_month",
        "first_touch_channel",
        "last_touch_channel",
        "revenue_amount",
    )


def channel_performance(
    summary: DataFrame, detail: DataFrame, company_ids: Selection = None,
    channel_keys: Selection = None,
) -> DataFrame:
    """Channel summary, re-aggregated from the detail when companies are selected.

    Content and budget columns are not company-specific and stay unfiltered; the
    record and content counts are left out of the filtered form.
    """
    if not company_ids:
        return selected(summary, "channel_key", channel_keys)
    cells = selected(detail, "company_id", company_ids).withColumn(
        "record_count", F.lit(1).cast("bigint")
    )
    totals = touch_totals(cells, "first_touch_channel", "last_touch_channel", "channel_key")
    return with_channel_totals(summary, totals, channel_keys)


def with_channel_totals(
    summary: DataFrame, totals: DataFrame, channel_keys: Selection
) -> DataFrame:
    """The summary's channels with the totals of a selection, 0 where it has none."""
    measures = [f"{t}_{m}" for m in ("revenue", "customers") for t in ("first_touch", "last_touch")]
    base = summary.select(
        "channel_key", "channel_name", "channel_group", "campaign_budget_usd",
        "click_through_rate", "views", "clicks", "campaign_count",
    )
    joined = base.join(totals, "channel_key", "left").select(
        *base.columns, *[zero_if_null(c).alias(c) for c in measures]
    )
    return selected(joined, "channel_key", channel_keys)


def campaign_performance(
    campaigns: DataFrame, company_ids: Selection = None, channel_keys: Selection = None
) -> DataFrame:
    """Campaigns open to all companies or aimed at a selected one."""
    if company_ids:
        target = F.col("target_company_id")
        campaigns = campaigns.where(target.isNull() | target.isin(list(company_ids)))
    return selected(campaigns, "channel_key", channel_keys)


def company_analysis(companies: DataFrame, company_ids: Selection = None) -> DataFrame:
    return selected(companies, "company_id", company_ids)


def monthly_revenue(
    monthly: DataFrame, detail: DataFrame, company_ids: Selection = None,
    channel_keys: Selection = None,
) -> DataFrame:
    """Monthly revenue and customers; new customers only without a selection."""
    if not company_ids and not channel_keys:
        return monthly.select(
            F.col("month_start_date").alias("month"), "total_revenue", "active_customers",
            "new_customers",
        )
    rows = touched_by(selected(detail, "company_id", company_ids), channel_keys)
    per_user = rows.groupBy("revenue_month", "user_id").agg(
        F.sum("revenue_amount").alias("revenue")
    )
    return per_user.groupBy(F.col("revenue_month").alias("month")).agg(
        F.sum("revenue").alias("total_revenue"), F.count("user_id").alias("active_customers")
    )


def kpi_overview(
    detail: DataFrame, campaigns: DataFrame, channels: DataFrame, forecast: DataFrame,
    company_ids: Selection = None, channel_keys: Selection = None,
) -> DataFrame:
    """One row: revenue, customers, campaigns, channels, forecast months.

    The channel count does not depend on the company selection: every channel row
    stays, with zero revenue if need be.
    """
    rows = touched_by(selected(detail, "company_id", company_ids), channel_keys)

    def size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    revenue = rows.agg(
        F.coalesce(F.sum("revenue_amount"), F.lit(0)).cast("double").alias("total_revenue"),
        F.countDistinct("user_id").alias("total_customers"),
    )
    return revenue.select(
        "total_revenue",
        "total_customers",
        size(campaign_performance(campaigns, company_ids, channel_keys)).alias("campaign_count"),
        size(selected(channels, "channel_key", channel_keys)).alias("channel_count"),
        size(forecast).alias("forecast_horizon"),
    )


def attribution_comparison(channels: DataFrame) -> DataFrame:
    """Last-touch minus first-touch revenue per channel, absolute and relative."""
    first, last = F.col("first_touch_revenue"), F.col("last_touch_revenue")
    return channels.select(
        "channel_key", "channel_name", first, last,
        (last - first).alias("difference"),
        ratio(last - first, first).alias("pct_difference"),
    )


def attribution_long(channels: DataFrame) -> DataFrame:
    """One row per channel and attribution model."""
    models = list(TOUCH_LABELS)
    long = channels.unpivot(["channel_name"], models, "attribution_model", "revenue")
    label = F.when(F.col("attribution_model") == models[0], TOUCH_LABELS[models[0]]).otherwise(
        TOUCH_LABELS[models[1]]
    )
    return long.withColumn("attribution_model", label)


def top_campaigns(
    campaigns: DataFrame, measure: str = "last_touch_roi", n: int = TOP_CAMPAIGNS
) -> DataFrame:
    """The n largest campaigns by one measure; ties by campaign id."""
    if measure not in CAMPAIGN_MEASURES:
        raise ValueError(f"Unknown measure {measure!r}; choose one of {CAMPAIGN_MEASURES}")
    return campaigns.orderBy(F.col(measure).desc_nulls_last(), "campaign_id").limit(n)


def top_by_every_measure(campaigns: DataFrame, n: int = TOP_CAMPAIGNS) -> DataFrame:
    """(measure, position, campaign_id, value): the n largest campaigns by each measure.

    Each list is cut by its own top-n before it is numbered, so the window sorts n rows.
    """
    lists = []
    for measure in CAMPAIGN_MEASURES:
        largest = top_campaigns(campaigns.where(F.col("campaign_id").isNotNull()), measure, n)
        place = Window.partitionBy("measure").orderBy(F.col("value").desc_nulls_last(), "campaign_id")
        lists.append(
            largest.select(
                F.lit(measure).alias("measure"),
                "campaign_id",
                F.col(measure).cast("double").alias("value"),
            ).select("measure", F.row_number().over(place).alias("position"), "campaign_id", "value")
        )
    return reduce(DataFrame.unionByName, lists)


def rank_order_violations(anomalies: DataFrame) -> DataFrame:
    """Pairs of neighbouring ranks whose magnitudes are in the wrong order, and ranks that
    are missing or repeated.

    A rank is compared with its successor by an equality join, so no task sorts them all.
    """
    ranked = anomalies.where("is_anomaly").select(
        F.col("anomaly_rank").alias("rank"), F.abs("z_score").alias("strength")
    )
    following = ranked.select((F.col("rank") - 1).alias("rank"), F.col("strength").alias("next"))
    joined = ranked.join(following, "rank", "left")
    last = ranked.agg(F.max("rank")).scalar()
    repeated = F.count(F.lit(1)) > 1
    return (
        joined.groupBy("rank")
        .agg(
            F.max("strength").alias("strength"),
            F.max("next").alias("next_strength"),
            repeated.alias("repeated"),
        )
        .where(
            F.col("repeated")
            | (F.col("next_strength") > F.col("strength"))
            | (F.col("next_strength").isNull() & (F.col("rank") < last))
        )
    )


def forecast_overlap(history: DataFrame, forecast: DataFrame, month: str = "month") -> DataFrame:
    """How many forecast months are also observed months: one row."""
    both = forecast.select(month).join(history.select(month).distinct(), month, "left_semi")
    return forecast.agg(
        F.count(F.lit(1)).alias("forecast_months"),
        F.min(month).alias("first_forecast_month"),
    ).select(
        "forecast_months",
        "first_forecast_month",
        history.agg(F.max(month)).scalar().alias("last_observed_month"),
        both.agg(F.count(F.lit(1))).scalar().alias("overlapping_months"),
    )


def with_position(df: DataFrame, *order: Column) -> DataFrame:
    """The place of each row in a presentation order; for results of presentation size."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def with_defined_ctr(channels: DataFrame) -> DataFrame:
    return channels.where(F.col("click_through_rate").isNotNull())


def history_plus_forecast(monthly: DataFrame, forecast: DataFrame) -> DataFrame:
    """(month, revenue, series) of the observed and the predicted months."""
    past = monthly.select(
        "month", F.col("total_revenue").cast("double").alias("revenue"),
        F.lit("Historical").alias("series"),
    )
    future = forecast.select(
        "month", F.col("predicted_revenue").alias("revenue"), F.lit("Forecast").alias("series")
    )
    return past.unionByName(future)


# -- anomalies -------------------------------------------------------------------


def named_anomalies(anomalies: DataFrame, channels: DataFrame) -> DataFrame:
    """Anomaly rows with the channel's name, or its key when the channel is not known."""
    names = channels.select(F.col("channel_key").alias("channel"), F.col("channel_name").alias("_n"))
    return (
        anomalies.where(F.lower("channel") != UNKNOWN)
        .join(names, "channel", "left")
        .withColumn("channel_name", F.coalesce("_n", "channel"))
        .drop("_n")
    )


def anomaly_list(
    named: DataFrame, channel_keys: Selection = None, channel_names: Selection = None,
    show_all: bool = False,
) -> DataFrame:
    """Flagged rows (or all scored rows) of the selected channels."""
    rows = selected(selected(named, "channel", channel_keys), "channel_name", channel_names)
    return rows if show_all else rows.where("is_anomaly")


def strongest_first(anomalies: DataFrame) -> DataFrame:
    """Presentation order: |z|, rank, month, channel; missing values last."""
    return anomalies.orderBy(
        F.abs("z_score").desc_nulls_last(),
        F.col("anomaly_rank").asc_nulls_last(),
        "month_start_date",
        "channel",
    )


def anomaly_trend(named: DataFrame) -> DataFrame:
    """All scored months of the channels with at least one anomaly."""
    flagged = named.where("is_anomaly").select("channel_name")
    return named.join(flagged, "channel_name", "left_semi")


def anomaly_kpis(named: DataFrame) -> DataFrame:
    return named.agg(
        F.countDistinct("channel").alias("channels"),
        F.countDistinct("month_start_date").alias("scored_months"),
        F.count_if("is_anomaly").alias("anomalies"),
    )


# -- presentation ------------------------------------------------------------------


def ordered(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last())


def formatted(
    df: DataFrame, money_columns: Sequence[str] = (), percent_columns: Sequence[str] = ()
) -> DataFrame:
    """Money and fraction columns as display text; a missing value is a dash."""
    dash = F.lit("—")
    changes = {c: F.coalesce(money(F.col(c).cast("double")), dash) for c in money_columns}
    changes |= {c: F.coalesce(percent(F.col(c).cast("double")), dash) for c in percent_columns}
    return df.withColumns(changes)
