"""Conformed dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.config import (
    CALENDAR,
    CHANNEL_DESCRIPTORS,
    COMPANY_DESCRIPTORS,
    OTHER_CHANNEL_GROUP,
    SKEW,
    UNKNOWN,
    CalendarConfig,
    SkewConfig,
)
from touchtrail.functions.columns import date_key, lookup, month_key, month_start
from touchtrail.operators.skew import lookup_join


def channel_name(key: Column) -> Column:
    names = {k: name for k, (name, _) in CHANNEL_DESCRIPTORS.items()}
    return lookup(key, names, F.replace(key, F.lit("_"), F.lit(" ")))


def channel_group(key: Column) -> Column:
    groups = {k: group for k, (_, group) in CHANNEL_DESCRIPTORS.items()}
    return lookup(key, groups, F.lit(OTHER_CHANNEL_GROUP))


def company_name(key: Column) -> Column:
    return lookup(key, {k: name for k, (name, _) in COMPANY_DESCRIPTORS.items()})


def company_industry(key: Column) -> Column:
    return lookup(key, {k: industry for k, (_, industry) in COMPANY_DESCRIPTORS.items()})


def _distinct_union(frames: list[DataFrame]) -> DataFrame:
    # Duplicates are removed inside each task before the one small shuffle.
    return reduce(DataFrame.unionByName, frames).distinct()


def dim_channel(campaigns: DataFrame, content: DataFrame, touches: DataFrame) -> DataFrame:
    """Every channel observed in campaigns, content or resolved touches, plus unknown."""
    both_touches = touches.select(
        F.explode(
            F.array("first_touch_resolved_channel", "last_touch_resolved_channel", F.lit(UNKNOWN))
        ).alias("channel_key")
    )
    always = campaigns.sparkSession.range(1).select(F.lit(UNKNOWN).alias("channel_key"))
    key = F.col("channel_key")
    observed = _distinct_union(
        [
            campaigns.select(F.col("channel").alias("channel_key")),
            content.select(F.col("channel").alias("channel_key")),
            both_touches,
            always,
        ]
    )
    return observed.where(key.isNotNull()).select(
        key, channel_name(key).alias("channel_name"), channel_group(key).alias("channel_group")
    )


def dim_company(campaigns: DataFrame, revenue: DataFrame, signups: DataFrame) -> DataFrame:
    """Companies of signups and revenue (a NULL stays a member) and campaign targets."""
    targets = campaigns.where(F.col("target_company_id").isNotNull())
    key = F.col("company_id")
    observed = _distinct_union(
        [
            signups.select("company_id"),
            revenue.select("company_id"),
            targets.select(F.col("target_company_id").alias("company_id")),
        ]
    )
    return observed.select(
        key, company_name(key).alias("company_name"), company_industry(key).alias("industry")
    )


# Source and the dates it brings to the calendar.
DATED = {
    "content": ("publish_date",),
    "signups": ("signup_date",),
    "revenue": ("revenue_month",),
    "campaigns": ("start_date", "end_date"),
}


def month_histogram(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(source, column, month, first_day, last_day, rows) of all dates, one pass per source.

    Counted before the shuffle; the result has a row per source, column and month.
    """
    parts = []
    for source, df in sources.items():
        columns = DATED[source]
        listed = ", ".join(f"'{c}', CAST({c} AS date)" for c in columns)
        dates = df.selectExpr(f"stack({len(columns)}, {listed}) AS (column, day)").where("day IS NOT NULL")
        parts.append(
            dates.groupBy(F.lit(source).alias("source"), "column", month_start("day").alias("month")).agg(
                F.min("day").alias("first_day"), F.max("day").alias("last_day"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _inside(config: CalendarConfig) -> Column:
    """Months wholly before or after the horizon are outside."""
    first, last = (F.lit(d).cast("date") for d in (config.first_day, config.last_day))
    return (F.col("last_day") >= first) & (F.col("first_day") <= last)


def date_bounds(
    campaigns: DataFrame, content: DataFrame, revenue: DataFrame, signups: DataFrame,
    config: CalendarConfig = CALENDAR,
) -> DataFrame:
    """One row: first and last date of any source, within the calendar's horizon."""
    sources = {"content": content, "signups": signups, "revenue": revenue, "campaigns": campaigns}
    first, last = (F.lit(d).cast("date") for d in (config.first_day, config.last_day))
    return month_histogram(sources).where(_inside(config)).agg(
        F.min(F.greatest("first_day", first)).alias("first_day"),
        F.max(F.least("last_day", last)).alias("last_day"),
    )


def dates_beyond_horizon(
    campaigns: DataFrame, content: DataFrame, revenue: DataFrame, signups: DataFrame,
    config: CalendarConfig = CALENDAR,
) -> DataFrame:
    """(source, column, month, rows) of dates that the calendar leaves out."""
    sources = {"content": content, "signups": signups, "revenue": revenue, "campaigns": campaigns}
    found = month_histogram(sources).where(~_inside(config))
    return found.select("source", "column", "month", "rows")


def dim_time(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds, both included.

    Months are listed first and dealt out; each becomes its days where it is.
    """
    d = F.col("date_day")
    iso_day = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    months = (
        bounds.where(F.col("first_day").isNotNull())
        .select(
            "first_day",
            "last_day",
            F.explode(
                F.sequence(month_start("first_day"), month_start("last_day"), F.expr("interval 1 month"))
            ).alias("_month"),
        )
        .repartition("_month")
    )
    low, high = F.greatest("_month", "first_day"), F.least(F.last_day("_month"), F.col("last_day"))
    days = months.select(F.explode(F.sequence(low, high, F.expr("interval 1 day"))).alias("date_day"))
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.trunc(d, "week").alias("week_start_date"),
        month_start(d).alias("month_start_date"),
        month_key(d).alias("month_key"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        iso_day.alias("iso_day_of_week"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def with_calendar(
    df: DataFrame,
    dates: DataFrame,
    key: str,
    spread_by: str,
    config: SkewConfig = SKEW,
    keys_from: DataFrame | None = None,
    **columns: str,
) -> DataFrame:
    """Inner join on a date key; ``columns`` name the calendar columns to add.

    A few dates may hold all rows, so the calendar is broadcast while it is small
    (200,000 days are five centuries) and hot dates are split otherwise.
    """
    added = [F.col(source).alias(name) for name, source in columns.items()]
    days = dates.select(F.col("date_key").alias(key), *added)
    return lookup_join(
        df, days, [key], [spread_by], "inner", config=config, keys_from=keys_from
    )


def dim_user_cohort(signups: DataFrame) -> DataFrame:
    m = F.col("cohort_month")
    months = signups.select(F.col("signup_month").alias("cohort_month")).where(m.isNotNull())
    return months.distinct().select(
        month_key(m).alias("cohort_key"),
        m,
        F.date_format(m, "yyyy-MM").alias("cohort_label"),
        F.month(m).alias("cohort_month_number"),
        F.quarter(m).alias("cohort_quarter"),
        F.year(m).alias("cohort_year"),
    )
