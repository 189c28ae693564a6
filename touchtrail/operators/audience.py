"""Distinct customers of any selection, from exact mergeable sets.

Users get whole numbers, and every cell (month, first channel, last channel, company) keeps
the set of its users as bitmaps, one per range of 32,768 numbers, next to its revenue. A
selection then unites the bitmaps of its cells, range by range, and counts bits: reads scan
the cell table alone, whatever the number of revenue records behind it. Sets are exact, and
cells of two periods or two loads merge by the same union.

Users are numbered in the order of their own cell, so a cell's users stand next to each
other and its bitmaps are few and dense; any other numbering gives the same results. No
bitmap is larger than 4 KB, so a cell with a third of all users is many rows, not a large one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.operators.drilldown import (
    Selection,
    campaign_performance,
    selected,
    touched_by,
    with_channel_totals,
)

CELL = ("revenue_month", "first_touch_channel", "last_touch_channel", "company_id")


# -- building ------------------------------------------------------------------------


def number_users(detail: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, user_number) of every user of the detail; numbers never change.

    Users that ``known`` has keep their numbers and new ones follow. The result must be
    stored before it is used, since numbers come from where a row stands.
    """
    home = detail.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min(F.struct("company_id", "first_touch_channel", "last_touch_channel")).alias("home")
    )
    if known is not None:
        home = home.join(known.select("user_id"), "user_id", "left_anti")
    # Consecutive within a task; each task starts a range of its own, as 2 ** 33 is a
    # multiple of a bitmap's size.
    placed = (
        home.repartitionByRange("home", "user_id")
        .sortWithinPartitions("home", "user_id")
        .select("user_id", F.monotonically_increasing_id().alias("user_number"))
    )
    if known is None:
        return placed
    top = known.agg(F.coalesce(F.max("user_number"), F.lit(-1))).scalar()
    first_free = (F.shiftright(top, 33) + 1) * F.lit(1 << 33)
    return known.select("user_id", "user_number").unionByName(
        placed.withColumn("user_number", F.col("user_number") + first_free)
    )


def audience_cells(detail: DataFrame, numbers: DataFrame) -> DataFrame:
    """(month, first, last, company, user_range, customers, revenue, records).

    Records are summed per user and cell before the join with the numbers, so no user is
    hot. Records without a user count as revenue and are nobody's: their range is NULL.
    """
    per_user = detail.groupBy("user_id", *CELL).agg(
        F.sum("revenue_amount").alias("revenue"), F.count(F.lit(1)).alias("records")
    )
    number = F.col("user_number")
    return (
        per_user.join(numbers, "user_id", "left")
        .groupBy(*CELL, F.bitmap_bucket_number(number).alias("user_range"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("customers"),
            F.sum("revenue").alias("revenue"),
            F.sum("records").alias("records"),
        )
    )


def merged_cells(*parts: DataFrame) -> DataFrame:
    """Cells of several loads as one table; the loads must share their user numbers."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*CELL, "user_range").agg(*_united())


def _united() -> tuple[Column, ...]:
    return (
        F.bitmap_or_agg("customers").alias("customers"),
        F.sum("revenue").alias("revenue"),
        F.sum("records").alias("records"),
    )


# -- reading -------------------------------------------------------------------------


def totals(cells: DataFrame, *keys: str) -> DataFrame:
    """Revenue, customers and records per key values, one row if there are no keys.

    Bitmaps are united per range, before and after the shuffle, so a key with most of the
    users is spread over their ranges.
    """
    ranges = cells.groupBy(*keys, "user_range").agg(*_united())
    return ranges.groupBy(*keys).agg(
        F.sum("revenue").alias("revenue"),
        F.coalesce(F.sum(F.bitmap_count("customers")), F.lit(0)).alias("customers"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
    )


def chosen(cells: DataFrame, company_ids: Selection, channel_keys: Selection) -> DataFrame:
    return touched_by(selected(cells, "company_id", company_ids), channel_keys)


def channel_performance(
    summary: DataFrame, cells: DataFrame, company_ids: Selection = None,
    channel_keys: Selection = None,
) -> DataFrame:
    """As the drill-down of the same name, reading cells in place of revenue records."""
    if not company_ids:
        return selected(summary, "channel_key", channel_keys)
    touches = F.inline(
        F.array(
            F.struct(F.lit(True).alias("is_first"), F.col("first_touch_channel").alias("channel_key")),
            F.struct(F.lit(False).alias("is_first"), F.col("last_touch_channel").alias("channel_key")),
        )
    )
    touched = (
        selected(cells, "company_id", company_ids)
        .select("user_range", "customers", "revenue", "records", touches)
        .where(F.col("channel_key").isNotNull())
    )
    per_touch = totals(touched, "is_first", "channel_key")
    measures = []
    for prefix, rows in (("first_touch", F.col("is_first")), ("last_touch", ~F.col("is_first"))):
        for measure in ("revenue", "customers"):
            measures.append(F.sum(F.when(rows, F.col(measure))).alias(f"{prefix}_{measure}"))
    return with_channel_totals(summary, per_touch.groupBy("channel_key").agg(*measures), channel_keys)


def monthly_revenue(
    monthly: DataFrame, cells: DataFrame, company_ids: Selection = None,
    channel_keys: Selection = None,
) -> DataFrame:
    """Monthly revenue and customers; new customers only without a selection."""
    if not company_ids and not channel_keys:
        return monthly.select(
            F.col("month_start_date").alias("month"), "total_revenue", "active_customers",
            "new_customers",
        )
    per_month = totals(chosen(cells, company_ids, channel_keys), "revenue_month")
    return per_month.select(
        F.col("revenue_month").alias("month"),
        F.col("revenue").alias("total_revenue"),
        F.col("customers").alias("active_customers"),
    )


def kpi_overview(
    cells: DataFrame, campaigns: DataFrame, channels: DataFrame, horizon: int,
    company_ids: Selection = None, channel_keys: Selection = None,
) -> DataFrame:
    """One row: revenue, customers, campaigns, channels, forecast months."""

    def size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    return totals(chosen(cells, company_ids, channel_keys)).select(
        F.coalesce("revenue", F.lit(0)).cast("double").alias("total_revenue"),
        F.col("customers").alias("total_customers"),
        size(campaign_performance(campaigns, company_ids, channel_keys)).alias("campaign_count"),
        size(selected(channels, "channel_key", channel_keys)).alias("channel_count"),
        F.lit(horizon).cast("bigint").alias("forecast_horizon"),
    )


def every_selection(
    cells: DataFrame, selections: list[tuple[Selection, Selection]]
) -> DataFrame:
    """Revenue, customers and records of each (companies, channels) selection, in one scan.

    A cell goes to every selection that takes it; a selection without any cell has a row
    of zeros. Selections are numbered from 0.
    """

    def takes(companies: Selection, channels: Selection) -> Column:
        keep = F.lit(True)
        if companies:
            keep = keep & F.col("company_id").isin(list(companies))
        if channels:
            first, last = F.col("first_touch_channel"), F.col("last_touch_channel")
            keep = keep & (first.isin(list(channels)) | last.isin(list(channels)))
        return F.coalesce(keep, F.lit(False))

    numbers = F.array_compact(
        F.array(*(F.when(takes(*s), F.lit(i)) for i, s in enumerate(selections)))
    )
    found = totals(
        cells.select("user_range", "customers", "revenue", "records", F.explode(numbers).alias("selection")),
        "selection",
    )
    every = cells.sparkSession.range(len(selections)).select(F.col("id").cast("int").alias("selection"))
    zero = F.lit(0)
    return every.join(found, "selection", "left").select(
        "selection",
        F.coalesce("revenue", zero).alias("revenue"),
        F.coalesce("customers", zero).alias("customers"),
        F.coalesce("records", zero).alias("records"),
    )


def new_customers(cells: DataFrame) -> DataFrame:
    """(month, customers, new_customers): customers seen in no earlier month.

    Per range of users, the months' bitmaps are united in order; what a month adds to the
    bits so far is new. The window runs over the months of one range.
    """
    monthly = cells.where("user_range IS NOT NULL").groupBy("revenue_month", "user_range").agg(
        F.bitmap_or_agg("customers").alias("customers")
    )
    until = Window.partitionBy("user_range").orderBy("revenue_month")
    seen = F.bitmap_count(F.bitmap_or_agg("customers").over(until.rowsBetween(Window.unboundedPreceding, 0)))
    counted = monthly.select(
        "revenue_month", "user_range", F.bitmap_count("customers").alias("customers"), seen.alias("seen")
    )
    added = F.col("seen") - F.coalesce(F.lag("seen").over(until), F.lit(0))
    return (
        counted.withColumn("added", added)
        .groupBy(F.col("revenue_month").alias("month"))
        .agg(F.sum("customers").alias("customers"), F.sum("added").alias("new_customers"))
    )
