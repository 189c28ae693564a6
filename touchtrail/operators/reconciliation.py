"""Conservation and non-negativity checks between stored layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 0.01

# check name -> (expected table, expected column, actual table, actual column)
ANALYTICS_TOTALS = {
    "channel_first_touch_revenue": (
        "fct_attributed_revenue", "revenue_amount", "channel_performance", "first_touch_revenue"),
    "channel_last_touch_revenue": (
        "fct_attributed_revenue", "revenue_amount", "channel_performance", "last_touch_revenue"),
    "company_total_revenue": (
        "fct_attributed_revenue", "revenue_amount", "company_revenue_analysis", "total_revenue"),
    "monthly_total_revenue": (
        "fct_attributed_revenue", "revenue_amount", "monthly_revenue_customer_growth",
        "total_revenue"),
    "campaign_budget": (
        "fct_campaign_roi", "budget_usd", "campaign_performance", "budget_usd"),
    "campaign_first_touch_revenue": (
        "fct_campaign_roi", "first_touch_attributed_revenue", "campaign_performance",
        "first_touch_attributed_revenue"),
    "campaign_last_touch_revenue": (
        "fct_campaign_roi", "last_touch_attributed_revenue", "campaign_performance",
        "last_touch_attributed_revenue"),
}

# table -> measures that may not be negative
NONNEGATIVE = {
    "fct_attributed_revenue": ("revenue_amount",),
    "fct_campaign_roi": (
        "budget_usd", "first_touch_attributed_revenue", "last_touch_attributed_revenue",
        "first_touch_customers", "last_touch_customers", "first_touch_roas", "last_touch_roas",
    ),
    "fct_content_performance": ("content_count", "views", "clicks", "click_through_rate"),
    "channel_performance": (
        "first_touch_revenue", "last_touch_revenue", "first_touch_customers",
        "last_touch_customers", "first_touch_revenue_records", "last_touch_revenue_records",
        "content_count", "views", "clicks", "click_through_rate", "campaign_count",
        "campaign_budget_usd",
    ),
    "campaign_performance": (
        "budget_usd", "first_touch_attributed_revenue", "last_touch_attributed_revenue",
        "first_touch_customers", "last_touch_customers", "first_touch_roas", "last_touch_roas",
        "first_touch_cost_per_customer", "last_touch_cost_per_customer",
    ),
    "company_revenue_analysis": (
        "total_revenue", "recurring_revenue", "initial_revenue", "revenue_record_count",
        "customer_count", "first_touch_channel_count", "last_touch_channel_count",
        "first_touch_campaign_revenue", "last_touch_campaign_revenue",
        "average_revenue_per_customer", "portfolio_revenue_share",
    ),
    "monthly_revenue_customer_growth": (
        "total_revenue", "recurring_revenue", "initial_revenue", "revenue_record_count",
        "active_customers", "new_customers",
    ),
}


def _totals(tables: Mapping[str, DataFrame]) -> dict[tuple[str, str], Column]:
    """A scalar subquery per needed (table, column) sum."""
    wanted = {}
    for a_table, a_column, b_table, b_column in ANALYTICS_TOTALS.values():
        for table, column in ((a_table, a_column), (b_table, b_column)):
            wanted[table, column] = tables[table].agg(F.sum(column)).scalar()
    return wanted


def _check_row(name: str, expected: Column, actual: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        expected.cast("double").alias("expected_value"),
        actual.cast("double").alias("actual_value"),
    )


def conservation_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Fact against intermediate (records, revenue), then summaries against facts."""
    spark = tables["fct_attributed_revenue"].sparkSession
    intermediate, fact = tables["int_attributed_revenue"], tables["fct_attributed_revenue"]

    def records(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    sums = _totals(tables)
    rows = [
        _check_row("fact_record_count", records(intermediate), records(fact)),
        _check_row(
            "fact_revenue",
            intermediate.agg(F.sum("revenue_amount")).scalar(),
            sums["fct_attributed_revenue", "revenue_amount"],
        ),
    ]
    for name, (a_table, a_column, b_table, b_column) in ANALYTICS_TOTALS.items():
        rows.append(_check_row(name, sums[a_table, a_column], sums[b_table, b_column]))
    gap = F.abs(F.col("expected_value") - F.col("actual_value"))
    allowed = F.when(F.col("check_name") == "fact_record_count", 0.0).otherwise(TOLERANCE)
    return (
        spark.range(1)
        .select(F.array(*rows).alias("_rows"))
        .select(F.inline("_rows"))
        .withColumn("conserved", F.coalesce(gap <= allowed, F.lit(True)))
    )


def nonnegative_report(
    tables: Mapping[str, DataFrame], measures: Mapping[str, tuple[str, ...]] = NONNEGATIVE
) -> DataFrame:
    """Rows per table with any negative measure."""

    def violations(table: str, columns: tuple[str, ...]) -> DataFrame:
        negative = reduce(
            lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns]
        )
        return tables[table].agg(F.count_if(negative).alias("invalid_row_count")).select(
            F.lit(table).alias("model_name"), "invalid_row_count"
        )

    return reduce(DataFrame.unionByName, [violations(t, c) for t, c in measures.items()])


def violated(report: DataFrame) -> DataFrame:
    """Only the tables with a violation, as the singular tests return them."""
    return report.where(F.col("invalid_row_count") > 0)
