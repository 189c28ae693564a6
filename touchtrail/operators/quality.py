"""Raw data-quality report.

All row-level rules of a table are counted in one aggregation pass; duplicate
keys and orphan keys are counted after a map-side count per key. Rules never see
the driver: the report is a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.config import COMPANY_DESCRIPTORS, UNCOMPARED_REFERRALS
from touchtrail.functions.columns import is_blank, safe_date, safe_month, sql_text
from touchtrail.functions.text import count_text
from touchtrail.sources.schemas import RAW_SCHEMAS

# Check names, severities and message texts in this module are fixed values: reports and
# logs are compared by them.

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

PRIMARY_KEYS = {
    "campaign_metadata": "campaign_id",
    "content_performance": "content_id",
    "portfolio_revenue": "revenue_id",
    "user_signups": "user_id",
}

# Columns that must be populated.
REQUIRED = {
    "campaign_metadata": ("campaign_id", "campaign_name", "budget_usd", "start_date", "end_date"),
    "content_performance": ("content_id", "publish_date", "views", "clicks"),
    "portfolio_revenue": tuple(RAW_SCHEMAS["portfolio_revenue"].fieldNames()),
    "user_signups": ("user_id", "signup_date", "company_id"),
}

# Attribution columns that may be empty, at the price of a warning: check name -> (table, column).
OPTIONAL_ATTRIBUTION = {
    "content_utm_source": ("content_performance", "utm_source"),
    "content_utm_campaign": ("content_performance", "utm_campaign"),
    "signup_utm_source": ("user_signups", "utm_source"),
    "signup_utm_medium": ("user_signups", "utm_medium"),
    "signup_utm_campaign": ("user_signups", "utm_campaign"),
    "campaign_channel": ("campaign_metadata", "channel"),
    "content_channel": ("content_performance", "channel"),
    "signup_first_touch_channel": ("user_signups", "first_touch_channel"),
    "signup_last_touch_channel": ("user_signups", "last_touch_channel"),
}

# check name -> (table, date column)
DATE_COLUMNS = {
    "campaign_start_date": ("campaign_metadata", "start_date"),
    "campaign_end_date": ("campaign_metadata", "end_date"),
    "content_publish_date": ("content_performance", "publish_date"),
    "signup_date": ("user_signups", "signup_date"),
}

# check name -> (table, measure that may not be negative)
MEASURES = {
    "campaign_budget": ("campaign_metadata", "budget_usd"),
    "content_views": ("content_performance", "views"),
    "content_clicks": ("content_performance", "clicks"),
    "revenue_amount": ("portfolio_revenue", "revenue_amount"),
}


@dataclass(frozen=True)
class RowRule:
    """A condition that is true for an offending row."""

    name: str
    table: str
    offends: Column
    severity: str
    good: str
    bad: str


def _full(table: str, column: str) -> str:
    return f"raw.{table}.{column}"


def _required_rules() -> list[RowRule]:
    rules = []
    for table, columns in REQUIRED.items():
        for column in columns:
            text = isinstance(RAW_SCHEMAS[table][column].dataType, T.StringType)
            empty = is_blank(column) if text else F.col(column).isNull()
            rules.append(RowRule(
                f"required_value_{table}_{column}", table, empty, FAIL,
                f"{_full(table, column)} has no missing values",
                f"{_full(table, column)} has missing values",
            ))
    return rules


def _date_rules() -> list[RowRule]:
    rules = []
    for name, (table, column) in DATE_COLUMNS.items():
        rules.append(RowRule(
            f"valid_date_{name}", table, ~is_blank(column) & safe_date(column).isNull(), FAIL,
            f"{_full(table, column)} contains valid dates",
            f"{_full(table, column)} contains invalid dates",
        ))
    month = _full("portfolio_revenue", "month")
    rules.append(RowRule(
        "valid_date_revenue_month", "portfolio_revenue",
        ~is_blank("month") & safe_month("month").isNull(), FAIL,
        f"{month} contains valid YYYY-MM values", f"{month} contains invalid YYYY-MM values",
    ))
    rules.append(RowRule(
        "valid_campaign_date_range", "campaign_metadata",
        safe_date("start_date") > safe_date("end_date"), FAIL,
        "All campaign start dates are on or before end dates",
        "Campaign start date occurs after end date",
    ))
    return rules


def _measure_rules() -> list[RowRule]:
    return [
        RowRule(
            f"nonnegative_{name}", table, F.col(column) < 0, FAIL,
            f"{_full(table, column)} is non-negative",
            f"{_full(table, column)} contains negative values",
        )
        for name, (table, column) in MEASURES.items()
    ]


def _company_rules(companies: tuple[str, ...]) -> list[RowRule]:
    unlisted = ~F.col("company_id").isin(*companies)
    target = "target_company_id"
    return [
        RowRule(
            "valid_revenue_company", "portfolio_revenue", unlisted, FAIL,
            "Every revenue company_id is valid", "Revenue rows reference an invalid company_id",
        ),
        RowRule(
            "valid_signup_company", "user_signups", unlisted, FAIL,
            "Every signup company_id is valid", "Signup rows reference an invalid company_id",
        ),
        RowRule(
            "valid_campaign_target_company", "campaign_metadata",
            ~is_blank(target) & ~F.col(target).isin(*companies), FAIL,
            "Every populated campaign target_company_id is valid",
            "Campaign rows reference an invalid target_company_id",
        ),
    ]


def _attribution_rules() -> list[RowRule]:
    rules = []
    for name, (table, column) in OPTIONAL_ATTRIBUTION.items():
        rules.append(RowRule(
            f"missing_attribution_{name}", table, is_blank(column), WARN,
            f"{_full(table, column)} has no missing values",
            f"{_full(table, column)} has missing values",
        ))

    def conflict(a: str, b: str) -> Column:
        return ~is_blank(a) & ~is_blank(b) & (F.lower(a) != F.lower(b))

    comparable = ~F.lower("referral_source").isin(*UNCOMPARED_REFERRALS)
    rules += [
        RowRule(
            "conflicting_first_last_touch", "user_signups",
            conflict("first_touch_channel", "last_touch_channel"), WARN,
            "First-touch and last-touch channels agree for all signups",
            "Signups have different first-touch and last-touch channels",
        ),
        RowRule(
            "conflicting_utm_first_touch", "user_signups",
            conflict("utm_source", "first_touch_channel"), WARN,
            "Populated UTM sources agree with first-touch channels",
            "Signups have conflicting UTM source and first-touch channel",
        ),
        RowRule(
            "conflicting_referral_utm", "user_signups",
            conflict("referral_source", "utm_source") & comparable, WARN,
            "Comparable referral sources agree with populated UTM sources",
            "Signups have conflicting referral and UTM sources",
        ),
    ]
    return rules


def row_rules(companies: tuple[str, ...] = tuple(COMPANY_DESCRIPTORS)) -> list[RowRule]:
    return [
        *_required_rules(),
        *_date_rules(),
        *_measure_rules(),
        *_company_rules(companies),
        *_attribution_rules(),
    ]


# -- counting --------------------------------------------------------------------


def _findings(counts: DataFrame, described: list[tuple[str, str, str, str]]) -> DataFrame:
    """Turn one row with a count per check name into one row per check."""
    rows = ", ".join(
        ", ".join([*map(sql_text, (name, severity, good, bad)), f"coalesce(`{name}`, 0L)"])
        for name, severity, good, bad in described
    )
    columns = "check_name, severity, good, bad, issue_count"
    return counts.selectExpr(f"stack({len(described)}, {rows}) AS ({columns})")


def count_rules(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """All rules of one table in one pass: one output row per rule."""
    counts = df.agg(*[F.count_if(r.offends).alias(r.name) for r in rules])
    return _findings(counts, [(r.name, r.severity, r.good, r.bad) for r in rules])


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row, with their row count (NULL is a key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def _duplicate_finding(df: DataFrame, table: str) -> DataFrame:
    key = PRIMARY_KEYS[table]
    name = f"duplicate_primary_key_{table}"
    good, bad = f"{_full(table, key)} is unique", f"{_full(table, key)} contains duplicate keys"
    count = duplicated_keys(df, key).agg(F.count(F.lit(1)).alias(name))
    return _findings(count, [(name, FAIL, good, bad)])


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child key values absent from the parent, with their row count.

    Counted per key before the join, so a hot key is one row. NULL never has a parent.
    """
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")


def _orphan_finding(revenue: DataFrame, signups: DataFrame) -> DataFrame:
    name = "revenue_user_exists"
    count = orphan_keys(revenue, signups, "user_id").agg(F.sum("rows").alias(name))
    good = "Every revenue user_id exists in raw.user_signups"
    return _findings(count, [(name, FAIL, good, "Revenue rows reference an unknown user_id")])


def value_findings(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Counts of every value rule that applies to the tables present."""
    rules = row_rules()
    parts = []
    for table, df in raw.items():
        own = [r for r in rules if r.table == table]
        parts.append(count_rules(df, own))
        parts.append(_duplicate_finding(df, table))
    if {"portfolio_revenue", "user_signups"} <= set(raw):
        parts.append(_orphan_finding(raw["portfolio_revenue"], raw["user_signups"]))
    return reduce(DataFrame.unionByName, parts)


def judged(findings: DataFrame) -> DataFrame:
    """check_name, status, issue_count, message."""
    clean = F.col("issue_count") == 0
    message = F.concat(
        F.col("bad"), F.lit(": "), count_text(F.col("issue_count")), F.lit(" row(s)")
    )
    return findings.select(
        "check_name",
        F.when(clean, PASS).otherwise(F.col("severity")).alias("status"),
        "issue_count",
        F.when(clean, F.col("good")).otherwise(message).alias("message"),
    )


# -- schema ------------------------------------------------------------------------


def _schema_results(table: str, df: DataFrame | None) -> list[tuple[str, str, str]]:
    if df is None:
        return [(f"table_exists_{table}", FAIL, f"Required table raw.{table} does not exist")]
    expected = {f.name: f.dataType.simpleString() for f in RAW_SCHEMAS[table].fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    absent = sorted(expected.keys() - actual.keys())
    wrong = [
        f"{name}={actual[name]} (expected {kind})"
        for name, kind in expected.items()
        if name in actual and actual[name] != kind
    ]
    return [
        (f"table_exists_{table}", PASS, f"Required table raw.{table} exists"),
        (
            f"required_columns_{table}",
            FAIL if absent else PASS,
            f"Missing column(s): {', '.join(absent)}" if absent
            else "All required columns are present",
        ),
        (
            f"expected_types_{table}",
            FAIL if wrong else PASS,
            f"Invalid type(s): {', '.join(wrong)}" if wrong
            else "All columns have the expected types",
        ),
    ]


def schema_report(spark: SparkSession, raw: Mapping[str, DataFrame]) -> DataFrame:
    """Table, column and type checks; reads only the declared schemas."""
    results = [r for table in RAW_SCHEMAS for r in _schema_results(table, raw.get(table))]
    rows = ", ".join(
        ", ".join(map(sql_text, (name, status, message))) for name, status, message in results
    )
    listed = spark.range(1).selectExpr(
        f"stack({len(results)}, {rows}) AS (check_name, status, message)"
    )
    issues = F.when(F.col("status") == PASS, 0).otherwise(1).cast("bigint")
    return listed.select("check_name", "status", issues.alias("issue_count"), "message")


def raw_report(spark: SparkSession, raw: Mapping[str, DataFrame]) -> DataFrame:
    """The full report of one run: 60 results when every table is present and typed.

    A table whose schema is incomplete is reported, and its value rules are left
    out, because they would name columns that do not exist.
    """
    complete = {
        table: df for table, df in raw.items()
        if set(RAW_SCHEMAS[table].fieldNames()) <= set(df.columns)
    }
    schema = schema_report(spark, raw)
    if not complete:
        return schema.withColumn("timestamp", F.current_timestamp())
    report = schema.unionByName(judged(value_findings(complete)))
    return report.withColumn("timestamp", F.current_timestamp())


def status_counts(report: DataFrame) -> DataFrame:
    """One row with the number of PASS, WARN and FAIL results."""
    return report.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in (PASS, WARN, FAIL)]
    )


class ValidationFailed(Exception):
    """At least one check failed."""


def raise_on_failure(report: DataFrame) -> None:
    """Raise with the names of failed checks (a report has one row per check)."""
    failed = [r["check_name"] for r in report.where(F.col("status") == FAIL).collect()]
    if failed:
        raise ValidationFailed("Failed checks: " + ", ".join(sorted(failed)))
