"""Declarative table contracts: not-null, unique, accepted values, relationships.

A contract lists a table's exceptions (optional columns) and its keys,
vocabularies and references. All contracts together are checked in three
passes: one aggregation per table for NULLs, one count per value for unique and
accepted-value rules, and one anti join for all references.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.config import (
    CHANNEL_DESCRIPTORS,
    COMPANY_DESCRIPTORS,
    OTHER_CHANNEL_GROUP,
    PUBLISHED_CHANNELS,
    TOUCH_CHANNELS,
    UNKNOWN,
)
from touchtrail.functions.columns import sql_text


@dataclass(frozen=True)
class Contract:
    """Rules of one table. Every column not in ``optional`` must be populated."""

    optional: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple] = field(default_factory=dict)
    # (column, parent table, parent column)
    references: tuple[tuple[str, str, str], ...] = ()


# --- Fixed values: vocabularies of the conformed tables ---------------------------

COMPANIES = tuple(COMPANY_DESCRIPTORS)
CHANNEL_GROUPS = tuple(dict.fromkeys(g for _, g in CHANNEL_DESCRIPTORS.values())) + (
    OTHER_CHANNEL_GROUP,
)
TOUCH_MATCH = ("matched", "missing_utm_campaign", "unmatched_or_invalid")
COMBINED_MATCH = (
    "matched_both",
    "matched_first_touch_only",
    "matched_last_touch_only",
    "missing_utm_campaign",
    "unmatched_or_invalid",
)
CONFIDENCE = ("high", "medium", "low")
QUARTERS = (1, 2, 3, 4)
EITHER = (True, False)

# --- End of fixed values ------------------------------------------------------------


def _reasons(touch: str) -> tuple[str, ...]:
    return (f"{touch}_channel", "utm_source", "referral_source", UNKNOWN)


_CAMPAIGN_ID = ("stg_campaign_metadata", "campaign_id")
_CAMPAIGN_SLUG = ("stg_campaign_metadata", "campaign_slug")
_SIGNUP = ("stg_user_signups", "user_id")
_CHANNEL = ("dim_channel", "channel_key")
_COMPANY = ("dim_company", "company_id")
_DAY = ("dim_time", "date_key")

CONTRACTS: dict[str, Contract] = {
    "stg_campaign_metadata": Contract(
        optional=("target_company_id",),
        unique=("campaign_id", "campaign_slug"),
        accepted={"channel": PUBLISHED_CHANNELS, "target_company_id": COMPANIES},
    ),
    "stg_content_performance": Contract(
        optional=("utm_source", "utm_campaign"),
        unique=("content_id",),
        accepted={"channel": PUBLISHED_CHANNELS, "utm_source": PUBLISHED_CHANNELS},
        references=(("utm_campaign", *_CAMPAIGN_SLUG),),
    ),
    "stg_portfolio_revenue": Contract(
        unique=("revenue_id",),
        accepted={"company_id": COMPANIES},
        references=(("user_id", *_SIGNUP),),
    ),
    "stg_user_signups": Contract(
        optional=("referral_source", "utm_source", "utm_medium", "utm_campaign"),
        unique=("user_id",),
        accepted={
            "company_id": COMPANIES,
            "utm_source": TOUCH_CHANNELS,
            "first_touch_channel": TOUCH_CHANNELS,
            "last_touch_channel": TOUCH_CHANNELS,
        },
        references=(("utm_campaign", *_CAMPAIGN_SLUG),),
    ),
    "int_user_journeys": Contract(
        optional=(
            "first_touch_channel", "last_touch_channel", "utm_source", "utm_medium",
            "utm_campaign", "referral_source", "first_touch_campaign_id", "last_touch_campaign_id",
        ),
        unique=("user_id",),
        accepted={
            "first_touch_attribution_reason": _reasons("first_touch"),
            "last_touch_attribution_reason": _reasons("last_touch"),
            "first_touch_campaign_match_status": TOUCH_MATCH,
            "last_touch_campaign_match_status": TOUCH_MATCH,
            "campaign_match_status": COMBINED_MATCH,
            "attribution_confidence": CONFIDENCE,
        },
        references=(
            ("user_id", *_SIGNUP),
            ("first_touch_campaign_id", *_CAMPAIGN_ID),
            ("last_touch_campaign_id", *_CAMPAIGN_ID),
        ),
    ),
    "int_attributed_revenue": Contract(
        optional=(
            "first_touch_channel", "last_touch_channel",
            "first_touch_campaign", "last_touch_campaign",
        ),
        unique=("revenue_id",),
        accepted={"missing_journey_flag": (False,)},
        references=(
            ("revenue_id", "stg_portfolio_revenue", "revenue_id"),
            ("user_id", *_SIGNUP),
            ("user_id", "int_user_journeys", "user_id"),
            ("first_touch_campaign", *_CAMPAIGN_ID),
            ("last_touch_campaign", *_CAMPAIGN_ID),
        ),
    ),
    "dim_channel": Contract(
        unique=("channel_key",),
        accepted={"channel_key": tuple(CHANNEL_DESCRIPTORS), "channel_group": CHANNEL_GROUPS},
    ),
    "dim_company": Contract(unique=("company_id",), accepted={"company_id": COMPANIES}),
    "dim_time": Contract(
        unique=("date_key", "date_day"),
        accepted={
            "quarter_number": QUARTERS,
            "iso_day_of_week": tuple(range(1, 8)),
            "is_weekend": EITHER,
        },
    ),
    "dim_user_cohort": Contract(
        unique=("cohort_key", "cohort_month", "cohort_label"),
        accepted={"cohort_quarter": QUARTERS},
        references=(("cohort_month", "dim_time", "date_day"),),
    ),
    "fct_attributed_revenue": Contract(
        optional=("first_touch_campaign_id", "last_touch_campaign_id"),
        unique=("revenue_id",),
        accepted={
            "is_recurring": EITHER,
            "campaign_match_status": COMBINED_MATCH,
            "attribution_confidence": CONFIDENCE,
        },
        references=(
            ("revenue_id", "int_attributed_revenue", "revenue_id"),
            ("user_id", *_SIGNUP),
            ("company_id", *_COMPANY),
            ("revenue_date_key", *_DAY),
            ("signup_date_key", *_DAY),
            ("cohort_key", "dim_user_cohort", "cohort_key"),
            ("first_touch_channel", *_CHANNEL),
            ("last_touch_channel", *_CHANNEL),
            ("first_touch_campaign_id", *_CAMPAIGN_ID),
            ("last_touch_campaign_id", *_CAMPAIGN_ID),
        ),
    ),
    "fct_campaign_roi": Contract(
        optional=("target_company_id",),
        unique=("campaign_id",),
        references=(
            ("campaign_id", *_CAMPAIGN_ID),
            ("channel", *_CHANNEL),
            ("target_company_id", *_COMPANY),
            ("start_date_key", *_DAY),
            ("end_date_key", *_DAY),
        ),
    ),
    "fct_content_performance": Contract(
        optional=("campaign_id", "click_through_rate"),
        unique=("content_performance_key",),
        references=(
            ("publish_month_date_key", *_DAY),
            ("channel", *_CHANNEL),
            ("campaign_id", *_CAMPAIGN_ID),
        ),
    ),
    "channel_performance": Contract(
        optional=("click_through_rate",),
        unique=("channel_key",),
        accepted={"channel_group": CHANNEL_GROUPS},
        references=(("channel_key", *_CHANNEL),),
    ),
    "campaign_performance": Contract(
        optional=(
            "target_company_id", "target_company_name",
            "first_touch_cost_per_customer", "last_touch_cost_per_customer",
        ),
        unique=("campaign_id",),
        references=(
            ("campaign_id", "fct_campaign_roi", "campaign_id"),
            ("channel_key", *_CHANNEL),
            ("target_company_id", *_COMPANY),
        ),
    ),
    "company_revenue_analysis": Contract(
        unique=("company_id",), references=(("company_id", *_COMPANY),)
    ),
    "monthly_revenue_customer_growth": Contract(
        optional=(
            "revenue_change", "revenue_growth_rate", "customer_change", "customer_growth_rate",
        ),
        unique=("month_key", "month_date_key", "month_start_date"),
        references=(("month_date_key", *_DAY),),
    ),
}


def constraint_names(tables: Mapping[str, DataFrame | list[str]], contracts=CONTRACTS) -> list[str]:
    """Names of all constraints; needs only the column lists."""
    names = []
    for table, contract in contracts.items():
        columns = getattr(tables[table], "columns", tables[table])
        names += [f"not_null:{table}.{c}" for c in columns if c not in contract.optional]
        names += [f"unique:{table}.{c}" for c in contract.unique]
        names += [f"accepted:{table}.{c}" for c in contract.accepted]
        names += [f"reference:{table}.{c}->{p}.{pc}" for c, p, pc in contract.references]
    return names


# Expressions below are generated as SQL text: one call per table, not one per rule.
# Constraints travel as their number in ``constraint_names``, not as text.


def _missing_values(
    table: str, df: DataFrame, contract: Contract, numbers: Mapping[str, int]
) -> DataFrame:
    required = [c for c in df.columns if c not in contract.optional]
    counts = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS `{c}`" for c in required])
    rows = ", ".join(f"{numbers[f'not_null:{table}.{c}']}, `{c}`" for c in required)
    return counts.selectExpr(f"stack({len(required)}, {rows}) AS (number, failures)")


def _checked_values(
    table: str, df: DataFrame, contract: Contract, numbers: Mapping[str, int]
) -> DataFrame:
    """(number, value) pairs: all values of unique columns, unlisted values otherwise."""
    entries = [
        f"{numbers[f'unique:{table}.{c}']}, CAST(`{c}` AS STRING)" for c in contract.unique
    ]
    for c, vocabulary in contract.accepted.items():
        listed = ", ".join(sql_text(v) for v in vocabulary)
        unlisted = f"CASE WHEN `{c}` NOT IN ({listed}) THEN CAST(`{c}` AS STRING) END"
        entries.append(f"{numbers[f'accepted:{table}.{c}']}, {unlisted}")
    pairs = f"stack({len(entries)}, {', '.join(entries)}) AS (number, value)"
    return df.selectExpr(pairs).where("value IS NOT NULL")


def _value_failures(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], numbers: Mapping[str, int]
) -> DataFrame:
    """Failing values: duplicated ones of unique columns, unlisted ones otherwise."""
    pairs = reduce(
        DataFrame.unionByName,
        [
            _checked_values(t, tables[t], c, numbers)
            for t, c in contracts.items()
            if c.unique or c.accepted
        ],
    )
    counted = pairs.groupBy("number", "value").agg(F.count(F.lit(1)).alias("rows"))
    accepted = [i for name, i in numbers.items() if name.startswith("accepted:")]
    failing = F.col("number").isin(accepted) | (F.col("rows") > 1)
    return counted.where(failing).groupBy("number").agg(F.count(F.lit(1)).alias("failures"))


def _reference_failures(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract], numbers: Mapping[str, int]
) -> list[DataFrame]:
    """Rows whose populated key has no parent; counted per key before the join.

    Keys keep their type: one join for all references of a type, whichever tables they
    are between. It is an outer join with a flag, because an anti join would be pushed
    below the count and the union, and then run, parents and all, once per table.
    """
    by_type: dict[str, dict[str, list[tuple[int, int, str]]]] = {}
    targets: dict[tuple[str, str], int] = {}
    for table, contract in contracts.items():
        types = dict(tables[table].dtypes)
        for column, parent, parent_column in contract.references:
            number = numbers[f"reference:{table}.{column}->{parent}.{parent_column}"]
            target = targets.setdefault((parent, parent_column), len(targets))
            kind = types[column]
            by_type.setdefault(kind, {}).setdefault(table, []).append((number, target, column))
    failures = []
    for kind, children in by_type.items():
        listed, wanted = [], {}
        for table, references in children.items():
            entries = ", ".join(f"{n}, {t}, `{c}`" for n, t, c in references)
            triples = f"stack({len(references)}, {entries}) AS (number, target, value)"
            listed.append(tables[table].selectExpr(triples))
            wanted |= {t: None for _, t, _ in references}
        parents = [
            tables[parent].selectExpr(f"{t} AS target", f"CAST(`{c}` AS {kind}) AS value")
            for (parent, c), t in targets.items()
            if t in wanted
        ]
        counted = (
            reduce(DataFrame.unionByName, listed)
            .where("value IS NOT NULL")
            .groupBy("number", "target", "value")
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        known = reduce(DataFrame.unionByName, parents).distinct().withColumn("known", F.lit(True))
        failures.append(
            counted.join(known, ["target", "value"], "left")
            .where("known IS NULL")
            .groupBy("number")
            .agg(F.sum("rows").alias("failures"))
        )
    return failures


def contract_report(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract] = CONTRACTS
) -> DataFrame:
    """One row per constraint with its failures: rows for not-null and references,
    values for unique and accepted."""
    spark = next(iter(tables.values())).sparkSession
    names = constraint_names(tables, contracts)
    numbers = {name: i for i, name in enumerate(names)}
    listed = ", ".join(sql_text(n) for n in names)
    all_names = spark.range(1).selectExpr(
        f"posexplode(array({listed})) AS (number, constraint_name)"
    )
    found = reduce(
        DataFrame.unionByName,
        [
            *[_missing_values(t, tables[t], c, numbers) for t, c in contracts.items()],
            _value_failures(tables, contracts, numbers),
            *_reference_failures(tables, contracts, numbers),
        ],
    )
    return all_names.join(found, "number", "left").select(
        "constraint_name",
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        (F.coalesce("failures", F.lit(0)) == 0).alias("passed"),
    )
