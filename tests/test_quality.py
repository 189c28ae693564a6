"""Raw report: every rule flips on one injected violation; contracts; reconciliation."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import contracts, quality, reconciliation
from touchtrail.plans import pipeline
from touchtrail.plans.models import TABLES
from touchtrail.sources.derived import raw_tables
from touchtrail.sources.schemas import RAW_SCHEMAS


@pytest.fixture(scope="module")
def clean(spark):
    """Two rows per table that pass every rule."""
    def table(name, *rows):
        text = ", ".join(rows)
        columns = ", ".join(RAW_SCHEMAS[name].fieldNames())
        df = spark.sql(f"SELECT * FROM VALUES {text} AS t({columns})")
        return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS[name]])

    return {
        "campaign_metadata": table(
            "campaign_metadata",
            "('K1', 'One', 'blog', 10, '2024-01-01', '2024-01-31', 'CTC-001')",
            "('K2', 'Two', 'blog', 10, '2024-01-01', '2024-01-01', '')"),
        "content_performance": table(
            "content_performance",
            "('N1', 'blog', '2024-01-01', 5, 1, 'blog', 'one')",
            "('N2', 'blog', '2024-01-02', 0, 0, 'blog', 'two')"),
        "portfolio_revenue": table(
            "portfolio_revenue",
            "('R1', 'CTC-001', 'U1', '2024-01', 9, true)",
            "('R2', 'CTC-002', 'U2', '2024-02', 0, false)"),
        "user_signups": table(
            "user_signups",
            "('U1', '2024-01-01', 'CTC-001', 'direct', 'blog', 'email', 'one', 'BLOG', 'blog')",
            "('U2', '2024-01-01', 'CTC-002', 'blog', 'blog', 'email', 'one', 'blog', 'blog')"),
    }


def statuses(findings):
    return {r["check_name"]: r for r in quality.judged(findings).collect()}


def test_clean_tables_pass_all_sixty(spark, clean):
    rows = quality.raw_report(spark, clean).collect()
    assert len(rows) == 60
    assert {r["status"] for r in rows} == {"PASS"}
    assert len({r["timestamp"] for r in rows}) == 1
    counts = quality.status_counts(quality.raw_report(spark, clean)).first()
    assert (counts["pass"], counts["warn"], counts["fail"]) == (60, 0, 0)


# (table, column, value in the first row) -> checks that must flip, with their status
VIOLATIONS = [
    ("campaign_metadata", "campaign_id", None, {"required_value_campaign_metadata_campaign_id": "FAIL"}),
    ("campaign_metadata", "campaign_name", " ", {"required_value_campaign_metadata_campaign_name": "FAIL"}),
    ("campaign_metadata", "campaign_id", "K2", {"duplicate_primary_key_campaign_metadata": "FAIL"}),
    ("campaign_metadata", "budget_usd", -1, {"nonnegative_campaign_budget": "FAIL"}),
    ("campaign_metadata", "start_date", "2024-02", {"valid_date_campaign_start_date": "FAIL"}),
    ("campaign_metadata", "start_date", "2024-02-01", {"valid_campaign_date_range": "FAIL"}),
    ("campaign_metadata", "target_company_id", "CTC-9", {"valid_campaign_target_company": "FAIL"}),
    ("campaign_metadata", "channel", "", {"missing_attribution_campaign_channel": "WARN"}),
    ("content_performance", "views", None, {"required_value_content_performance_views": "FAIL"}),
    ("content_performance", "clicks", -5, {"nonnegative_content_clicks": "FAIL"}),
    ("content_performance", "publish_date", "soon", {"valid_date_content_publish_date": "FAIL"}),
    ("content_performance", "utm_source", None, {"missing_attribution_content_utm_source": "WARN"}),
    ("portfolio_revenue", "month", "2024-13", {"valid_date_revenue_month": "FAIL"}),
    ("portfolio_revenue", "is_recurring", None, {"required_value_portfolio_revenue_is_recurring": "FAIL"}),
    ("portfolio_revenue", "user_id", "U9", {"revenue_user_exists": "FAIL"}),
    ("portfolio_revenue", "company_id", "ctc-001", {"valid_revenue_company": "FAIL"}),
    ("portfolio_revenue", "revenue_amount", -1, {"nonnegative_revenue_amount": "FAIL"}),
    ("user_signups", "company_id", "CTC-9", {"valid_signup_company": "FAIL"}),
    ("user_signups", "signup_date", "2024", {"valid_date_signup_date": "FAIL"}),
    ("user_signups", "utm_medium", "", {"missing_attribution_signup_utm_medium": "WARN"}),
    ("user_signups", "last_touch_channel", "podcast", {"conflicting_first_last_touch": "WARN"}),
    ("user_signups", "first_touch_channel", "blog ",
     {"conflicting_first_last_touch": "WARN", "conflicting_utm_first_touch": "WARN"}),
    ("user_signups", "referral_source", "podcast", {"conflicting_referral_utm": "WARN"}),
    ("user_signups", "referral_source", "Direct", {}),
]


@pytest.mark.parametrize(("table", "column", "value", "expected"), VIOLATIONS)
def test_one_violation_flips_exactly_its_checks(clean, table, column, value, expected):
    first_key = quality.PRIMARY_KEYS[table]
    first = clean[table].agg(F.min(first_key)).first()[0]
    kind = RAW_SCHEMAS[table][column].dataType
    broken = clean[table].withColumn(
        column, F.when(F.col(first_key) == first, F.lit(value).cast(kind)).otherwise(F.col(column)))
    related = {"user_signups": clean["user_signups"]} if table == "portfolio_revenue" else {}
    got = statuses(quality.value_findings(related | {table: broken}))
    assert {n: r["status"] for n, r in got.items() if r["status"] != "PASS"} == expected
    for name in expected:
        assert got[name]["message"].endswith(": 1 row(s)")


def test_duplicates_count_keys_and_null_is_a_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "k string")
    got = {r["k"]: r["rows"] for r in quality.duplicated_keys(df, "k").collect()}
    assert got == {"a": 3, None: 2}


def test_message_has_thousands_separators(spark, clean):
    many = clean["user_signups"].crossJoin(spark.range(700)).drop("id").withColumn(
        "utm_source", F.lit(""))
    got = statuses(quality.count_rules(
        many, [r for r in quality.row_rules() if r.name == "missing_attribution_signup_utm_source"]))
    assert got["missing_attribution_signup_utm_source"]["message"].endswith("1,400 row(s)")


def test_missing_table_column_and_type(spark, clean):
    tables = {k: v for k, v in clean.items() if k != "user_signups"}
    tables["content_performance"] = clean["content_performance"].drop("views", "channel")
    tables["portfolio_revenue"] = clean["portfolio_revenue"].withColumn(
        "revenue_amount", F.col("revenue_amount").cast("double"))
    rows = {r["check_name"]: r for r in quality.raw_report(spark, tables).collect()}
    assert rows["table_exists_user_signups"]["status"] == "FAIL"
    assert "required_columns_user_signups" not in rows
    assert rows["required_columns_content_performance"]["message"] == "Missing column(s): channel, views"
    assert "revenue_amount=double (expected decimal(18,2))" in rows[
        "expected_types_portfolio_revenue"]["message"]
    assert "revenue_user_exists" not in rows and "nonnegative_revenue_amount" in rows


def test_any_failure_raises(spark, clean):
    quality.raise_on_failure(quality.raw_report(spark, clean))
    tables = {k: v for k, v in clean.items() if k != "user_signups"}
    with pytest.raises(quality.ValidationFailed, match="table_exists_user_signups"):
        quality.raise_on_failure(quality.raw_report(spark, tables))


# -- contracts ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    """All model tables over sources that keep the rules."""
    models = pipeline.storing_models(raw_tables(spark, sf_dir, flawed=False))
    return {name: getattr(models, name) for name in TABLES}


def test_number_of_constraints(tables):
    names = contracts.constraint_names(tables)
    kinds = [n.split(":")[0] for n in names]
    assert len(set(names)) == len(names) == 255
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 169, "unique": 23, "accepted": 27, "reference": 36}


def test_contract_violations_are_counted(spark):
    child = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 2), (None, "y", 2), ("b", "z", None)], "k string, c string, p int")
    parent = spark.createDataFrame([(1,)], "id int")
    rules = {
        "child": contracts.Contract(
            optional=("p",), unique=("k",), accepted={"c": ("x",)},
            references=(("p", "parent", "id"),)),
        "parent": contracts.Contract(unique=("id",)),
    }
    report = contracts.contract_report({"child": child, "parent": parent}, rules)
    got = {r["constraint_name"]: r["failures"] for r in report.collect()}
    assert got == {
        "not_null:child.k": 1, "not_null:child.c": 0, "unique:child.k": 1, "accepted:child.c": 2,
        "reference:child.p->parent.id": 2, "not_null:parent.id": 0, "unique:parent.id": 0,
    }


def test_only_known_source_defects_fail(tables):
    """The derived content has repeated keys and some signups lack a touch; nothing else fails."""
    failing = {r["constraint_name"] for r in
               contracts.contract_report(tables).where("NOT passed").collect()}
    assert failing <= {
        "unique:stg_content_performance.content_id",
        "not_null:stg_user_signups.first_touch_channel",
        "not_null:stg_user_signups.last_touch_channel",
    }


def test_conservation_detects_a_lost_record(tables):
    report = reconciliation.conservation_report(tables)
    assert report.count() == 9 and report.where("NOT conserved").count() == 0
    one = tables["fct_attributed_revenue"].agg(F.min("revenue_id")).first()[0]
    lossy = {**tables, "fct_attributed_revenue":
             tables["fct_attributed_revenue"].where(F.col("revenue_id") != one)}
    broken = {r["check_name"] for r in
              reconciliation.conservation_report(lossy).where("NOT conserved").collect()}
    assert broken == {
        "fact_record_count", "fact_revenue", "channel_first_touch_revenue",
        "channel_last_touch_revenue", "company_total_revenue", "monthly_total_revenue"}


def test_negative_measures_are_reported(tables):
    assert reconciliation.violated(reconciliation.nonnegative_report(tables)).count() == 0
    negative = {**tables, "channel_performance": tables["channel_performance"].withColumn(
        "views", F.lit(-1).cast("bigint"))}
    (row,) = reconciliation.violated(reconciliation.nonnegative_report(negative)).collect()
    assert row["model_name"] == "channel_performance"
    assert row["invalid_row_count"] == tables["channel_performance"].count()


def test_flawed_sources_break_rules_of_every_kind(spark, sf_dir):
    """The default derived sources give the registered reports something to count."""
    raw = raw_tables(spark, sf_dir)
    hit = {
        r["check_name"]
        for r in quality.judged(quality.value_findings(raw)).where("issue_count > 0").collect()
    }
    assert "revenue_user_exists" in hit
    assert len(hit) >= 10
    journeys = pipeline.storing_models(raw)
    reasons = {
        r[0]
        for touch in ("first_touch", "last_touch")
        for r in journeys.int_user_journeys.select(f"{touch}_attribution_reason").distinct().collect()
    }
    assert {"utm_source", "referral_source"} <= reasons
    flags = journeys.int_attributed_revenue.select("missing_journey_flag").distinct().collect()
    assert {r[0] for r in flags} == {True, False}


def test_references_are_joined_once_per_type(tables):
    """The references share joins; parents are not copied into every child's plan."""
    plan = contracts.contract_report(tables)._jdf.queryExecution().optimizedPlan().toString()
    joins = plan.count("Join LeftOuter") + plan.count("Join LeftAnti")
    kinds = {
        dict(tables[t].dtypes)[c]
        for t, contract in contracts.CONTRACTS.items()
        for c, _, _ in contract.references
    }
    assert joins == len(kinds) + 1
    assert plan.count("Relation [") < 5 * len(tables)
