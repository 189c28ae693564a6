"""Facts, dimensions and summaries on hand-made edge cases."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchtrail.config import SKEW
from touchtrail.operators import dimensions, facts, summaries

CELLS = """
  user_id string, company_id string, revenue_date_key int, cohort_key int,
  first_touch_channel string, last_touch_channel string, first_touch_campaign_id string,
  last_touch_campaign_id string, revenue_amount decimal(18,2), is_recurring boolean,
  record_count bigint
"""


@pytest.fixture(scope="module")
def cells(spark):
    d = Decimal
    rows = [
        ("u1", "C1", 20240101, 202401, "blog", "podcast", "A", None, d("10.00"), False, 1),
        ("u1", "C1", 20240301, 202401, "blog", "podcast", "A", None, d("30.00"), True, 2),
        ("u2", "C2", 20240301, 202403, "blog", "blog", "A", "A", d("5.00"), None, 1),
        (None, "C1", 20240301, None, "unknown", "unknown", None, None, d("1.00"), True, 1),
        ("u3", None, 20240301, 202401, "blog", None, None, None, d("4.00"), True, 1),
        ("u4", "C1", None, 202401, "blog", "blog", None, None, d("2.00"), True, 1),
    ]
    return spark.createDataFrame(rows, CELLS)


@pytest.fixture(scope="module")
def dates(spark):
    bounds = spark.sql("SELECT DATE'2024-01-01' AS first_day, DATE'2024-03-31' AS last_day")
    return dimensions.dim_time(bounds)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_touch_totals_count_users_once_and_ignore_null_users(cells):
    got = by(facts.touch_totals(cells, "first_touch_channel", "last_touch_channel", "k"), "k")
    assert got["blog"]["first_touch_customers"] == 4
    assert got["blog"]["first_touch_records"] == 6
    assert got["blog"]["last_touch_customers"] == 2
    assert got["unknown"]["first_touch_customers"] == 0
    assert got["unknown"]["first_touch_revenue"] == 1
    assert None not in got


def test_campaign_roi_with_zero_budget_and_no_revenue(spark, cells):
    campaigns = spark.sql("""
      SELECT id AS campaign_id, 'blog' AS channel, CAST(NULL AS STRING) AS target_company_id,
             CAST(b AS DECIMAL(18,2)) AS budget_usd, DATE'2024-01-01' AS start_date,
             CAST(NULL AS DATE) AS end_date
      FROM VALUES ('A', 100), ('Z', 0), ('N', 50) AS t(id, b)""")
    got = by(facts.fct_campaign_roi(campaigns, cells), "campaign_id")
    assert got["A"]["first_touch_attributed_revenue"] == 45
    assert got["A"]["first_touch_customers"] == 2 and got["A"]["last_touch_customers"] == 1
    assert got["A"]["first_touch_roas"] == 0.45 and got["A"]["last_touch_roi"] == -0.95
    assert got["Z"]["first_touch_roas"] is None and got["Z"]["first_touch_roi"] is None
    assert got["N"]["first_touch_roi"] == -1.0 and got["N"]["last_touch_customers"] == 0
    assert got["A"]["start_date_key"] == 20240101 and got["A"]["end_date_key"] is None


@pytest.mark.parametrize("rows", [0, SKEW.broadcast_rows], ids=["shuffled", "broadcast"])
def test_content_is_the_same_on_both_routes(spark, rows):
    content = spark.sql("""
      SELECT * FROM VALUES
        ('blog', 's', DATE'2024-01-01', 10L, 1L), ('blog', 's', DATE'2024-01-31', 20L, 2L),
        ('blog', 's', DATE'2024-02-10', 5L, 0L), ('blog', NULL, DATE'2024-01-05', 0L, 0L),
        (NULL, 's', DATE'2024-01-05', 7L, 7L), ('blog', 's', NULL, 3L, 1L),
        ('podcast', 's', DATE'2024-01-05', 9L, 3L)
      AS t(channel, utm_campaign, publish_date, views, clicks)""")
    campaigns = spark.sql("""
      SELECT 'A' AS campaign_id, 's' AS campaign_slug, 'blog' AS channel,
             DATE'2024-01-01' AS start_date, DATE'2024-01-31' AS end_date""")
    config = replace(SKEW, broadcast_rows=rows, hot_share=0.1, salts=3)
    got = facts.fct_content_performance(content, campaigns, config).collect()
    assert len({r["content_performance_key"] for r in got}) == len(got) == 6
    table = {(r["publish_month_date_key"], r["channel"], r["campaign_id"]): r for r in got}
    assert table[20240101, "blog", "A"]["content_count"] == 2
    assert table[20240101, "blog", "A"]["click_through_rate"] == 0.1
    assert table[20240101, "blog", None]["click_through_rate"] is None
    assert table[20240201, "blog", None]["views"] == 5
    assert table[None, "blog", None]["content_count"] == 1
    assert table[20240101, None, None]["clicks"] == 7


def test_channel_performance_zero_fills(spark, cells):
    channels = spark.sql(
        "SELECT k AS channel_key, k AS channel_name, 'other' AS channel_group "
        "FROM VALUES ('blog'), ('quiet') AS t(k)")
    content = spark.sql("SELECT 'blog' AS channel, 2L AS content_count, 10L AS views, 4L AS clicks")
    campaigns = spark.sql("SELECT 'blog' AS channel, CAST(9 AS DECIMAL(18,2)) AS budget_usd")
    got = by(summaries.channel_performance(channels, cells, content, campaigns), "channel_key")
    quiet = got["quiet"]
    assert quiet["click_through_rate"] is None
    assert all(quiet[c] == 0 for c in quiet.asDict() if c not in (
        "channel_key", "channel_name", "channel_group", "click_through_rate"))
    assert got["blog"]["click_through_rate"] == 0.4 and got["blog"]["campaign_budget_usd"] == 9


def test_company_analysis_share_and_unsold_company(spark, cells):
    companies = spark.sql(
        "SELECT k AS company_id, k AS company_name, k AS industry "
        "FROM VALUES ('C1'), ('C2'), ('C9'), (NULL) AS t(k)")
    metrics = summaries.company_metrics(cells)
    got = by(summaries.company_revenue_analysis(companies, metrics), "company_id")
    assert set(got) == {"C1", "C2", "C9", None}
    assert got["C1"]["total_revenue"] == 43 and got["C1"]["customer_count"] == 2
    assert got["C1"]["recurring_revenue"] == 33 and got["C1"]["initial_revenue"] == 10
    assert got["C1"]["revenue_record_count"] == 5
    assert got["C1"]["first_touch_channel_count"] == 2
    assert got["C1"]["last_touch_channel_count"] == 3
    assert got["C1"]["first_touch_campaign_revenue"] == 40
    assert got["C1"]["average_revenue_per_customer"] == 21.5
    assert got["C1"]["portfolio_revenue_share"] == round(43 / 48, 6)
    assert got["C2"]["recurring_revenue"] == 0 and got["C2"]["initial_revenue"] == 0
    assert got["C9"]["average_revenue_per_customer"] is None
    assert got["C9"]["portfolio_revenue_share"] == 0.0


def test_months_compare_with_the_previous_observed_month(cells, dates):
    got = by(summaries.monthly_revenue_customer_growth(cells, dates), "month_key")
    assert set(got) == {202401, 202403}
    january, march = got[202401], got[202403]
    assert january["revenue_change"] is None and january["new_customers"] == 1
    assert march["total_revenue"] == 40 and march["revenue_change"] == 30
    assert march["revenue_growth_rate"] == 3.0
    assert march["active_customers"] == 3 and march["new_customers"] == 1
    assert march["customer_change"] == 2 and march["month_date_key"] == 20240301


def test_calendar(spark, dates):
    got = by(dates, "date_key")
    assert len(got) == 91
    sunday = got[20240303]
    assert (sunday["iso_day_of_week"], sunday["is_weekend"]) == (7, True)
    assert str(sunday["week_start_date"]) == "2024-02-26"
    assert (sunday["month_name"], sunday["quarter_number"]) == ("March", 1)


def test_dimensions_hold_every_observed_key(spark):
    campaigns = spark.sql("SELECT 'blog' AS channel, 'CTC-001' AS target_company_id "
                          "UNION ALL SELECT NULL, NULL")
    content = spark.sql("SELECT 'tik_tok' AS channel")
    touches = spark.sql("SELECT 'x' AS first_touch_resolved_channel, "
                        "'word_of_mouth' AS last_touch_resolved_channel")
    got = by(dimensions.dim_channel(campaigns, content, touches), "channel_key")
    assert set(got) == {"blog", "tik_tok", "x", "word_of_mouth", "unknown"}
    assert (got["tik_tok"]["channel_name"], got["tik_tok"]["channel_group"]) == ("tik tok", "other")
    assert got["word_of_mouth"]["channel_name"] == "Word of Mouth"
    revenue = spark.sql("SELECT CAST(NULL AS STRING) AS company_id")
    signups = spark.sql("SELECT 'NEW' AS company_id")
    companies = by(dimensions.dim_company(campaigns, revenue, signups), "company_id")
    assert set(companies) == {"CTC-001", "NEW", None}
    assert companies["NEW"]["company_name"] is None
    assert companies["CTC-001"]["industry"] == "Home Services"


def test_campaign_performance_drops_unknown_channels_and_dates(spark, cells, dates):
    roi = spark.sql("""
      SELECT id AS campaign_id, ch AS channel, co AS target_company_id, s AS start_date_key,
             20240131 AS end_date_key, CAST(9 AS DECIMAL(18,2)) AS budget_usd,
             CAST(2 AS DECIMAL(18,2)) AS first_touch_attributed_revenue,
             CAST(5 AS DECIMAL(18,2)) AS last_touch_attributed_revenue,
             0L AS first_touch_customers, 2L AS last_touch_customers,
             0D AS first_touch_roas, 0D AS last_touch_roas, 0D AS first_touch_roi, 0D AS last_touch_roi
      FROM VALUES ('ok', 'blog', NULL, 20240101), ('no_channel', 'other', 'C1', 20240101),
                  ('no_date', 'blog', 'C1', 20231231) AS t(id, ch, co, s)""")
    channels = spark.sql("SELECT 'blog' AS channel_key, 'Blog' AS channel_name")
    companies = spark.sql("SELECT 'C1' AS company_id, 'One' AS company_name")
    (row,) = summaries.campaign_performance(roi, channels, companies, dates).collect()
    assert row["campaign_id"] == "ok" and row["target_company_name"] is None
    assert row["first_touch_cost_per_customer"] is None
    assert row["last_touch_cost_per_customer"] == 4.5
    assert row["attribution_revenue_difference"] == 3


def test_summaries_are_the_same_when_lookups_are_too_large_to_broadcast(cells, dates):
    shuffled = replace(SKEW, broadcast_rows=0, hot_share=0.1, salts=3)
    small = summaries.monthly_revenue_customer_growth(cells, dates).collect()
    large = summaries.monthly_revenue_customer_growth(cells, dates, shuffled).collect()
    assert sorted(map(str, small)) == sorted(map(str, large))
