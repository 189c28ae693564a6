"""Parameterised reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import drilldown
from touchtrail.plans import registry


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return registry.all_tables(spark, sf_dir)


@pytest.fixture(scope="module")
def detail(tables):
    return drilldown.revenue_detail(
        tables["fct_attributed_revenue"], tables["dim_company"], tables["dim_time"])


def test_empty_selection_means_all(tables, detail):
    summary = tables["channel_performance"]
    for empty in (None, [], ()):
        assert drilldown.channel_performance(summary, detail, empty, empty).columns == summary.columns
        companies = tables["company_revenue_analysis"]
        assert drilldown.company_analysis(companies, empty).count() == companies.count() > 4
        monthly = drilldown.monthly_revenue(
            tables["monthly_revenue_customer_growth"], detail, empty, empty)
        assert "new_customers" in monthly.columns


def test_company_selection_reaggregates_and_keeps_every_channel(tables, detail):
    summary = tables["channel_performance"]
    got = drilldown.channel_performance(summary, detail, ["CTC-001"])
    assert got.count() == summary.count()
    assert "first_touch_revenue_records" not in got.columns and "content_count" not in got.columns
    ours = got.agg(F.sum("last_touch_revenue")).first()[0]
    # Records of users without a journey have no channel.
    touched = detail.where("company_id = 'CTC-001' AND last_touch_channel IS NOT NULL")
    assert ours == touched.agg(F.sum("revenue_amount")).first()[0]
    everyone = drilldown.channel_performance(summary, detail, ["CTC-001", "CTC-002", "CTC-003", "CTC-004"])
    pairs = everyone.join(summary.select("channel_key", F.col("last_touch_customers").alias("n")), "channel_key")
    assert pairs.where("n <> last_touch_customers").count() == 0


def test_month_selection_uses_first_or_last_channel(tables, detail):
    got = drilldown.monthly_revenue(
        tables["monthly_revenue_customer_growth"], detail, None, ["youtube"])
    assert got.columns == ["month", "total_revenue", "active_customers"]
    expected = detail.where("first_touch_channel = 'youtube' OR last_touch_channel = 'youtube'")
    assert got.agg(F.sum("total_revenue")).first()[0] == expected.agg(F.sum("revenue_amount")).first()[0]


def test_campaigns_open_to_all_stay(tables):
    got = drilldown.campaign_performance(tables["campaign_performance"], ["CTC-002"])
    targets = {r[0] for r in got.select("target_company_id").distinct().collect()}
    assert targets == {None, "CTC-002"}


def test_top_campaigns(tables):
    campaigns = tables["campaign_performance"]
    for measure in drilldown.CAMPAIGN_MEASURES:
        top = drilldown.top_campaigns(campaigns, measure).collect()
        assert len(top) == 15
        values = [r[measure] for r in top]
        assert values == sorted(values, reverse=True)
        assert values[0] == campaigns.agg(F.max(measure)).first()[0]
    with pytest.raises(ValueError, match="Unknown measure"):
        drilldown.top_campaigns(campaigns, "campaign_id")


def test_kpis_without_matching_rows(tables, detail):
    forecast = tables["dim_time"].limit(6)
    row = drilldown.kpi_overview(
        detail, tables["campaign_performance"], tables["channel_performance"], forecast,
        ["NOBODY"], ["nothing"]).first()
    assert tuple(row) == (0.0, 0, 0, 0, 6)


def test_comparison_and_long_form(spark):
    channels = spark.sql("SELECT 'a' AS channel_key, 'A' AS channel_name, 10 AS first_touch_revenue, "
                         "15 AS last_touch_revenue UNION ALL SELECT 'b', 'B', 0, 5")
    got = {r["channel_key"]: r for r in drilldown.attribution_comparison(channels).collect()}
    assert got["a"]["difference"] == 5 and got["a"]["pct_difference"] == 0.5
    assert got["b"]["pct_difference"] is None
    long = {(r[0], r[1]): r[2] for r in drilldown.attribution_long(channels).collect()}
    assert long == {("A", "First Touch"): 10, ("A", "Last Touch"): 15,
                    ("B", "First Touch"): 0, ("B", "Last Touch"): 5}


ANOMALIES = """
  SELECT ch AS channel, DATE'2024-01-01' AS month_start_date, z AS z_score, f AS is_anomaly,
         r AS anomaly_rank, 1D AS monthly_revenue
  FROM VALUES ('blog', 4D, true, 2), ('blog', CAST(NULL AS DOUBLE), false, NULL),
              ('new_one', -9D, true, 1), ('podcast', 1D, false, NULL), ('Unknown', 9D, true, 3)
  AS t(ch, z, f, r)"""


def test_anomaly_list_and_trend(spark):
    channels = spark.sql("SELECT 'blog' AS channel_key, 'Blog' AS channel_name "
                         "UNION ALL SELECT 'podcast', 'Podcast'")
    named = drilldown.named_anomalies(spark.sql(ANOMALIES), channels)
    assert named.count() == 4
    rows = drilldown.strongest_first(drilldown.anomaly_list(named, show_all=True)).collect()
    assert [r["channel_name"] for r in rows] == ["new_one", "Blog", "Podcast", "Blog"]
    assert drilldown.anomaly_list(named).count() == 2
    assert drilldown.anomaly_list(named, ["blog"]).count() == 1
    assert drilldown.anomaly_list(named, None, ["Podcast"], show_all=True).count() == 1
    trend = {r[0] for r in drilldown.anomaly_trend(named).select("channel_name").distinct().collect()}
    assert trend == {"Blog", "new_one"}
    assert tuple(drilldown.anomaly_kpis(named).first()) == (3, 1, 2)


def test_formatted(spark):
    df = spark.sql("SELECT 1234.5D AS m, 0.125D AS p UNION ALL SELECT NULL, NULL")
    got = {tuple(r) for r in drilldown.formatted(df, ["m"], ["p"]).collect()}
    assert got == {("$1,234", "12.5%"), ("—", "—")}


def test_history_plus_forecast(spark):
    monthly = spark.sql("SELECT DATE'2024-01-01' AS month, CAST(5 AS DECIMAL(18,2)) AS total_revenue")
    forecast = spark.sql("SELECT DATE'2024-02-01' AS month, 6D AS predicted_revenue")
    got = {(r["series"], r["revenue"]) for r in drilldown.history_plus_forecast(monthly, forecast).collect()}
    assert got == {("Historical", 5.0), ("Forecast", 6.0)}
