"""Customer cells against the reads of revenue records."""

from __future__ import annotations

import datetime
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import audience, drilldown
from touchtrail.plans import registry
from touchtrail.sources.store import materialize

COMPANIES = ("CTC-001", "CTC-003")
CHANNELS = ("youtube", "organic")
SUBSETS = [s for n in range(3) for s in combinations((0, 1), n)]


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return registry.stored(spark, sf_dir)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("channels", SUBSETS)
@pytest.mark.parametrize("companies", SUBSETS)
def test_every_subset_reads_as_the_records_do(tables, companies, channels):
    chosen = [COMPANIES[i] for i in companies], [CHANNELS[i] for i in channels]
    cells, detail = tables.audience_cells, tables.detail
    summary, monthly = tables.channel_performance, tables.monthly_revenue_customer_growth
    assert rows(audience.channel_performance(summary, cells, *chosen)) == rows(
        drilldown.channel_performance(summary, detail, *chosen))
    assert rows(audience.monthly_revenue(monthly, cells, *chosen)) == rows(
        drilldown.monthly_revenue(monthly, detail, *chosen))
    horizon = detail.sparkSession.range(6)
    shared = (tables.campaign_performance, summary)
    assert rows(audience.kpi_overview(cells, *shared, 6, *chosen)) == rows(
        drilldown.kpi_overview(detail, *shared, horizon, *chosen))


def test_reads_scan_the_cells_alone(tables):
    read = audience.monthly_revenue(None, tables.audience_cells, COMPANIES, CHANNELS)
    files = {f.rsplit("/", 2)[-2].split("-")[0] for f in read.inputFiles()}
    assert files == {"audience_cells"}


DETAIL = (
    "user_id string, company_id string, revenue_month date, first_touch_channel string, "
    "last_touch_channel string, revenue_amount decimal(18,2)"
)


def detail_rows(n):
    """Users over several months and channels, a heavy user, and records of nobody."""
    months = [datetime.date(2001, m, 1) for m in (1, 2, 3)]
    found = []
    for i in range(n):
        user = None if i % 17 == 0 else f"u{i * i % 701}" if i % 3 else "heavy"
        channel = (None, "blog", "podcast", "organic")[i % 4]
        found.append((user, f"C{i % 5}", months[i * 7 % 3], channel, ("blog", "organic")[i % 2], Decimal(i % 90)))
    return found


def test_numbers_are_distinct_and_survive_growth(spark):
    detail = spark.createDataFrame(detail_rows(900), DETAIL).repartition(4)
    first = materialize(audience.number_users(detail.where("revenue_month < '2001-03-01'")), "numbers")
    second = materialize(audience.number_users(detail, first), "numbers")
    users = detail.select("user_id").dropna().distinct().count()
    assert second.count() == second.select("user_number").distinct().count() == users
    assert second.join(first, ["user_id", "user_number"], "left_semi").count() == first.count()


def test_merged_loads_equal_one_load(spark):
    detail = spark.createDataFrame(detail_rows(900), DETAIL).repartition(4)
    numbers = materialize(audience.number_users(detail), "numbers")
    whole = audience.audience_cells(detail, numbers)
    parts = [
        audience.audience_cells(detail.where(f"pmod(hash(user_id, revenue_amount), 3) = {i}"), numbers)
        for i in range(3)
    ]
    merged = audience.merged_cells(*parts)
    assert rows(merged.withColumn("customers", F.hex("customers"))) == rows(
        whole.withColumn("customers", F.hex("customers")))


@pytest.mark.parametrize("keys", [(), ("revenue_month",), ("company_id", "first_touch_channel")])
def test_totals_count_distinct_users(spark, keys):
    detail = spark.createDataFrame(detail_rows(1200), DETAIL).repartition(4)
    numbers = materialize(audience.number_users(detail), "numbers")
    found = audience.totals(audience.audience_cells(detail, numbers), *keys)
    expected = detail.groupBy(*keys).agg(
        F.sum("revenue_amount").alias("revenue"),
        F.countDistinct("user_id").alias("customers"),
        F.count(F.lit(1)).alias("records"),
    )
    assert rows(found) == rows(expected)


def test_numbers_spread_over_many_ranges(spark):
    """The same counts when every user stands in a range of its own."""
    detail = spark.createDataFrame(detail_rows(600), DETAIL)
    numbers = materialize(audience.number_users(detail), "numbers")
    apart = numbers.withColumn("user_number", F.col("user_number") * 32_768 + 32_767)
    for sparse in (numbers, apart):
        cells = audience.audience_cells(detail, sparse)
        assert audience.totals(cells).first()["customers"] == numbers.count()


def test_new_customers(spark):
    detail = spark.createDataFrame(detail_rows(600), DETAIL)
    numbers = materialize(audience.number_users(detail), "numbers")
    found = {r["month"]: (r["customers"], r["new_customers"])
             for r in audience.new_customers(audience.audience_cells(detail, numbers)).collect()}
    seen, expected = set(), {}
    for month in sorted({r[2] for r in detail_rows(600)}):
        users = {r[0] for r in detail_rows(600) if r[2] == month and r[0]}
        expected[month] = (len(users), len(users - seen))
        seen |= users
    assert found == expected


def test_empty_detail(spark):
    detail = spark.createDataFrame([], DETAIL)
    cells = audience.audience_cells(detail, audience.number_users(detail))
    assert audience.totals(cells).first()["customers"] == 0
    assert audience.totals(cells, "company_id").count() == 0
    assert rows(audience.every_selection(cells, [((), ())])) == [(0, 0, 0, 0)]
