"""The calendar's horizon, its bounds and its days."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from touchtrail.config import CalendarConfig
from touchtrail.operators import dimensions
from touchtrail.plans import registry


def sources(spark, content=(), signups=(), revenue=(), campaigns=()):
    def table(schema, rows):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)

    return (
        table("start_date date, end_date date", campaigns), table("publish_date date", content),
        table("revenue_month date", revenue), table("signup_date date", signups),
    )


D = datetime.date


@pytest.mark.parametrize("first, last", [
    (D(2000, 2, 28), D(2000, 3, 1)), (D(1999, 12, 31), D(2001, 1, 1)), (D(2001, 5, 5), D(2001, 5, 5)),
])
def test_every_day_between_the_bounds_once(spark, first, last):
    bounds = dimensions.date_bounds(*sources(spark, content=[last, None], signups=[first]))
    days = sorted(r["date_day"] for r in dimensions.dim_time(bounds).collect())
    assert days == [first + datetime.timedelta(i) for i in range((last - first).days + 1)]


def test_impossible_dates_are_reported_and_stretch_nothing(spark):
    tables = sources(
        spark, content=[D(2000, 1, 5), D(9999, 12, 31)], revenue=[D(2000, 3, 1), D(1, 1, 1)],
        campaigns=[(D(2000, 2, 1), D(9999, 12, 31)), (D(2000, 2, 2), None)])
    bounds = dimensions.date_bounds(*tables)
    assert tuple(bounds.first()) == (D(2000, 1, 5), D(2000, 3, 1))
    assert dimensions.dim_time(bounds).count() == 57
    found = {tuple(r) for r in dimensions.dates_beyond_horizon(*tables).collect()}
    assert found == {
        ("content", "publish_date", D(9999, 12, 1), 1), ("campaigns", "end_date", D(9999, 12, 1), 1),
        ("revenue", "revenue_month", D(1, 1, 1), 1)}


def test_horizon_is_a_setting(spark):
    tables = sources(spark, content=[D(1850, 1, 1), D(2000, 1, 5)])
    wide = CalendarConfig("1800-01-01", "2199-12-31")
    assert dimensions.date_bounds(*tables, wide).first()["first_day"] == D(1850, 1, 1)
    assert dimensions.dates_beyond_horizon(*tables, wide).count() == 0


def test_no_dates_no_days(spark):
    bounds = dimensions.date_bounds(*sources(spark, content=[None]))
    assert dimensions.dim_time(bounds).count() == 0
    only_beyond = dimensions.date_bounds(*sources(spark, content=[D(9999, 1, 1)]))
    assert dimensions.dim_time(only_beyond).count() == 0


def test_an_outlier_in_the_data_leaves_the_dimension_as_it_is(spark, sf_dir):
    usual = registry.stored(spark, sf_dir).dim_time
    stretched = registry.calendar_with_outliers(spark, sf_dir)
    assert stretched.count() == usual.count() < 5000
    report = registry.dates_beyond_horizon(spark, sf_dir)
    assert report.agg(F.sum("rows")).first()[0] > 0
