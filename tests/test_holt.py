"""Additive-trend smoothing against direct recursions and a dense search."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.config import FORECAST
from touchtrail.operators import holt
from touchtrail.plans import pipeline, registry
from touchtrail.plans.models import TABLES, Models

NOISY = [112, 118, 132, 129, 121, 135, 148, 148, 136, 119, 104, 118, 115, 126, 141, 135, 125, 149]
STEP = [10, 11, 12, 13, 14, 15, 40, 41, 42, 43, 44, 45, 46, 47]
JUMPY = [5, 9, 4, 12, 3, 15, 2, 18, 1, 21]


def history(spark, **series):
    rows = [(k, dt.date(2020 + i // 12, i % 12 + 1, 1), float(v))
            for k, values in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, m date, v double").repartition(5)
    return holt.build_series(df, "k", "m", "v")


def direct_sse(y, alpha, beta, l0, b0):
    level, trend, sse = l0, b0, 0.0
    for v in y:
        p = level + trend
        sse += (v - p) ** 2
        new = alpha * v + (1 - alpha) * p
        trend = beta * (new - level) + (1 - beta) * trend
        level = new
    return sse


def best_start_sse(y, alpha, beta):
    """Least squares over the start by three direct runs of the linear error map."""
    def errors(l0, b0, data):
        level, trend, out = l0, b0, []
        for v in data:
            p = level + trend
            out.append(v - p)
            new = alpha * v + (1 - alpha) * p
            trend = beta * (new - level) + (1 - beta) * trend
            level = new
        return np.array(out)

    zero = np.zeros(len(y))
    e, u, v = errors(0, 0, y), errors(1, 0, zero), errors(0, 1, zero)
    solution, *_ = np.linalg.lstsq(np.column_stack([u, v]), -e, rcond=None)
    return float(np.sum((e + solution[0] * u + solution[1] * v) ** 2))


def test_fit_is_no_worse_than_a_dense_search(spark):
    series = {"noisy": NOISY, "step": STEP, "jumpy": JUMPY}
    fitted = {r["series_key"]: r["fit"] for r in holt.fit(history(spark, **series)).collect()}
    for key, y in series.items():
        f = fitted[key]
        assert 0 <= f["beta"] <= f["alpha"] <= 1
        direct = direct_sse(y, f["alpha"], f["beta"], f["l0"], f["b0"])
        assert f["sse"] == pytest.approx(direct, rel=1e-6, abs=1e-6)
        grid = (a / 50 for a in range(51))
        dense = min(best_start_sse(y, a, b / 50) for a in grid for b in range(int(a * 50) + 1))
        assert f["sse"] <= dense * (1 + 1e-6)


def test_a_line_is_continued_exactly(spark):
    y = [100 + 7 * i for i in range(12)]
    fitted = holt.fit_and_smooth(history(spark, line=y, flat=[3] * 9))
    got = sorted(holt.forecast(fitted).where("series_key = 'line'").collect(), key=lambda r: r["month"])
    assert [r["predicted_revenue"] for r in got] == [100.0 + 7 * i for i in range(12, 18)]
    assert [str(r["month"]) for r in got] == [f"2021-0{i}-01" for i in range(1, 7)]
    assert all(r["lower_bound"] == r["upper_bound"] == r["predicted_revenue"] for r in got)
    metrics = {r["series_key"]: r for r in holt.holdout_metrics(fitted).collect()}
    assert metrics["line"]["mae"] == 0 and metrics["line"]["r2_score"] == 1
    assert metrics["line"]["slope"] == 7 and metrics["line"]["intercept"] == 177
    assert math.isnan(metrics["flat"]["r2_score"]) and metrics["flat"]["rmse"] == 0


def test_results_agree_with_the_fitted_parameters(spark):
    fitted = holt.fit_and_smooth(history(spark, noisy=NOISY))
    f = fitted.first()["fit"]
    level, trend, predicted = f["l0"], f["b0"], []
    for v in NOISY:
        p = level + trend
        predicted.append(p)
        new = f["alpha"] * v + (1 - f["alpha"]) * p
        trend = f["beta"] * (new - level) + (1 - f["beta"]) * trend
        level = new
    residuals = np.array(NOISY) - predicted
    rows = sorted(holt.comparison(fitted).collect(), key=lambda r: r["month"])
    assert len(rows) == 18
    assert [r["predicted_revenue"] for r in rows] == pytest.approx(np.round(predicted, 2), abs=0.011)
    assert all(r["prediction_error"] == pytest.approx(r["actual_revenue"] - r["predicted_revenue"], abs=0.006)
               for r in rows)
    steps = sorted(holt.forecast(fitted).collect(), key=lambda r: r["month"])
    margin = 1.96 * residuals.std(ddof=1)
    for i, r in enumerate(steps, start=1):
        assert r["predicted_revenue"] == pytest.approx(level + i * trend, abs=0.011)
        assert r["upper_bound"] - r["lower_bound"] == pytest.approx(2 * margin, abs=0.03)
        assert r["model_name"] == "holt_exponential_smoothing"
    (m,) = holt.holdout_metrics(fitted).collect()
    assert (m["train_months"], m["holdout_months"]) == (15, 3)
    assert m["residual_std"] == pytest.approx(residuals.std(ddof=1), abs=1e-3)
    (train,) = holt.fit_and_smooth(history(spark, noisy=NOISY[:-3])).collect()
    future = [train["run"]["level"] + i * train["run"]["trend"] for i in (1, 2, 3)]
    errors = np.array(NOISY[-3:]) - future
    assert m["mae"] == pytest.approx(np.abs(errors).mean(), abs=1e-3)
    assert m["rmse"] == pytest.approx(np.sqrt((errors**2).mean()), abs=1e-3)


def test_short_gapped_and_repeated_series_are_reported(spark):
    series = history(spark, five=[1] * 5, six=[1, 2, 3, 4, 5, 7])
    rows = [("gap", dt.date(2020, m, 1), 1.0) for m in (1, 2, 3, 5, 6, 7, 8)]
    rows += [("twice", dt.date(2020, m, 1), 1.0) for m in (1, 2, 2, 3, 4, 5, 6)]
    other = holt.build_series(spark.createDataFrame(rows, "k string, m date, v double"), "k", "m", "v")
    status = {r["series_key"]: r["status"]
              for r in holt.series_status(series.unionByName(other)).collect()}
    assert status == {"five": "too_short", "six": "ok", "gap": "irregular", "twice": "irregular"}
    assert holt.fit_and_smooth(series).count() == 1


def test_every_series_is_reported(spark):
    series = history(spark, five=[1] * 5, six=[1, 2, 3, 4, 5, 7])
    rows = {r["series_key"]: r for r in holt.series_report(series).collect()}
    assert (rows["five"]["months"], rows["five"]["status"]) == (5, "too_short")
    assert (str(rows["six"]["first_month"]), str(rows["six"]["last_month"])) == ("2020-01-01", "2020-06-01")
    assert rows["six"]["status"] == "ok"


@pytest.mark.parametrize(
    "table", ["channel_performance", "monthly_revenue_customer_growth", "fct_attributed_revenue"]
)
def test_empty_inputs_raise(spark, sf_dir, table):
    full = registry.stored(spark, sf_dir)
    tables = Models(full.raw, lambda name, df: df)
    for name in TABLES:
        setattr(tables, name, getattr(full, name))
    setattr(tables, table, getattr(full, table).limit(0))
    with pytest.raises(ValueError, match="No rows"):
        pipeline.store_anomalies(tables)
    if table == "monthly_revenue_customer_growth":
        with pytest.raises(ValueError, match="No rows"):
            pipeline.store_forecast(tables)


def test_long_series_take_linear_time(spark):
    def seconds(n):
        y = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (i % 7).cast("double"))
        rows = spark.range(1).select(F.lit("k").alias("series_key"), y.alias("y"))
        started = time.perf_counter()
        holt.smooth_fixed(rows, 0.5, 0.2).select("sse").collect()
        rows.select(holt._sample_std(F.col("y"))).collect()
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(64_000) < 5


def test_fixed_parameters_follow_the_recursion(spark):
    (row,) = holt.smooth_fixed(history(spark, jumpy=JUMPY), 0.5, 0.2).collect()
    assert row["sse"] == pytest.approx(direct_sse(JUMPY, 0.5, 0.2, 5, 4))


def test_many_series_are_independent(spark):
    rng = np.random.default_rng(1)
    data = {f"s{i}": list(np.cumsum(rng.normal(size=8 + i % 5)) + 50) for i in range(40)}
    together = {r["series_key"]: r["fit"]["sse"] for r in holt.fit(history(spark, **data)).collect()}
    for key in itertools.islice(data, 0, None, 13):
        (alone,) = holt.fit(history(spark, **{key: data[key]})).collect()
        assert alone["fit"]["sse"] == together[key]


def test_stored_portfolio_forecast(spark, sf_dir):
    tables = registry.stored(spark, sf_dir)
    got = pipeline.store_forecast(tables)
    forecast = got["revenue_forecast"]
    assert forecast.count() == FORECAST.horizon == 6
    assert forecast.where("predicted_revenue IS NULL").count() == 0
    seen = tables.monthly_revenue_customer_growth.selectExpr("month_start_date AS month")
    assert forecast.join(seen, "month", "left_semi").count() == 0
    assert got["forecast_metrics"].count() == 1
    assert got["forecast_comparison"].count() == seen.count()
    assert got["forecast_comparison"].where(
        "predicted_revenue IS NULL OR prediction_error IS NULL").count() == 0
    assert {r[0] for r in forecast.select("model_name").distinct().collect()} == {
        "holt_exponential_smoothing"}


# -- the store of fits ---------------------------------------------------------------


def _series(spark, rows):
    df = spark.createDataFrame(rows, "series_key string, y array<double>")
    return df.selectExpr("series_key", "transform(sequence(0, size(y) - 1), i -> add_months(date'2001-01-01', i)) AS months", "y")


def test_only_unknown_series_are_searched(spark, tmp_path, monkeypatch):
    rows = [(f"s{i}", [float((i * 7 + k * k) % 13 + k) for k in range(12)]) for i in range(5)]
    path = str(tmp_path / "fits")
    searched = []
    original = holt.fit

    def counting(series, values="y", config=holt.FORECAST):
        searched.append(series.count())
        return original(series, values, config)

    monkeypatch.setattr(holt, "fit", counting)
    plain = {r["series_key"]: r["fit"] for r in original(_series(spark, rows)).collect()}
    for change, expected in ((None, 5), (None, 0), (2, 1), (None, 0)):
        if change is not None:
            rows[change] = ("s2", rows[change][1][::-1])
            plain["s2"] = original(_series(spark, rows[change:change + 1])).first()["fit"]
        searched.append(0)
        found = holt.fit_stored(_series(spark, rows), path)
        assert {r["series_key"]: r["fit"] for r in found.collect()} == plain
        assert searched[-1] == expected
    # A copy under another key, and another setting.
    searched.append(0)
    holt.fit_stored(_series(spark, [("copy", rows[0][1])]), path)
    assert searched[-1] == 0
    from dataclasses import replace
    holt.fit_stored(_series(spark, rows), path, config=replace(holt.FORECAST, grid_steps=10))
    assert searched[-1] == 5


def test_results_do_not_depend_on_the_store(spark, tmp_path):
    rows = [(f"s{i}", [float((i * 5 + k * 3) % 17 + 2 * k) for k in range(10 + i)]) for i in range(4)]
    path = str(tmp_path / "fits")
    series = _series(spark, rows)
    plain, known = holt.fit_and_smooth(series), holt.fit_and_smooth(series, store=path)
    for result in (holt.forecast, holt.comparison):
        assert sorted(map(tuple, result(known).collect())) == sorted(map(tuple, result(plain).collect()))
    assert sorted(map(tuple, holt.holdout_metrics(known, store=path).collect())) == sorted(
        map(tuple, holt.holdout_metrics(plain).collect()))


def test_store_of_no_series(spark, tmp_path):
    path = str(tmp_path / "fits")
    assert holt.fit_stored(_series(spark, [("s", [1.0] * 9)]).limit(0), path).count() == 0
