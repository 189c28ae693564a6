"""Additive-trend exponential smoothing of many monthly series at once.

State per month: level ``l``, trend ``b``; smoothing ``alpha``, ``beta``::

    prediction  p = l + b
    l' = alpha * y + (1 - alpha) * p
    b' = beta * (l' - l) + (1 - beta) * b

For given (alpha, beta) the errors are linear in the starting (l0, b0), so the
best start is a 2x2 least-squares solution. Only (alpha, beta) is searched: a
grid over 0 <= beta <= alpha <= 1, then finer grids around the best point.

A series is one row holding its sorted months (bounded by the calendar), so
series are independent rows dealt over the cluster. The search itself is the only
Python step: as nested array lambdas it took about fifty microseconds per
candidate and month, as numpy vectors over all candidates it takes nanoseconds.
Everything else is column expressions.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.config import FORECAST, ForecastConfig
from touchtrail.sources import files


def _d(x: float) -> Column:
    return F.lit(float(x))


# -- series --------------------------------------------------------------------


def build_series(history: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """One row per key: ``months`` sorted, ``y`` their values in that order."""
    packed = history.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(month).alias("m"),
                                             F.col(value).cast("double").alias("v")))).alias("_p")
    )
    return packed.select(
        F.col(key).alias("series_key"),
        F.col("_p.m").alias("months"),
        F.col("_p.v").alias("y"),
    )


def series_status(series: DataFrame, config: ForecastConfig = FORECAST) -> DataFrame:
    """Add ``status``: ok, too_short, or irregular (a month is missing or repeated)."""
    n = F.size("months")
    span = F.months_between(F.element_at("months", -1), F.element_at("months", 1)) + 1
    distinct = F.size(F.array_distinct("months"))
    return series.withColumn(
        "status",
        F.when(n < config.minimum_history, "too_short")
        .when((span != n) | (distinct != n), "irregular")
        .otherwise("ok"),
    )


def series_report(series: DataFrame, config: ForecastConfig = FORECAST) -> DataFrame:
    """One row per series, fitted or not: months, first and last month, status."""
    return series_status(series, config).select(
        "series_key",
        F.size("months").alias("months"),
        F.element_at("months", 1).alias("first_month"),
        F.element_at("months", -1).alias("last_month"),
        "status",
    )


def usable_series(series: DataFrame, config: ForecastConfig = FORECAST) -> DataFrame:
    return series_status(series, config).where(F.col("status") == "ok").drop("status")


# -- fit -------------------------------------------------------------------------


def _best_start(y: np.ndarray, alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """(sse, alpha, beta, l0, b0) per candidate, one column each.

    Three recursions run side by side for all candidates: the data from a zero
    state, and the responses to a unit level and a unit trend.
    """
    level = np.zeros((3, alpha.size))
    trend = np.zeros((3, alpha.size))
    level[1] = 1.0
    trend[2] = 1.0
    sums = np.zeros((3, 3, alpha.size))
    for value in y:
        predicted = level + trend
        error = -predicted
        error[0] += value
        moved = (1.0 - alpha) * predicted
        moved[0] += alpha * value
        trend = beta * (moved - level) + (1.0 - beta) * trend
        level = moved
        sums += error[:, None] * error[None, :]
    ee, eu, ev = sums[0]
    uu, uv, vv = sums[1, 1], sums[1, 2], sums[2, 2]
    det = uu * vv - uv * uv
    singular = det <= uu * vv * 1e-12
    safe = np.where(singular, 1.0, det)
    l0 = np.where(singular, y[0], (uv * ev - vv * eu) / safe)
    b0 = np.where(singular, y[1] - y[0], (uv * eu - uu * ev) / safe)
    sse = ee + 2 * (l0 * eu + b0 * ev) + l0 * l0 * uu + 2 * l0 * b0 * uv + b0 * b0 * vv
    return np.vstack([np.maximum(sse, 0.0), alpha, beta, l0, b0])


def _search(y: np.ndarray, config: ForecastConfig) -> np.ndarray:
    """Coarse triangular grid, then finer grids around the best candidate."""
    i, j = np.meshgrid(np.arange(config.grid_steps + 1), np.arange(config.grid_steps + 1))
    inside = j <= i
    alpha, beta = i[inside] / config.grid_steps, j[inside] / config.grid_steps
    step, half = 1.0 / config.grid_steps, config.zoom_half_width
    offsets = np.arange(-half, half + 1)
    best = None
    for _ in range(config.zoom_rounds + 1):
        scored = _best_start(y, alpha, beta)
        if best is not None:
            scored = np.column_stack([best, scored])
        best = scored[:, scored[0].argmin()]
        step /= half
        da, db = np.meshgrid(offsets * step, offsets * step)
        alpha = np.clip(best[1] + da.ravel(), 0.0, 1.0)
        beta = np.minimum(np.clip(best[2] + db.ravel(), 0.0, 1.0), alpha)
    return best


def _run(y: np.ndarray, alpha: float, beta: float, level: float, trend: float):
    """Final level and trend, and the prediction of every month."""
    fitted = np.empty(len(y))
    for i, value in enumerate(y.tolist()):
        fitted[i] = predicted = level + trend
        moved = alpha * value + (1.0 - alpha) * predicted
        trend = beta * (moved - level) + (1.0 - beta) * trend
        level = moved
    return level, trend, fitted


FITTED = (
    "sse double, alpha double, beta double, l0 double, b0 double, level double, trend double, "
    "fitted array<double>"
)


def fit(series: DataFrame, values: str = "y", config: ForecastConfig = FORECAST) -> DataFrame:
    """Add ``fit``: the parameters (sse, alpha, beta, l0, b0) that minimise the squared
    errors, the final ``level`` and ``trend``, and ``fitted``, the in-sample predictions.

    The search runs a few hundred candidates per series as vectors in an Arrow
    batch; Spark decides which series run where.
    """

    @F.pandas_udf(FITTED)
    def search(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for values_ in batch:
            y = np.asarray(values_, dtype=float)
            best = _search(y, config).tolist()
            rows.append((*best, *_run(y, *best[1:])))
        names = ["sse", "alpha", "beta", "l0", "b0", "level", "trend", "fitted"]
        return pd.DataFrame(rows, columns=names)

    return series.withColumn("fit", search(F.col(values)))


def spread_series(series: DataFrame) -> DataFrame:
    """One shuffle that deals the series over all cores before the costly fit."""
    return series.repartition(series.sparkSession.sparkContext.defaultParallelism)


# -- a store of fits -----------------------------------------------------------------


def fit_key(values: str, config: ForecastConfig = FORECAST) -> Column:
    """Content address of a fit: the values in order and all settings of the search."""
    settings = (config.grid_steps, config.zoom_rounds, config.zoom_half_width)
    text = F.concat_ws(",", F.lit(repr(settings)), F.transform(F.col(values), lambda v: v.cast("string")))
    return F.sha2(text, 256)


STORED_FITS = f"fit_key string, fit struct<{FITTED.replace(' double', ': double').replace('fitted array', 'fitted: array')}>"


def known_fits(spark: SparkSession, path: str) -> DataFrame:
    """The fits under ``path`` as of now, none if there is no such folder.

    Every run that searched has a folder of its own, finished or not seen at all. Named one by
    one, two readings of a store that has grown in between are never taken for the same.
    """
    runs = [f"{path}/{n}" for n in files.names(spark, path) if n.startswith("run-")]
    done = [r for r in runs if files.exists(spark, f"{r}/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], STORED_FITS)
    return spark.read.schema(STORED_FITS).parquet(*done)


def fit_stored(
    series: DataFrame, path: str, values: str = "y", config: ForecastConfig = FORECAST
) -> DataFrame:
    """As :func:`fit`, searching only series whose fit the store does not have.

    What is searched is appended to the store first, so a failed run loses nothing that was
    stored before it; equal series, and equal parts of series, share one fit.
    """
    spark = series.sparkSession
    keyed = series.withColumn("fit_key", fit_key(values, config))
    new = keyed.select("fit_key", values).join(known_fits(spark, path), "fit_key", "left_anti")
    if not new.isEmpty():
        searched = fit(spread_series(new.dropDuplicates(["fit_key"])), values, config)
        searched.select("fit_key", "fit").write.parquet(f"{path}/run-{uuid.uuid4().hex}")
    # Two writers at once may both have searched a series; their fits are the same.
    fits = known_fits(spark, path).dropDuplicates(["fit_key"])
    return keyed.join(fits, "fit_key").drop("fit_key")


def _advance(y: Column, level: Column, trend: Column, alpha: Column, beta: Column):
    predicted = level + trend
    new_level = alpha * y + (1.0 - alpha) * predicted
    new_trend = beta * (new_level - level) + (1.0 - beta) * trend
    return predicted, new_level, new_trend


def smooth(values: Column, params: Column) -> Column:
    """Run the recursion: struct (level, trend, sse) at the end of the series."""
    start = F.struct(
        params["l0"].alias("level"), params["b0"].alias("trend"), _d(0).alias("sse")
    )

    def step(s: Column, value: Column) -> Column:
        p, l, b = _advance(value, s["level"], s["trend"], params["alpha"], params["beta"])
        error = value - p
        return F.struct(l.alias("level"), b.alias("trend"), (s["sse"] + error * error).alias("sse"))

    return F.aggregate(values, start, step)


# -- results ---------------------------------------------------------------------


def fit_and_smooth(
    series: DataFrame, config: ForecastConfig = FORECAST, store: str | None = None
) -> DataFrame:
    """Fitted series: ``fit``, ``run`` (final state, fitted values) and ``residual_std``.

    Series that cannot be fitted are left out; :func:`series_report` lists them all. With a
    ``store``, a folder, only series that it has no fit of are searched.
    """
    usable = usable_series(series, config)
    fitted = fit(spread_series(usable), "y", config) if store is None else fit_stored(usable, store, "y", config)
    run = fitted.withColumn("run", F.struct("fit.level", "fit.trend", "fit.fitted"))
    errors = F.zip_with("y", F.col("run.fitted"), lambda a, p: a - p)
    return run.withColumn("residual_std", _sample_std(errors))


def _mean(values: Column) -> Column:
    return F.aggregate(values, _d(0), lambda s, v: s + v) / F.size(values)


def _sum_squares(values: Column) -> Column:
    return F.aggregate(values, _d(0), lambda s, v: s + v * v)


def _deviations(values: Column) -> Column:
    # The mean is bound once, not recomputed for every element.
    bound = F.transform(
        F.array(_mean(values)), lambda mean: F.transform(values, lambda v: v - mean)
    )
    return F.element_at(bound, 1)


def _sample_std(values: Column) -> Column:
    """Sample deviation; 0 for a single value."""
    n = F.size(values)
    spread = _sum_squares(_deviations(values)) / F.nullif((n - 1).cast("double"), _d(0))
    return F.coalesce(F.sqrt(spread), _d(0))


def forecast(fitted: DataFrame, config: ForecastConfig = FORECAST) -> DataFrame:
    """The next ``horizon`` months with a constant-width interval."""
    margin = F.col("residual_std") * config.interval_z
    predicted = F.col("run.level") + F.col("step") * F.col("run.trend")
    return fitted.withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(config.horizon)))
    ).select(
        "series_key",
        F.add_months(F.element_at("months", -1), F.col("step")).alias("month"),
        F.round(predicted, 2).alias("predicted_revenue"),
        F.round(predicted - margin, 2).alias("lower_bound"),
        F.round(predicted + margin, 2).alias("upper_bound"),
        F.lit(config.model_name).alias("model_name"),
    )


def comparison(fitted: DataFrame) -> DataFrame:
    """Actual against in-sample prediction; the error is taken from the rounded prediction."""
    rows = F.arrays_zip("months", "y", F.col("run.fitted").alias("p"))
    return fitted.select("series_key", F.inline(rows)).select(
        "series_key",
        F.col("months").alias("month"),
        F.col("y").alias("actual_revenue"),
        F.round("p", 2).alias("predicted_revenue"),
        F.round(F.col("y") - F.round("p", 2), 2).alias("prediction_error"),
    )


def holdout_metrics(
    fitted: DataFrame, config: ForecastConfig = FORECAST, store: str | None = None
) -> DataFrame:
    """Refit without the last ``holdout`` months and score the forecast of them.

    One row per series, with the production fit's final level and trend. The refit goes
    through the ``store`` if there is one.
    """
    h = config.holdout
    n = F.size("y")
    split = fitted.withColumns(
        {
            "_train": F.slice("y", 1, n - h),
            "_held": F.slice("y", n - h + 1, F.lit(h)),
        }
    ).withColumnRenamed("fit", "_production")
    again = fit(split, "_train", config) if store is None else fit_stored(split, store, "_train", config)
    refit = again.withColumn("_run", F.col("fit"))
    errors = F.transform(
        "_held",
        lambda a, i: a - (F.col("_run.level") + (i + 1).cast("double") * F.col("_run.trend")),
    )
    scored = refit.withColumn("_errors", errors)
    squares = _sum_squares(F.col("_errors"))
    total = _sum_squares(_deviations(F.col("_held")))
    r2 = F.when(total > 0, 1.0 - squares / F.nullif(total, _d(0))).otherwise(F.lit(float("nan")))
    return scored.select(
        "series_key",
        F.lit(config.model_name).alias("model_name"),
        F.round(_mean(F.transform("_errors", F.abs)), 4).alias("mae"),
        F.round(F.sqrt(squares / h), 4).alias("rmse"),
        F.round(r2, 6).alias("r2_score"),
        F.size("_train").alias("train_months"),
        F.size("_held").alias("holdout_months"),
        F.round("residual_std", 4).alias("residual_std"),
        F.round("run.level", 4).alias("intercept"),
        F.round("run.trend", 4).alias("slope"),
    )


def smooth_fixed(
    series: DataFrame, alpha: float, beta: float
) -> DataFrame:
    """Final state and SSE for given parameters, started at y1 and y2 - y1."""
    params = F.struct(
        _d(alpha).alias("alpha"), _d(beta).alias("beta"),
        F.element_at("y", 1).alias("l0"),
        (F.element_at("y", 2) - F.element_at("y", 1)).alias("b0"),
    )
    run = series.withColumn("_params", params).withColumn("_run", smooth(F.col("y"), F.col("_params")))
    return run.select(
        "series_key",
        F.size("y").alias("months_fitted"),
        F.col("_run.level").alias("level"),
        F.col("_run.trend").alias("trend"),
        F.col("_run.sse").alias("sse"),
    )
