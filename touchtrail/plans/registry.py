"""Registered queries: name -> callable(spark, sf_dir).

A model query plans its table over the stored tables it depends on, as the batch
pipeline does; reads (scoring, forecasts, drill-downs, reports) scan stored
tables. A stored table is built from the test tables when a query first needs it,
once per session and data folder. ``touch_revenue_by_channel`` runs end to end as
one lazy plan.

Results are made comparable with other engines: decimals as doubles, dates as
ISO text, unrounded doubles rounded; fitted values to whole units, because they come
from long chains of floating-point sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.functions.columns import round_half_away
from touchtrail.config import FORECAST
from touchtrail.operators import (
    anomalies,
    audience,
    contracts,
    dimensions,
    drilldown,
    facts,
    holt,
    journeys,
    quality,
    reconciliation,
    uniqueness,
)
from touchtrail.plans import pipeline
from touchtrail.plans.models import TABLES, Models
from touchtrail.sources import clustered, files, raw_files, versions
from touchtrail.sources.derived import crowded_campaigns, earlier_revenue, raw_tables
from touchtrail.sources.store import (
    append_table,
    overwrite_table,
    read_published,
    read_table,
    scratch_path,
)

Query = Callable[[SparkSession, str], DataFrame]

# Selection used by the registered drill-downs.
COMPANIES = ("CTC-001", "CTC-003")
CHANNELS = ("youtube", "twitter", "organic")

CHANNEL_NAMES = ("YouTube", "Blog")

FIXED_ALPHA, FIXED_BETA = 0.5, 0.2

# Session, data folder, and the state of its files.
Key = tuple[str, str, int]
_STORED: dict[Key, Models] = {}


def key_of(spark: SparkSession, sf_dir: str) -> Key:
    """What is stored for one state of the files is not used for another."""
    return spark.sparkContext.applicationId, sf_dir, files.stamp(spark, sf_dir)


def stored(spark: SparkSession, sf_dir: str) -> Models:
    """Models of the test tables that store each table when it is first needed."""
    key = key_of(spark, sf_dir)
    if key not in _STORED:
        _STORED[key] = pipeline.storing_models(raw_tables(spark, sf_dir))
    return _STORED[key]


def stored_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    if "channel_revenue_anomalies" not in vars(tables):
        tables.channel_revenue_anomalies = pipeline.store_anomalies(tables)
    return tables.channel_revenue_anomalies


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = stored(spark, sf_dir)
    return {name: getattr(tables, name) for name in TABLES}


def comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = digits or {}
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        if f.name in digits:
            c = round_half_away(c, digits[f.name])
        columns.append(c.alias(f.name))
    return df.select(*columns)


# -- model tables ------------------------------------------------------------------

MODEL_QUERIES = {
    "stg_campaigns": "stg_campaign_metadata",
    "stg_content": "stg_content_performance",
    "stg_revenue": "stg_portfolio_revenue",
    "stg_signups": "stg_user_signups",
    "user_journeys": "int_user_journeys",
    "attributed_revenue": "int_attributed_revenue",
    "dim_channel": "dim_channel",
    "dim_company": "dim_company",
    "dim_time": "dim_time",
    "dim_user_cohort": "dim_user_cohort",
    "fct_attributed_revenue": "fct_attributed_revenue",
    "fct_campaign_roi": "fct_campaign_roi",
    "fct_content_performance": "fct_content_performance",
    "channel_performance": "channel_performance",
    "campaign_performance": "campaign_performance",
    "company_revenue_analysis": "company_revenue_analysis",
    "monthly_growth": "monthly_revenue_customer_growth",
}


def _model_query(attribute: str) -> Query:
    return lambda spark, sf_dir: comparable(stored(spark, sf_dir).plan(attribute))


# -- sources and sinks -----------------------------------------------------------------

_LOADED: dict[Key, dict[str, DataFrame]] = {}


def loaded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables written as source files, read, published as a version and read back."""
    key = key_of(spark, sf_dir)
    if key not in _LOADED:
        folder = scratch_path(spark, "sources")
        raw_files.write_sources(raw_tables(spark, sf_dir), f"{folder}/files")
        counts = pipeline.ingest(spark, f"{folder}/files", f"{folder}/raw")
        _LOADED[key] = read_published(spark, f"{folder}/raw", list(counts))
    return _LOADED[key]


def _loaded_query(table: str) -> Query:
    return lambda spark, sf_dir: comparable(loaded(spark, sf_dir)[table])


LOADED_QUERIES = {
    "loaded_campaigns": "campaign_metadata",
    "loaded_content": "content_performance",
    "loaded_revenue": "portfolio_revenue",
    "loaded_signups": "user_signups",
}


def loaded_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each published raw table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in loaded(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per channel of a layer table that was overwritten twice and appended to once."""
    channels = stored(spark, sf_dir).dim_channel
    name = f"channel_sink_{uuid.uuid4().hex[:12]}"  # runs at the same time do not meet
    for _ in range(2):
        overwrite_table(channels, "analytics", name)
    append_table(channels, "analytics", name)
    written = read_table(spark, "analytics", name)
    return written.groupBy("channel_key").agg(F.count(F.lit(1)).alias("rows"))


# -- touch revenue -------------------------------------------------------------------


def touch_revenue_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, customers and records per channel under both touch models."""
    cells = Models(raw_tables(spark, sf_dir)).cells
    return comparable(
        facts.touch_totals(cells, "first_touch_channel", "last_touch_channel", "channel_key")
    )


# -- quality ---------------------------------------------------------------------------


def quality_raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(quality.value_findings(raw_tables(spark, sf_dir)))


def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_keys(raw_tables(spark, sf_dir)["content_performance"], "content_id")


def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of revenue records without a signup."""
    raw = raw_tables(spark, sf_dir)
    return quality.orphan_keys(raw["portfolio_revenue"], raw["user_signups"], "user_id")


def quality_content_without_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content slugs without a campaign of that slug."""
    m = stored(spark, sf_dir)
    content = m.stg_content_performance.select(F.col("utm_campaign").alias("campaign_slug"))
    return quality.orphan_keys(content, m.stg_campaign_metadata, "campaign_slug")


def quality_generic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.contract_report(all_tables(spark, sf_dir))


def conservation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(
        reconciliation.conservation_report(all_tables(spark, sf_dir)),
        {"expected_value": 2, "actual_value": 2},
    )


def nonnegative_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciliation.nonnegative_report(all_tables(spark, sf_dir))


# Every n-th record of a raw table lacks a required value; n differs from column to column.
def gap_of(table: str, column: str) -> int:
    return 11 + 2 * quality.REQUIRED[table].index(column)


def quality_gaps_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the required-value rules on tables with blanks and NULLs in every such column."""
    rules = quality.row_rules()
    parts = []
    for table, df in raw_tables(spark, sf_dir).items():
        number = F.regexp_extract(quality.PRIMARY_KEYS[table], r"(\d+)", 1).cast("bigint")
        numbered = df.withColumn("_number", number)
        gaps = {}
        for column in quality.REQUIRED[table]:
            kind = df.schema[column].dataType
            n = gap_of(table, column)
            blank = F.lit("  " if n % 4 == 3 else None) if isinstance(kind, T.StringType) else F.lit(None)
            gaps[column] = F.when(F.col("_number") % n == 0, blank.cast(kind)).otherwise(F.col(column))
        own = [r for r in rules if r.table == table and r.name.startswith("required_value_")]
        parts.append(quality.count_rules(numbered.withColumns(gaps), own))
    found = quality.judged(reduce(DataFrame.unionByName, parts))
    return found.select("check_name", "status", "issue_count")


def quality_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicated keys of every raw primary key and every column declared unique."""
    raw = raw_tables(spark, sf_dir)
    tables = all_tables(spark, sf_dir)
    primary = {
        f"duplicate_primary_key_{t}": (raw[t], key) for t, key in quality.PRIMARY_KEYS.items()
    }
    declared = {
        f"unique:{t}.{c}": (tables[t], c) for t, k in contracts.CONTRACTS.items() for c in k.unique
    }
    return uniqueness.duplicated_keys(primary, null_is_key=True).unionByName(
        uniqueness.duplicated_keys(declared)
    )


# -- sources that are not there ----------------------------------------------------------


def absent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source files missing from a folder that holds only those without content records."""
    folder = scratch_path(spark, "some-sources")
    present = {
        name: df for name, df in raw_tables(spark, sf_dir).items()
        if "content_id" not in df.columns and "user_id" not in df.columns
    }
    raw_files.write_sources(raw_tables(spark, sf_dir), folder, {
        name: raw_files.SOURCE_FILES[name] for name in present
    })
    absent = raw_files.missing_sources(spark, raw_files.source_paths(folder))
    return spark.createDataFrame([(a.rsplit("/", 1)[1],) for a in absent], "file string")


# -- anomalies -------------------------------------------------------------------------

ANOMALY_DIGITS = {
    "monthly_revenue": 2,
    "expected_revenue": 4,
    "revenue_difference": 4,
    "rolling_mean": 4,
    "rolling_std": 4,
    "z_score": 6,
    "deviation_percent": 6,
}


def channel_month_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(pipeline.channel_panel(stored(spark, sf_dir)), {"monthly_revenue": 2})


def rolling_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = pipeline.channel_panel(stored(spark, sf_dir))
    return comparable(anomalies.rolling_baseline(panel), ANOMALY_DIGITS)


def channel_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = pipeline.channel_panel(stored(spark, sf_dir))
    return comparable(anomalies.channel_anomalies(panel), ANOMALY_DIGITS)


def odd_channel_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a panel with a channel that never moves and one that averages to nothing.

    The first has no z-score, the second no deviation, not even in its anomalies.
    """
    panel = pipeline.channel_panel(stored(spark, sf_dir))
    i = F.row_number().over(Window.partitionBy("channel").orderBy("month_start_date")) - 1
    swing = F.when(i % 7 == 6, 10000.0).when(i % 2 == 0, 100.0).otherwise(-100.0)
    odd = panel.withColumn(
        "monthly_revenue",
        F.when(F.col("channel") == "blog", 250.0)
        .when(F.col("channel") == "podcast", swing)
        .otherwise(F.col("monthly_revenue")),
    )
    return comparable(anomalies.channel_anomalies(odd), ANOMALY_DIGITS)


def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return anomalies.anomaly_summary(
        pipeline.channel_panel(tables), stored_anomalies(spark, sf_dir)
    )


def _named_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return drilldown.named_anomalies(
        stored_anomalies(spark, sf_dir), tables.channel_performance
    )


def anomaly_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.anomaly_list(_named_anomalies(spark, sf_dir), CHANNELS)
    return comparable(drilldown.strongest_first(rows), ANOMALY_DIGITS)


def anomaly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.anomaly_trend(_named_anomalies(spark, sf_dir))
    return comparable(
        rows.select("channel_name", "month_start_date", "monthly_revenue", "is_anomaly"),
        ANOMALY_DIGITS,
    )


def anomaly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drilldown.anomaly_kpis(_named_anomalies(spark, sf_dir))


# -- forecasts -------------------------------------------------------------------------


_FITS: dict[Key, str] = {}


def fit_store(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the fits that the forecast queries share."""
    key = key_of(spark, sf_dir)
    if key not in _FITS:
        _FITS[key] = scratch_path(spark, "fits")
    return _FITS[key]


def _fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holt.fit_and_smooth(_all_series(spark, sf_dir), store=fit_store(spark, sf_dir))


def _all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.all_series(stored(spark, sf_dir))


def series_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series with its months and whether it can be forecast."""
    return comparable(holt.series_report(_all_series(spark, sf_dir)))


def holt_fixed_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = holt.smooth_fixed(
        holt.usable_series(_all_series(spark, sf_dir)), FIXED_ALPHA, FIXED_BETA
    )
    return run.select(
        "series_key",
        "months_fitted",
        round_half_away(F.col("level"), 3).alias("level"),
        round_half_away(F.col("trend"), 3).alias("trend"),
        round_half_away(F.sqrt(F.col("sse") / F.col("months_fitted")), 3).alias("rmse"),
    )


def holt_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = holt.usable_series(_all_series(spark, sf_dir))
    fitted = holt.fit_stored(usable, fit_store(spark, sf_dir))
    rmse = F.sqrt(F.col("fit.sse") / F.size("y"))
    return comparable(
        fitted.select("series_key", "fit.alpha", "fit.beta", "fit.l0", "fit.b0", rmse.alias("rmse")),
        {"alpha": 6, "beta": 6, "l0": 0, "b0": 0, "rmse": 1},
    )


def holt_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holt.forecast(_fitted(spark, sf_dir))
    return comparable(rows, {"predicted_revenue": 0, "lower_bound": 0, "upper_bound": 0})


def holt_holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holt.holdout_metrics(_fitted(spark, sf_dir), store=fit_store(spark, sf_dir))
    whole = {c: 0 for c in ("mae", "rmse", "residual_std", "intercept", "slope")}
    return comparable(rows, whole | {"r2_score": 4})


def holt_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = holt.comparison(_fitted(spark, sf_dir))
    return comparable(
        rows, {"actual_revenue": 2, "predicted_revenue": 0, "prediction_error": 0}
    )


def _portfolio_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = pipeline.portfolio_series(stored(spark, sf_dir))
    return holt.forecast(holt.fit_and_smooth(series, store=fit_store(spark, sf_dir)))


# The series whose values differ in the second run of the refit query.
CHANGED_SERIES = "CTC-001"


def holt_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that a second run has to search, after the values of one have changed."""
    path = scratch_path(spark, "fits")
    usable = holt.usable_series(_all_series(spark, sf_dir))
    holt.fit_stored(usable, path)
    changed = usable.withColumn(
        "y",
        F.when(
            F.col("series_key") == CHANGED_SERIES, F.transform("y", lambda v: v * 2 + 1)
        ).otherwise(F.col("y")),
    ).withColumn("fit_key", holt.fit_key("y"))
    missing = changed.join(holt.known_fits(spark, path), "fit_key", "left_anti")
    return changed.select("series_key").join(
        missing.select("series_key", F.lit(True).alias("_new")), "series_key", "left"
    ).select("series_key", F.coalesce("_new", F.lit(False)).alias("searched"))


def history_plus_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed months of the selection and the portfolio forecast."""
    tables = stored(spark, sf_dir)
    monthly = drilldown.monthly_revenue(
        tables.monthly_revenue_customer_growth, _detail(tables), COMPANIES, CHANNELS
    )
    return comparable(
        drilldown.history_plus_forecast(monthly, _portfolio_forecast(spark, sf_dir)),
        {"revenue": 0},
    )


# -- drill-downs -----------------------------------------------------------------------


def _detail(tables: Models) -> DataFrame:
    return tables.detail


def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    options = drilldown.filter_options(
        tables.company_revenue_analysis, tables.channel_performance
    )
    return drilldown.ordered(options, "name")


def revenue_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_detail(stored(spark, sf_dir)))


def channel_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    rows = drilldown.channel_performance(
        tables.channel_performance, _detail(tables), COMPANIES, CHANNELS
    )
    return comparable(drilldown.ordered(rows, "last_touch_revenue", descending=True))


def campaigns_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.campaign_performance(
        stored(spark, sf_dir).campaign_performance, COMPANIES, CHANNELS
    )
    return comparable(rows)


def company_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.company_analysis(stored(spark, sf_dir).company_revenue_analysis, COMPANIES)
    return comparable(drilldown.ordered(rows, "total_revenue", descending=True))


def monthly_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    rows = drilldown.monthly_revenue(
        tables.monthly_revenue_customer_growth, _detail(tables), COMPANIES, CHANNELS
    )
    return comparable(drilldown.ordered(rows, "month"))


def kpi_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return comparable(
        drilldown.kpi_overview(
            _detail(tables), tables.campaign_performance, tables.channel_performance,
            _portfolio_forecast(spark, sf_dir), COMPANIES, CHANNELS,
        ),
        {"total_revenue": 2},
    )


def attribution_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    rows = drilldown.channel_performance(
        tables.channel_performance, _detail(tables), COMPANIES
    )
    compared = drilldown.attribution_comparison(rows)
    return comparable(
        drilldown.ordered(compared, "difference"), {"difference": 2, "pct_difference": 6}
    )


def attribution_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(drilldown.attribution_long(stored(spark, sf_dir).channel_performance))


def top_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(drilldown.top_campaigns(stored(spark, sf_dir).campaign_performance))


def top_campaigns_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.top_by_every_measure(stored(spark, sf_dir).campaign_performance)
    return comparable(rows, {"value": 6})


def channel_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel performance without a selection, in presentation order."""
    tables = stored(spark, sf_dir)
    rows = drilldown.channel_performance(tables.channel_performance, _detail(tables))
    placed = drilldown.with_position(
        rows, F.col("last_touch_revenue").desc_nulls_last(), F.col("channel_key")
    )
    return comparable(
        placed.select(
            "channel_key", "channel_name", "first_touch_revenue", "last_touch_revenue", "views",
            "clicks", "campaign_count", "position",
        )
    )


def monthly_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue with new customers, in presentation order."""
    tables = stored(spark, sf_dir)
    rows = drilldown.monthly_revenue(
        tables.monthly_revenue_customer_growth, _detail(tables)
    )
    return comparable(drilldown.with_position(rows, F.col("month").asc_nulls_last()))


def anomaly_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scored rows of some channels by name, not only the flagged ones."""
    rows = drilldown.anomaly_list(
        _named_anomalies(spark, sf_dir), channel_names=CHANNEL_NAMES, show_all=True
    )
    return comparable(rows, ANOMALY_DIGITS)


def rank_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaks in the order of the anomaly ranks, and how many ranks were looked at."""
    found = stored_anomalies(spark, sf_dir)
    return found.agg(F.count("anomaly_rank").alias("ranks")).select(
        "ranks",
        drilldown.rank_order_violations(found)
        .agg(F.count(F.lit(1)))
        .scalar()
        .alias("violations"),
    )


def forecast_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = stored(spark, sf_dir).monthly_revenue_customer_growth.select(
        F.col("month_start_date").alias("month")
    )
    return comparable(drilldown.forecast_overlap(history, _portfolio_forecast(spark, sf_dir)))


def channels_with_ctr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drilldown.with_defined_ctr(stored(spark, sf_dir).channel_performance)
    shown = rows.select("channel_name", "click_through_rate", "campaign_budget_usd")
    return drilldown.formatted(shown, ["campaign_budget_usd"], ["click_through_rate"])


# -- versions ----------------------------------------------------------------------------

# The user whose journey differs in the earlier version.
MOVED_USER = "USR-7"

_REFRESHED: dict[Key, tuple[str, versions.Refresh]] = {}


def refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, versions.Refresh]:
    """Folder of two versions of the revenue fact, the second refreshed from the first."""
    key = key_of(spark, sf_dir)
    if key not in _REFRESHED:
        m = stored(spark, sf_dir)
        root = scratch_path(spark, "versions")
        revenue, now = m.stg_portfolio_revenue, m.int_user_journeys
        channel = F.when(F.col("user_id") == MOVED_USER, "elsewhere").otherwise(
            F.col("last_touch_resolved_channel")
        )
        earlier = now.withColumn("last_touch_resolved_channel", channel)
        pipeline.refresh_revenue_fact(spark, root, earlier_revenue(revenue), earlier)
        _REFRESHED[key] = root, pipeline.refresh_revenue_fact(spark, root, revenue, now)
    return _REFRESHED[key]


def refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue fact after only the months that differ were rewritten."""
    root, done = refreshed(spark, sf_dir)
    at = versions.entry(spark, root, done.number)
    return comparable(versions.read(spark, at, "fct_attributed_revenue"))


def refreshed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the fact that the refresh rewrote or removed."""
    _, done = refreshed(spark, sf_dir)
    rows = [(m, "rewritten") for m in done.rewritten] + [(m, "removed") for m in done.removed]
    return spark.createDataFrame(rows, "revenue_date_key string, change string")


def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue records that differ between the last version of the fact and the one before."""
    root, done = refreshed(spark, sf_dir)
    old, new = (
        versions.read(spark, versions.entry(spark, root, n), "fct_attributed_revenue")
        for n in (done.number - 1, done.number)
    )
    return versions.changed_keys(old, new, ["revenue_id"])


# -- a detail table for selective reads ------------------------------------------------------

SELECTIVE_COLUMNS = ("company_id", "first_touch_channel", "last_touch_channel", "revenue_month")
_CLUSTERED: dict[Key, str] = {}


def clustered_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue records of one company whose touches were both on one channel, read from a
    table laid out for such selections."""
    key = key_of(spark, sf_dir)
    detail = stored(spark, sf_dir).detail
    if key not in _CLUSTERED:
        _CLUSTERED[key] = scratch_path(spark, "clustered-detail")
        clustered.write_clustered(detail, _CLUSTERED[key], SELECTIVE_COLUMNS, 64 << 10)
    rows = spark.read.schema(detail.schema).parquet(_CLUSTERED[key])
    channel = CHANNELS[0]
    chosen = (F.col("first_touch_channel") == channel) & (F.col("last_touch_channel") == channel)
    return comparable(rows.where((F.col("company_id") == COMPANIES[0]) & chosen))


# -- dates beyond the calendar's horizon ----------------------------------------------------


def _dated_with_outliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """The dated tables, with some content repeated in the year 9999 and some before 1700."""
    campaigns, content, revenue, signups = stored(spark, sf_dir).dated
    order = F.regexp_extract("content_id", r"(\d+)", 1).cast("bigint")

    def moved(every: int, day: str) -> DataFrame:
        return content.where(order % every == 0).withColumn("publish_date", F.lit(day).cast("date"))

    stretched = content.unionByName(moved(97, "9999-12-31")).unionByName(moved(101, "1666-06-01"))
    return campaigns, stretched, revenue, signups


def dates_beyond_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that no calendar should be stretched to, by source, column and month."""
    return comparable(dimensions.dates_beyond_horizon(*_dated_with_outliers(spark, sf_dir)))


def calendar_with_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of sources that hold a few impossible dates."""
    bounds = dimensions.date_bounds(*_dated_with_outliers(spark, sf_dir))
    return comparable(dimensions.dim_time(bounds))


# -- campaigns that share a slug and a channel ---------------------------------------------


def crowded_journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups and companies per campaign, when all campaigns share a slug and a channel."""
    signups = stored(spark, sf_dir).stg_user_signups.withColumns(
        {
            "utm_campaign": F.lit("shared"),
            "first_touch_channel": F.lit("youtube"),
            "last_touch_channel": F.lit("blog"),
        }
    )
    found = journeys.user_journeys(signups, crowded_campaigns(spark, sf_dir), counted=True)
    with_last = F.when(F.col("last_touch_campaign_id").isNotNull(), F.col("signups")).otherwise(0)
    return found.groupBy("first_touch_campaign_id", "campaign_match_status").agg(
        F.sum("signups").alias("journeys"),
        F.countDistinct("company_id").alias("companies"),
        F.sum(with_last).alias("last_touch_matches"),
    )


def crowded_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content per month and campaign, when all campaigns share a slug and a channel."""
    content = stored(spark, sf_dir).stg_content_performance.withColumn("utm_campaign", F.lit("shared"))
    found = facts.fct_content_performance(content, crowded_campaigns(spark, sf_dir))
    return comparable(
        found.select("publish_month_date_key", "channel", "campaign_id", "content_count", "views", "clicks")
    )


# -- reads of the customer cells --------------------------------------------------------

# All subsets of two companies and two channels; an empty one means all.
PICKED = [
    (tuple(c for i, c in enumerate(COMPANIES[:2]) if a >> i & 1),
     tuple(c for i, c in enumerate(CHANNELS[:2]) if b >> i & 1))
    for a in range(4)
    for b in range(4)
]


def cells_channel_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return comparable(
        audience.channel_performance(
            tables.channel_performance, tables.audience_cells, COMPANIES, CHANNELS
        )
    )


def cells_monthly_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return comparable(
        audience.monthly_revenue(
            tables.monthly_revenue_customer_growth, tables.audience_cells, COMPANIES, CHANNELS
        )
    )


def cells_kpi_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored(spark, sf_dir)
    return comparable(
        audience.kpi_overview(
            tables.audience_cells, tables.campaign_performance, tables.channel_performance,
            FORECAST.horizon, COMPANIES, CHANNELS,
        ),
        {"total_revenue": 2},
    )


def customers_by_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and distinct customers of every subset of two companies and two channels."""
    found = audience.every_selection(stored(spark, sf_dir).audience_cells, PICKED)
    return comparable(found)


def customers_new_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per month and those of them with no earlier revenue."""
    return comparable(audience.new_customers(stored(spark, sf_dir).audience_cells))


OTHER_QUERIES: tuple[Query, ...] = (
    touch_revenue_by_channel,
    quality_raw_report,
    quality_duplicates,
    quality_orphans,
    quality_content_without_campaign,
    quality_generic_report,
    conservation_report,
    nonnegative_report,
    channel_month_panel,
    rolling_baseline,
    channel_anomalies,
    anomaly_summary,
    anomaly_list,
    anomaly_trend,
    anomaly_kpis,
    series_report,
    holt_fixed_params,
    holt_fit,
    holt_forecast,
    holt_holdout_metrics,
    holt_comparison,
    holt_refit,
    history_plus_forecast,
    filter_options,
    revenue_detail,
    channel_by_company,
    campaigns_by_company,
    company_filtered,
    monthly_filtered,
    kpi_overview,
    attribution_comparison,
    attribution_long,
    top_campaigns,
    channels_with_ctr,
    loaded_row_counts,
    layer_table_rows,
    top_campaigns_by_measure,
    channel_unfiltered,
    monthly_unfiltered,
    anomaly_all_rows,
    rank_order_violations,
    forecast_overlap,
    cells_channel_by_company,
    cells_monthly_filtered,
    cells_kpi_overview,
    customers_by_selection,
    customers_new_by_month,
    crowded_journeys,
    crowded_content,
    refreshed_fact,
    refreshed_months,
    version_changes,
    dates_beyond_horizon,
    calendar_with_outliers,
    quality_gaps_report,
    absent_sources,
    odd_channel_anomalies,
    clustered_detail,
    quality_unique_keys,
)


def queries() -> dict[str, Query]:
    registered = {name: _model_query(attribute) for name, attribute in MODEL_QUERIES.items()}
    registered |= {name: _loaded_query(table) for name, table in LOADED_QUERIES.items()}
    registered |= {query.__name__: query for query in OTHER_QUERIES}
    return registered
