"""Build every stored table in dependency order, then score and forecast.

Tables are written once and read back, so each later step starts from a file
scan: lineage stays short, lost executors cost one step, and joins plan with
measured sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.config import ANOMALY, FORECAST, SKEW, AnomalyConfig, ForecastConfig, SkewConfig
from touchtrail.functions.columns import date_key
from touchtrail.operators import anomalies, attribution, dimensions, facts, holt, quality
from touchtrail.plans.models import TABLES, Models
from touchtrail.sources import store, versions
from touchtrail.sources.raw_files import read_sources

LAYER_OF = {
    "stg": "staging",
    "int": "intermediate",
    "dim": "marts",
    "fct": "marts",
    "channel_month_panel": "anomaly",
}

# Tables written partitioned, and by which column.
PARTITIONED = {"fct_attributed_revenue": "revenue_date_key"}

# (layer, table, DataFrame, partition column) -> stored DataFrame
Sink = Callable[[str, str, DataFrame, str | None], DataFrame]

PORTFOLIO = "portfolio"


def scratch_sink(layer: str, name: str, df: DataFrame, partition_by: str | None) -> DataFrame:
    """Store in the session's shared scratch folder."""
    return store.materialize(df, name)


def catalog_sink(layer: str, name: str, df: DataFrame, partition_by: str | None) -> DataFrame:
    """Store as a catalog table of the layer's database."""
    store.overwrite_table(df, layer, name, partition_by)
    return store.read_table(df.sparkSession, layer, name).select(*df.columns)


class VersionedSink:
    """Stores every table in folders of its own; ``publish`` makes all of them one version.

    Readers see the tables of the last version until the whole batch has succeeded, and none
    of a batch that failed. Tables are named ``layer.table``.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.tables: dict[str, versions.Table] = {}

    def __call__(self, layer: str, name: str, df: DataFrame, partition_by: str | None) -> DataFrame:
        full = f"{layer}.{name}"
        if partition_by is None:
            table = versions.write(df, self.root, full)
        else:
            parts = versions.write_parts(df, self.root, full, F.col(partition_by))
            table = versions.Table(df.schema.json(), parts)
        self.tables[full] = table
        return versions.read(self.spark, versions.Entry(0, {full: table}), full)

    def publish(self) -> int:
        return versions.commit(self.spark, self.root, lambda latest: dict(self.tables))


def layer_of(table: str) -> str:
    return LAYER_OF.get(table) or LAYER_OF.get(table.split("_")[0], "analytics")


def storing_models(raw: Mapping[str, DataFrame], sink: Sink = scratch_sink) -> Models:
    """Models whose tables are stored by the sink when first needed."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        return sink(layer_of(name), name, df, PARTITIONED.get(name))

    return Models(raw, keep)


def channel_panel(tables: Models, config: AnomalyConfig = ANOMALY) -> DataFrame:
    """Dense month x channel panel of last-touch revenue, stored once for its readers."""
    if config != ANOMALY:
        return planned_panel(tables, config)
    if "channel_month_panel" not in vars(tables):
        tables.channel_month_panel = tables.keep(
            "channel_month_panel", planned_panel(tables, config)
        )
    return tables.channel_month_panel


def planned_panel(tables: Models, config: AnomalyConfig = ANOMALY) -> DataFrame:
    revenue = anomalies.monthly_channel_revenue(
        attribution.as_cells(tables.fct_attributed_revenue), tables.dim_time, config
    )
    return anomalies.dense_panel(
        tables.monthly_revenue_customer_growth, tables.channel_performance, revenue, config
    )


def portfolio_series(tables: Models) -> DataFrame:
    """The portfolio's monthly revenue as one series."""
    history = tables.monthly_revenue_customer_growth.select(
        F.lit(PORTFOLIO).alias("key"), "month_start_date", "total_revenue"
    )
    return holt.build_series(history, "key", "month_start_date", "total_revenue")


def channel_series(tables: Models) -> DataFrame:
    """One series per channel, from the dense panel."""
    return holt.build_series(
        channel_panel(tables), "channel", "month_start_date", "monthly_revenue"
    )


def company_series(tables: Models) -> DataFrame:
    """One series per company; a company with a missing month is reported as irregular."""
    month = F.to_date(F.col("revenue_date_key").cast("string"), "yyyyMMdd")
    history = (
        tables.fct_attributed_revenue
        .where(F.col("company_id").isNotNull() & F.col("revenue_date_key").isNotNull())
        .groupBy("company_id", "revenue_date_key")
        .agg(F.sum("revenue_amount").alias("revenue"))
        .select("company_id", month.alias("month"), "revenue")
    )
    return holt.build_series(history, "company_id", "month", "revenue")


def require_rows(tables: Mapping[str, DataFrame]) -> None:
    """Raise ValueError naming the tables that are empty."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"No rows in: {', '.join(empty)}")


def store_anomalies(
    tables: Models, sink: Sink = scratch_sink, config: AnomalyConfig = ANOMALY
) -> DataFrame:
    """Score and store the anomalies; raises when there is nothing to score."""
    require_rows(
        {
            "channels": tables.channel_performance,
            "months": tables.monthly_revenue_customer_growth,
            "revenue": tables.fct_attributed_revenue,
        }
    )
    # Ranking reads the scored rows three times: the panel is small and stored.
    panel = channel_panel(tables, config)
    require_rows({"channel panel": panel})
    scored = anomalies.channel_anomalies(panel, config)
    return sink("anomaly", "channel_revenue_anomalies", scored, None)


def store_forecast(
    tables: Models, sink: Sink = scratch_sink, config: ForecastConfig = FORECAST
) -> dict[str, DataFrame]:
    """Forecast, metrics and in-sample comparison of the portfolio series.

    The fitted series is stored first: three results read it.
    """
    require_rows({"monthly history": tables.monthly_revenue_customer_growth})
    series = portfolio_series(tables)
    rejected = holt.series_status(series, config).where(F.col("status") != "ok").first()
    if rejected is not None:
        raise ValueError(
            f"Portfolio history is {rejected['status']}: need at least "
            f"{config.minimum_history} months without gaps"
        )
    fitted = store.materialize(holt.fit_and_smooth(series, config), "fitted_series")
    stamp = F.current_timestamp()
    return {
        "revenue_forecast": sink(
            "forecasting", "revenue_forecast",
            holt.forecast(fitted, config).drop("series_key").withColumn("generated_at", stamp), None,
        ),
        "forecast_metrics": sink(
            "forecasting", "forecast_metrics",
            holt.holdout_metrics(fitted, config).drop("series_key").withColumn("generated_at", stamp),
            None,
        ),
        "forecast_comparison": sink(
            "forecasting", "forecast_comparison",
            holt.comparison(fitted).drop("series_key"), None,
        ),
    }


def all_series(tables: Models) -> DataFrame:
    """Portfolio, channels and companies: every series of the stored tables."""
    return (
        portfolio_series(tables)
        .unionByName(channel_series(tables))
        .unionByName(company_series(tables))
    )


def store_series_report(
    tables: Models, sink: Sink = scratch_sink, config: ForecastConfig = FORECAST
) -> DataFrame:
    """Which series can be forecast, and why the others cannot."""
    return sink(
        "forecasting", "series_report", holt.series_report(all_series(tables), config), None
    )


def ingest(spark: SparkSession, data_dir: str, raw_root: str) -> dict[str, int]:
    """Load the source files into a new raw version; returns rows per table."""
    return store.publish_tables(spark, read_sources(spark, data_dir), raw_root)


def refresh_revenue_fact(
    spark: SparkSession,
    root: str,
    revenue: DataFrame,
    journeys: DataFrame,
    config: SkewConfig = SKEW,
) -> versions.Refresh:
    """Bring the versioned revenue fact up to date, rewriting only months that differ.

    A month differs if its revenue records do, or if it has records of users whose journey
    has changed. The journeys it was built from are kept in the same commit. Equal to a
    full rebuild, late, changed and deleted records and journeys included.
    """
    base = versions.entry(spark, root)
    month = date_key("revenue_month")
    touched: list[str] = []
    others = {"int_user_journeys": journeys}
    if "int_user_journeys" in base.tables:
        before = versions.read(spark, base, "int_user_journeys")
        users = store.materialize(versions.changed_keys(before, journeys, ["user_id"]), "changed-users")
        if users.isEmpty():
            others = {}
        else:
            theirs = revenue.join(users.where("user_id IS NOT NULL"), "user_id", "left_semi")
            label = F.coalesce(month.cast("string"), F.lit(versions.NULL_PART))
            # Months, of which there are as many as the calendar has.
            touched = [r[0] for r in theirs.select(label).distinct().collect()]

    def build(rows: DataFrame) -> DataFrame:
        return facts.fct_attributed_revenue(attribution.attributed_revenue(rows, journeys, config))

    return versions.refresh(
        spark, root, "fct_attributed_revenue", revenue, month, build, F.col("revenue_date_key"),
        touched, others,
    )


def validate(spark: SparkSession, raw: dict[str, DataFrame]) -> DataFrame:
    """Run the raw report, append it to the log, and raise when a check failed."""
    report = store.materialize(quality.raw_report(spark, raw), "raw_report")
    log = report.select("check_name", "status", "message", "timestamp")
    store.append_table(log, "raw", "validation_results")
    quality.raise_on_failure(report)
    return report


def run(
    spark: SparkSession, data_dir: str, raw_root: str, sink: Sink = catalog_sink
) -> dict[str, DataFrame]:
    """Whole batch: load, validate, build, score, forecast.

    With a :class:`VersionedSink` all results become visible at once, at the end.
    """
    counts = ingest(spark, data_dir, raw_root)
    raw = store.read_published(spark, raw_root, list(counts))
    validate(spark, raw)
    models = storing_models(raw, sink)
    tables = {name: getattr(models, name) for name in TABLES}
    tables["channel_revenue_anomalies"] = store_anomalies(models, sink)
    tables["series_report"] = store_series_report(models, sink)
    beyond = dimensions.dates_beyond_horizon(*models.dated)
    tables["dates_beyond_horizon"] = sink("analytics", "dates_beyond_horizon", beyond, None)
    tables |= store_forecast(models, sink)
    if isinstance(sink, VersionedSink):
        sink.publish()
    return tables
