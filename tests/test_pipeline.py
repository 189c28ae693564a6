"""The whole batch from files to catalog tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from touchtrail.operators import contracts, quality
from touchtrail.plans import pipeline
from touchtrail.plans.models import TABLES
from touchtrail.sources import versions
from touchtrail.sources.derived import raw_tables


@pytest.fixture(scope="module")
def data_dir(spark, sf_dir, tmp_path_factory):
    """The derived raw tables written as source files."""
    root = tmp_path_factory.mktemp("sources")
    raw = raw_tables(spark, sf_dir, flawed=False)
    for name in ("campaign_metadata", "content_performance", "portfolio_revenue"):
        df = raw[name]
        if name == "content_performance":  # repeated keys are a source defect that fails validation
            df = df.dropDuplicates(["content_id"])
        if name == "portfolio_revenue":
            flag = F.when(F.col("is_recurring"), "True").otherwise("False")
            df = df.withColumn("is_recurring", flag)
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(f"{root}/{name}.csv")
    # Two JSON documents in one folder.
    records = [r.asDict() for r in raw["user_signups"].collect()]
    records = [r | {"signup_date": r["signup_date"] or "1995-01-01"} for r in records]
    folder = root / "user_signups.json"
    folder.mkdir()
    half = len(records) // 2
    for i, part in enumerate((records[:half], records[half:])):
        (folder / f"{i}.json").write_text(json.dumps({"signups": part}))
    return str(root)


@pytest.fixture(scope="module")
def tables(spark, data_dir, tmp_path_factory):
    return pipeline.run(spark, data_dir, str(tmp_path_factory.mktemp("raw")))


def test_every_table_is_in_its_layer(spark, tables):
    for name in TABLES:
        stored = spark.table(f"{pipeline.layer_of(name)}.{name}")
        assert set(stored.columns) == set(tables[name].columns)
        assert stored.count() > 0
    for name in ("revenue_forecast", "forecast_metrics", "forecast_comparison"):
        assert spark.table(f"forecasting.{name}").count() == tables[name].count()
    assert spark.table("anomaly.channel_revenue_anomalies").count() > 0


def test_validation_log_is_appended(spark, tables):
    log = spark.table("raw.validation_results")
    assert log.columns == ["check_name", "status", "message", "timestamp"]
    assert log.count() == 60
    assert log.where("status = 'FAIL'").count() == 0


def test_fact_is_partitioned_by_month(spark, tables):
    detail = spark.sql("DESCRIBE marts.fct_attributed_revenue").collect()
    assert "# Partition Information" in {r[0] for r in detail}
    month = spark.table("marts.fct_attributed_revenue").agg(F.min("revenue_date_key")).first()[0]
    files = spark.table("marts.fct_attributed_revenue").where(
        F.col("revenue_date_key") == month).inputFiles()
    assert files and all(f"revenue_date_key={month}" in f for f in files)


def test_contracts_hold_on_pipeline_output(tables):
    report = contracts.contract_report({n: tables[n] for n in TABLES})
    failing = {r["constraint_name"] for r in report.where("NOT passed").collect()}
    assert failing <= {"not_null:stg_user_signups.first_touch_channel",
                       "not_null:stg_user_signups.last_touch_channel"}


def test_failed_validation_stops_the_run_but_is_logged(spark, data_dir, tables):
    before = spark.table("raw.validation_results").count()
    raw = pipeline.read_sources(spark, data_dir)
    raw["portfolio_revenue"] = raw["portfolio_revenue"].withColumn("company_id", F.lit("nobody"))
    with pytest.raises(quality.ValidationFailed, match="valid_revenue_company"):
        pipeline.validate(spark, raw)
    assert spark.table("raw.validation_results").count() == before + 60


def test_a_versioned_batch_is_visible_at_once_or_not_at_all(spark, data_dir, tables, tmp_path, monkeypatch):
    root = str(tmp_path / "results")
    sink = pipeline.VersionedSink(spark, root)
    pipeline.run(spark, data_dir, str(tmp_path / "raw"), sink)
    at = versions.entry(spark, root)
    assert at.number == 1 and set(at.tables) == set(sink.tables)
    assert {f"{pipeline.layer_of(n)}.{n}" for n in TABLES} <= set(at.tables)
    for name in ("fct_attributed_revenue", "channel_performance", "dim_time"):
        got = versions.read(spark, at, f"{pipeline.layer_of(name)}.{name}")
        want = tables[name].select(*got.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0

    def fails(*args):
        raise RuntimeError("no forecast")

    monkeypatch.setattr(pipeline, "store_forecast", fails)
    with pytest.raises(RuntimeError, match="no forecast"):
        pipeline.run(spark, data_dir, str(tmp_path / "raw"), pipeline.VersionedSink(spark, root))
    assert versions.numbers(spark, root) == [1]
