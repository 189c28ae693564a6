"""Broadcast and shuffled routes give the same model tables."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from touchtrail.config import SKEW
from touchtrail.operators.skew import is_small, salted_join
from touchtrail.plans import registry
from touchtrail.plans.models import Models, in_scratch
from touchtrail.sources.derived import raw_tables
from touchtrail.sources.store import materialize


@pytest.fixture(scope="module")
def shuffled(spark, sf_dir):
    """Every lookup counts as too large, and many keys as hot."""
    config = replace(SKEW, broadcast_rows=0, hot_share=0.01, salts=7)
    return Models(raw_tables(spark, sf_dir), in_scratch, config)


@pytest.mark.parametrize("name", [
    "int_user_journeys",
    "int_attributed_revenue",
    "fct_content_performance",
    "campaign_performance",
    "monthly_revenue_customer_growth",
])
def test_same_rows(spark, sf_dir, shuffled, name):
    usual = getattr(registry.stored(spark, sf_dir), name)
    other = getattr(shuffled, name)
    assert usual.count() == other.count()
    assert usual.exceptAll(other).count() == 0
    assert other.exceptAll(usual).count() == 0


def test_small_is_told_by_rows_not_by_bytes_in_files(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), F.lit("x" * 50).alias("v"))
    held = materialize(rows, "many-alike")  # a few hundred bytes
    few = replace(SKEW, broadcast_rows=1000)
    assert not is_small(held, few) and is_small(held, replace(SKEW, broadcast_rows=5000))
    # Nor does Spark broadcast it on its own account.
    left = materialize(spark.range(50).select("id", (F.col("id") % 9).alias("k")), "left")
    joined = salted_join(left, held.distinct(), ["k"], ["id"], config=few)
    assert joined.count() == 50
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=merge)" in plan
