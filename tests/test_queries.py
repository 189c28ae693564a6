"""Registered queries: oracle equality, stable schemas, and plan shape."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as spark_entry
from check_oracles import differences, duck
from touchtrail.plans import oracle, registry

ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, sf_dir, connection, name):
    assert differences(spark, connection, name, sf_dir) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.queries())


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_plan_has_no_cross_join_and_no_row_function(spark, sf_dir, name):
    plan = plan_text(registry.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert ("ArrowEvalPython" in plan) <= (name.startswith("holt_") or "forecast" in name)


def test_flagship_counts_customers_without_another_large_shuffle(spark, sf_dir):
    """After the join by user only the per-channel totals move."""
    lines = plan_text(spark_entry.entry(spark)).splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line or "HashJoin" in line)
    above = [line for line in lines[:join] if "Exchange" in line]
    assert len(above) == 1 and "hashpartitioning(channel_key" in above[0]


def test_drill_down_filters_reach_the_scan(spark, sf_dir):
    plan = plan_text(registry.monthly_filtered(spark, sf_dir))
    assert "In(company_id, [CTC-001,CTC-003])" in plan
    fact = next(line for line in plan.splitlines() if "FileScan" in line and "revenue_amount" in line)
    assert "attribution_confidence" not in fact


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert rows and {"channel_key", "first_touch_revenue"} <= set(rows[0].asDict())
