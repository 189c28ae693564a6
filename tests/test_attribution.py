"""Journeys, revenue joins and skew handling."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from touchtrail.config import SKEW
from touchtrail.operators import attribution, facts, journeys, skew

SIGNUP_COLUMNS = (
    "user_id string, signup_date date, company_id string, referral_source string, utm_source string, "
    "utm_medium string, utm_campaign string, first_touch_channel string, last_touch_channel string"
)
CAMPAIGN_COLUMNS = (
    "campaign_id string, campaign_slug string, channel string, budget_usd decimal(18,2), "
    "start_date date, end_date date, target_company_id string"
)
SHUFFLED = replace(SKEW, broadcast_rows=0, hot_share=0.2, salts=5)


def signup(spark, user, day, company="C1", ref=None, src=None, medium=None, slug=None, first=None,
           last=None):
    return (user, day, company, ref, src, medium, slug, first, last)


@pytest.fixture(scope="module")
def campaigns(spark):
    return spark.sql(f"""
      SELECT * FROM VALUES
        ('A', 'spring', 'blog', 100, DATE'2024-01-01', DATE'2024-01-31', NULL),
        ('B', 'fall', 'podcast', 0, DATE'2024-01-01', DATE'2024-12-31', 'C1')
      AS t(campaign_id, campaign_slug, channel, budget_usd, start_date, end_date, target_company_id)
    """).selectExpr("campaign_id", "campaign_slug", "channel",
                    "CAST(budget_usd AS DECIMAL(18,2)) AS budget_usd",
                    "start_date", "end_date", "target_company_id")


@pytest.fixture(scope="module")
def signups(spark):
    import datetime as dt

    d = dt.date
    rows = [
        signup(spark, "first_day", d(2024, 1, 1), src="blog", medium="m", slug="spring",
               first="blog", last="blog"),
        signup(spark, "last_day", d(2024, 1, 31), src="blog", medium="m", slug="spring",
               first="blog", last="podcast"),
        signup(spark, "too_late", d(2024, 2, 1), src="blog", medium="m", slug="spring",
               first="blog", last="blog"),
        signup(spark, "no_date", None, src="blog", medium="m", slug="spring", first="blog",
               last="blog"),
        signup(spark, "target", d(2024, 2, 1), src="podcast", medium="m", slug="fall",
               first="blog", last="podcast"),
        signup(spark, "wrong_target", d(2024, 2, 1), company="C2", src="podcast", medium="m",
               slug="fall", first="podcast", last="podcast"),
        signup(spark, "nothing", d(2024, 2, 1)),
        signup(spark, "referral", d(2024, 2, 1), ref="direct"),
        signup(spark, "source", d(2024, 2, 1), ref="direct", src="blog"),
        signup(spark, "no_company", d(2024, 2, 1), company=None, src="podcast", medium="m",
               slug="fall", first="podcast", last="podcast"),
    ]
    return spark.createDataFrame(rows, SIGNUP_COLUMNS)


@pytest.mark.parametrize("config", [SKEW, SHUFFLED], ids=["broadcast", "shuffled"])
def test_journey_rules(spark, signups, campaigns, config):
    got = {r["user_id"]: r for r in journeys.user_journeys(signups, campaigns, config).collect()}
    assert len(got) == 10

    def outcome(user):
        r = got[user]
        return r["first_touch_campaign_id"], r["last_touch_campaign_id"], r["campaign_match_status"]

    assert outcome("first_day") == ("A", "A", "matched_both")
    assert outcome("last_day") == ("A", None, "matched_first_touch_only")
    assert outcome("too_late") == (None, None, "unmatched_or_invalid")
    assert outcome("no_date") == (None, None, "unmatched_or_invalid")
    assert outcome("target") == (None, "B", "matched_last_touch_only")
    assert outcome("wrong_target") == (None, None, "unmatched_or_invalid")
    assert outcome("no_company") == (None, None, "unmatched_or_invalid")
    assert outcome("nothing") == (None, None, "missing_utm_campaign")
    confidence = {u: r["attribution_confidence"] for u, r in got.items()}
    assert confidence == {
        "first_day": "high", "last_day": "medium", "too_late": "medium", "no_date": "medium",
        "target": "medium", "wrong_target": "medium", "no_company": "medium", "nothing": "low",
        "referral": "low", "source": "medium",
    }
    assert got["nothing"]["first_touch_resolved_channel"] == "unknown"
    assert got["referral"]["last_touch_attribution_reason"] == "referral_source"
    assert got["source"]["first_touch_attribution_reason"] == "utm_source"
    assert got["last_day"]["has_channel_conflict"] and not got["nothing"]["has_channel_conflict"]
    assert got["nothing"]["missing_utm_flag"] and not got["first_day"]["missing_utm_flag"]


def test_shared_slug_fans_out_like_two_joins(spark, signups, campaigns):
    doubled = campaigns.unionByName(campaigns.withColumn("campaign_id", F.lit("A2")))
    for config in (SKEW, SHUFFLED):
        rows = journeys.user_journeys(signups, doubled, config).where("user_id = 'first_day'")
        assert rows.count() == 4


@pytest.fixture(scope="module")
def skewed(spark):
    """One user with half of the rows, some rows without a user."""
    user = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
        F.concat(F.lit("u"), (F.col("id") % 50).cast("string")))
    return spark.range(2000).select(
        F.concat(F.lit("R"), "id").alias("revenue_id"), user.alias("user_id"),
        F.when(F.col("id") % 3 == 0, "C1").otherwise("C2").alias("company_id"),
        (F.col("id") % 97).cast("decimal(18,2)").alias("revenue_amount"),
        F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias(
            "revenue_month"),
        (F.col("id") % 4 == 0).alias("is_recurring"),
    )


def test_hot_keys_are_few_and_exact(skewed):
    hot = skew.hot_keys(skewed, ["user_id"], replace(SKEW, hot_share=0.2))
    assert [r["user_id"] for r in hot.collect()] == ["hot"]
    everything = skew.hot_keys(skewed, ["user_id"], replace(SKEW, hot_share=0.001)).count()
    assert everything <= 1000


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    right = spark.sql("SELECT 'hot' AS user_id, 1 AS x UNION ALL SELECT 'hot', 2 "
                      "UNION ALL SELECT 'u1', 3 UNION ALL SELECT 'unused', 4 "
                      "UNION ALL SELECT NULL, 5")
    salted = skew.salted_join(skewed, right, ["user_id"], ["revenue_id"], how, config=SHUFFLED)
    plain = skewed.join(right, "user_id", how).select(salted.columns)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_hot_key_is_spread_over_salts(skewed):
    hot = F.broadcast(skew.hot_keys(skewed, ["user_id"], SHUFFLED).withColumn("_hot", F.lit(True)))
    salts = (skewed.join(hot, "user_id").select(skew._spread(["revenue_id"], 5).alias("s"))
             .groupBy("s").count().collect())
    assert len(salts) == 5 and max(r["count"] for r in salts) < 300


def test_cells_summarise_like_records(spark, skewed, campaigns):
    """Pre-aggregated cells give the same totals as the record-grain fact."""
    users = skewed.select("user_id").where("user_id <> 'u3'").distinct()
    hashed = F.pmod(F.xxhash64("user_id"), F.lit(3))
    signups = users.select(
        "user_id", F.lit("2024-01-15").cast("date").alias("signup_date"),
        F.lit("C1").alias("company_id"), F.lit(None).cast("string").alias("referral_source"),
        F.lit("blog").alias("utm_source"), F.lit("m").alias("utm_medium"),
        F.lit("spring").alias("utm_campaign"),
        F.when(hashed == 0, "blog").when(hashed == 1, "podcast").alias("first_touch_channel"),
        F.when(hashed == 1, "blog").alias("last_touch_channel"),
    )
    paths = journeys.user_journeys(signups, campaigns)
    record = attribution.as_cells(
        facts.fct_attributed_revenue(attribution.attributed_revenue(skewed, paths, SHUFFLED)))
    cells = attribution.attribution_cells(skewed, paths)
    for first, last, key in (
        ("first_touch_channel", "last_touch_channel", "channel_key"),
        ("first_touch_campaign_id", "last_touch_campaign_id", "campaign_id"),
    ):
        a = sorted(map(str, facts.touch_totals(record, first, last, key).collect()))
        b = sorted(map(str, facts.touch_totals(cells, first, last, key).collect()))
        assert a == b and a


def test_record_grain_is_kept_and_orphans_are_flagged(skewed, signups, campaigns):
    paths = journeys.user_journeys(signups, campaigns)
    attributed = attribution.attributed_revenue(skewed, paths)
    assert attributed.count() == skewed.count()
    assert attributed.where("NOT missing_journey_flag").count() == 0
    assert attributed.agg(F.sum("revenue_amount")).first() == skewed.agg(
        F.sum("revenue_amount")).first()
