"""The index of day ranges, and the campaign matches that use it."""

from __future__ import annotations

import datetime
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from touchtrail.config import SKEW
from touchtrail.operators import facts, intervals, journeys
from touchtrail.plans import registry

BASE = datetime.date(1999, 12, 20)
CROWDED, PLAIN = replace(SKEW, crowded=1), replace(SKEW, crowded=10**9)
SHUFFLED = replace(PLAIN, broadcast_rows=0)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def days_and_intervals(n, m, longest):
    rng = random.Random(n * m)
    days = [("k" if rng.random() < 0.7 else "other", BASE + datetime.timedelta(rng.randrange(-400, 400))) for _ in range(n)]
    days += [(None, BASE), ("k", None)]
    found = []
    for i in range(m):
        first = BASE + datetime.timedelta(rng.randrange(-400, 400))
        found.append((i, rng.choice(["k", "other", None]), first, first + datetime.timedelta(rng.randrange(-2, longest))))
    found += [(m, "k", None, BASE), (m + 1, "k", BASE, None), (m + 2, "k", BASE, BASE)]
    return days, found


@pytest.mark.parametrize("longest", [1, 5, 64, 900])
def test_alive_finds_exactly_the_intervals_of_a_day(spark, longest):
    days, found = days_and_intervals(150, 200, longest)
    left = spark.createDataFrame(days, "key string, day date")
    right = spark.createDataFrame(found, "id int, key string, first date, last date")
    index = intervals.indexed(right, "first", "last")
    met = intervals.alive(left, index, ["key"], "day", "first", "last").select("key", "day", "id")
    expected = [
        (k, d, i) for k, d in days for i, key, a, b in found
        if None not in (k, d, a, b) and k == key and a <= d <= b
    ]
    assert sorted(map(tuple, met.collect())) == sorted(expected)


def test_days_before_1970(spark):
    day = datetime.date(1969, 12, 30)
    left = spark.createDataFrame([("k", day), ("k", datetime.date(1969, 1, 1))], "key string, day date")
    right = spark.createDataFrame([(1, "k", day, datetime.date(1970, 1, 2))], "id int, key string, first date, last date")
    met = intervals.alive(left, intervals.indexed(right, "first", "last"), ["key"], "day", "first", "last")
    assert [r["day"] for r in met.collect()] == [day]


@pytest.fixture(scope="module")
def touched(spark):
    rng = random.Random(4)
    slugs, channels, companies = ["a", "b", None], ["blog", "podcast"], ["C1", "C2", None]
    touches = [
        (f"u{i % 90}", rng.choice(companies), rng.choice([None, *(BASE + datetime.timedelta(d) for d in range(40))]),
         rng.choice(slugs), rng.choice([*channels, None]), rng.choice(channels))
        for i in range(200)
    ]
    campaigns = []
    for i in range(60):
        first = BASE + datetime.timedelta(rng.randrange(40))
        campaigns.append((f"c{i}", rng.choice(slugs), rng.choice(channels), first,
                          first + datetime.timedelta(rng.randrange(-1, 30)), rng.choice(companies)))
    return (
        spark.createDataFrame(touches, "user_id string, company_id string, signup_date date, utm_campaign string, "
                              "first_touch_resolved_channel string, last_touch_resolved_channel string"),
        spark.createDataFrame(campaigns, "campaign_id string, campaign_slug string, channel string, "
                              "start_date date, end_date date, target_company_id string"),
    )


def test_every_route_matches_the_same_campaigns(touched):
    found = [rows(journeys.match_campaigns(*touched, config)) for config in (PLAIN, SHUFFLED, CROWDED)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 400


def test_few_touches_go_to_their_campaigns(touched):
    few = replace(CROWDED, broadcast_rows=250)  # more than touches, less than matches
    assert rows(journeys.match_campaigns(*touched, few)) == rows(journeys.match_campaigns(*touched, PLAIN))


@pytest.mark.parametrize("config", [PLAIN, SHUFFLED, CROWDED, replace(CROWDED, broadcast_rows=250)])
def test_counted_journeys_stand_for_all_signups(spark, touched, config):
    touches, campaigns = touched
    signups = touches.select(
        "user_id", "company_id", "signup_date", "utm_campaign",
        F.col("first_touch_resolved_channel").alias("first_touch_channel"),
        F.col("last_touch_resolved_channel").alias("last_touch_channel"),
        F.lit("blog").alias("utm_source"), F.substring("user_id", 3, 1).alias("utm_medium"),
        F.lit(None).cast("string").alias("referral_source"),
    )
    signups = signups.unionByName(signups.limit(50))
    by = ["first_touch_campaign_id", "last_touch_campaign_id", "company_id", "attribution_confidence",
          "campaign_match_status"]
    listed = journeys.user_journeys(signups, campaigns, PLAIN).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    counted = journeys.user_journeys(signups, campaigns, config, counted=True)
    assert rows(counted.groupBy(*by).agg(F.sum("signups").alias("n"))) == rows(listed)


def test_few_touches_list_no_signup_per_campaign(spark, touched):
    """40,000 signups alike and 300 campaigns of their slug and day: one row per campaign."""
    day = F.lit("1999-12-25").cast("date")
    campaigns = spark.range(300).select(
        F.col("id").cast("string").alias("campaign_id"), F.lit("s").alias("campaign_slug"), F.lit("blog").alias("channel"),
        day.alias("start_date"), day.alias("end_date"), F.lit(None).cast("string").alias("target_company_id"))
    names = ["utm_source", "utm_medium", "referral_source"]
    signups = spark.range(40_000).select(
        F.concat(F.lit("u"), "id").alias("user_id"), F.lit("C1").alias("company_id"), day.alias("signup_date"),
        F.lit("s").alias("utm_campaign"), F.lit("blog").alias("first_touch_channel"),
        F.lit("podcast").alias("last_touch_channel"), *[F.lit("x").alias(c) for c in names])
    found = journeys.user_journeys(signups, campaigns, counted=True).collect()
    assert len(found) == 300 and {r["signups"] for r in found} == {40_000}


def test_every_route_counts_the_same_content(touched):
    touches, campaigns = touched
    content = touches.select(
        F.col("first_touch_resolved_channel").alias("channel"), "utm_campaign",
        F.col("signup_date").alias("publish_date"), F.lit(2).cast("long").alias("views"), F.lit(1).cast("long").alias("clicks"))
    found = [rows(facts.fct_content_performance(content, campaigns, c)) for c in (PLAIN, SHUFFLED, CROWDED)]
    assert found[0] == found[1] == found[2] and found[0]


def test_a_crowded_slug_examines_about_what_it_matches(spark):
    """100,000 campaigns of one slug and channel: by slug alone every day would meet them all."""
    campaigns = spark.range(100_000).select(
        F.col("id"), F.lit("shared").alias("slug"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") * 7919 % 2400).cast("int")).alias("first"),
        (F.col("id") * 31 % 45).cast("int").alias("length"),
    ).withColumn("last", F.date_add("first", F.col("length")))
    days = spark.range(2400).select(
        F.lit("shared").alias("slug"), F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    index = intervals.indexed(campaigns, "first", "last")
    assert index.count() <= 2 * 100_000
    done = intervals.work(days, index, ["slug"], "day", "first", "last").first()
    assert done["matched"] <= done["examined"] <= 10 * done["matched"]
    assert done["examined"] < 2400 * 100_000 / 10


def test_registered_campaigns_take_the_index(spark, sf_dir):
    from touchtrail.sources.derived import crowded_campaigns

    assert intervals.most_shared(crowded_campaigns(spark, sf_dir), ["campaign_slug", "channel"]) >= SKEW.crowded
    tables = registry.stored(spark, sf_dir)
    assert intervals.most_shared(tables.stg_campaign_metadata, ["campaign_slug", "channel"]) < SKEW.crowded
