"""Signup journeys: channel resolution, campaign matching, match quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.config import SKEW, UNKNOWN, SkewConfig
from touchtrail.operators import intervals
from touchtrail.operators.skew import is_small, lookup_join
from touchtrail.sources.store import materialize

TOUCHES = ("first_touch", "last_touch")


def _resolution(touch: str) -> tuple[Column, Column]:
    """(channel, reason): the first populated of touch, UTM source and referral."""
    order = (f"{touch}_channel", "utm_source", "referral_source")
    reason = F.lit(UNKNOWN)
    for name in reversed(order):
        reason = F.when(F.col(name).isNotNull(), F.lit(name)).otherwise(reason)
    return F.coalesce(*[F.col(name) for name in order], F.lit(UNKNOWN)), reason


def resolve_touches(signups: DataFrame) -> DataFrame:
    """Resolved channel and reason of both touches, conflict and missing-UTM flags."""
    first_channel, first_reason = _resolution("first_touch")
    last_channel, last_reason = _resolution("last_touch")
    differs = F.col("first_touch_channel") != F.col("last_touch_channel")
    missing = (
        F.col("utm_source").isNull() | F.col("utm_medium").isNull() | F.col("utm_campaign").isNull()
    )
    return signups.select(
        "user_id",
        "company_id",
        "signup_date",
        "first_touch_channel",
        "last_touch_channel",
        "utm_source",
        "utm_medium",
        "utm_campaign",
        "referral_source",
        first_channel.alias("first_touch_resolved_channel"),
        first_reason.alias("first_touch_attribution_reason"),
        last_channel.alias("last_touch_resolved_channel"),
        last_reason.alias("last_touch_attribution_reason"),
        F.coalesce(differs, F.lit(False)).alias("has_channel_conflict"),
        missing.alias("missing_utm_flag"),
    )


def _campaign_lookup(campaigns: DataFrame, channel_name: str, id_name: str) -> DataFrame:
    """Campaign columns needed by one match, keyed by slug and channel."""
    return campaigns.where(F.col("campaign_slug").isNotNull() & F.col("channel").isNotNull()).select(
        F.col("campaign_slug").alias("utm_campaign"),
        F.col("channel").alias(channel_name),
        F.col("campaign_id").alias(id_name),
        F.col("start_date").alias("_from"),
        F.col("end_date").alias("_to"),
        F.col("target_company_id").alias("_target"),
    )


def match_campaigns(
    touches: DataFrame, campaigns: DataFrame, config: SkewConfig = SKEW
) -> DataFrame:
    """Add the first- and last-touch campaign whose slug, channel, window and target fit.

    A slug shared by several campaigns yields one row per match, as two
    independent left joins do; campaign slugs are checked for uniqueness by the
    quality rules. Where many campaigns share slug and channel, they are met by day.
    """
    if intervals.most_shared(campaigns, ["campaign_slug", "channel"]) >= config.crowded:
        return _match_by_day(touches, campaigns, config)
    small = is_small(campaigns, config)

    def fits(left: DataFrame, right: DataFrame) -> Column:
        in_window = left["signup_date"].between(right["_from"], right["_to"])
        any_company = right["_target"].isNull()
        return in_window & (any_company | (left["company_id"] == right["_target"]))

    matched = touches
    for touch in TOUCHES:
        channel = f"{touch}_resolved_channel"
        found = _campaign_lookup(campaigns, channel, f"{touch}_campaign_id")
        # Hot keys are counted before the first match, not through it.
        matched = lookup_join(
            matched, found, ["utm_campaign", channel], _spread_by(touches), "left", fits, config, small,
            keys_from=touches,
        ).drop("_from", "_to", "_target")
    return matched


def _spread_by(touches: DataFrame) -> list[str]:
    """Columns that differ between rows of a hot key."""
    return ["user_id"] if "user_id" in touches.columns else list(touches.columns)


def _match_by_day(touches: DataFrame, campaigns: DataFrame, config: SkewConfig) -> DataFrame:
    """As the plain matches, through the index of campaign days.

    Distinct (slug, channel, day, company) of the touches find their campaigns; touches then
    take them by those four values. A NULL company matches campaigns open to all, and has a
    value of its own to join by. Where touches are few and their campaigns many, the touches
    go to the campaigns, which are not shuffled.
    """
    company = F.coalesce(F.concat(F.lit("="), F.col("company_id")), F.lit(""))
    left = touches.withColumn("_company", company)
    few = is_small(left, config)
    open_to = F.col("_target").isNull() | (F.concat(F.lit("="), "_target") == F.col("_company"))

    widths: dict[str, list[int]] = {}

    def by(touch: str) -> list[str]:
        return ["utm_campaign", f"{touch}_resolved_channel", "signup_date", "_company"]

    def lookup(touch: str) -> DataFrame:
        return _campaign_lookup(campaigns, f"{touch}_resolved_channel", f"{touch}_campaign_id")

    def met(touch: str, found: DataFrame) -> DataFrame:
        days = left.select(*by(touch)).dropna("any").distinct()
        index = intervals.indexed(found, "_from", "_to")
        return intervals.alive(
            days, index, by(touch)[:2], "signup_date", "_from", "_to", widths.get(touch)
        ).where(open_to)

    # Pairs per looked-up value, by windows: campaigns of one window are counted, not listed.
    pairs: dict[str, DataFrame] = {}
    total = dict.fromkeys(TOUCHES, 0)
    if few:
        for touch in TOUCHES:
            window = [*by(touch)[:2], "_from", "_to", "_target"]
            counts = lookup(touch).groupBy(*window).agg(F.count(F.lit(1)).alias("_pairs"))
            windows = materialize(counts, "campaign-windows")
            in_use = intervals.widths_in_use(intervals.indexed(windows, "_from", "_to"))
            widths[touch] = in_use.first()[0]
            counted = met(touch, windows).groupBy(*by(touch)).agg(F.sum("_pairs").alias("_pairs"))
            pairs[touch] = materialize(counted, "days-met")
            total[touch] = pairs[touch].agg(F.coalesce(F.sum("_pairs"), F.lit(0))).first()[0]

    matched = left
    for touch in sorted(TOUCHES, key=lambda t: -total[t]):
        id_name = f"{touch}_campaign_id"
        found = met(touch, lookup(touch)).select(*by(touch), id_name)
        if few and matched is left and total[touch] > config.broadcast_rows:
            none = F.lit(None).cast(found.schema[id_name].dataType)
            unmet = left.join(F.broadcast(pairs[touch]), by(touch), "left_anti")
            hits = found.join(F.broadcast(left), by(touch)).select(*left.columns, id_name)
            matched = hits.unionByName(unmet.withColumn(id_name, none))
        else:
            small = few and total[touch] <= config.broadcast_rows
            matched = lookup_join(matched, found, by(touch), _spread_by(touches), "left",
                                  config=config, small=small, keys_from=left)
    return matched.select(*touches.columns, *[f"{touch}_campaign_id" for touch in TOUCHES])


def _match_status(touch: str) -> Column:
    return (
        F.when(F.col("utm_campaign").isNull(), "missing_utm_campaign")
        .when(F.col(f"{touch}_campaign_id").isNotNull(), "matched")
        .otherwise("unmatched_or_invalid")
    )


def grade_matches(matched: DataFrame) -> DataFrame:
    """Per-touch and combined match status, and the confidence tier."""
    first = F.col("first_touch_campaign_id").isNotNull()
    last = F.col("last_touch_campaign_id").isNotNull()
    combined = (
        F.when(F.col("utm_campaign").isNull(), "missing_utm_campaign")
        .when(first & last, "matched_both")
        .when(first, "matched_first_touch_only")
        .when(last, "matched_last_touch_only")
        .otherwise("unmatched_or_invalid")
    )

    def either(suffix: str, value: str) -> Column:
        return (F.col(f"first_touch_{suffix}") == value) | (F.col(f"last_touch_{suffix}") == value)

    clean = ~F.col("has_channel_conflict") & ~F.col("missing_utm_flag")
    confidence = (
        F.when(either("resolved_channel", UNKNOWN), "low")
        .when(first & last & clean, "high")
        .when(either("attribution_reason", "referral_source"), "low")
        .otherwise("medium")
    )
    return matched.withColumns(
        {
            "first_touch_campaign_match_status": _match_status("first_touch"),
            "last_touch_campaign_match_status": _match_status("last_touch"),
            "campaign_match_status": combined,
            "attribution_confidence": confidence,
        }
    )


JOURNEY_COLUMNS = (
    "user_id",
    "company_id",
    "signup_date",
    "first_touch_channel",
    "last_touch_channel",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "referral_source",
    "first_touch_resolved_channel",
    "first_touch_attribution_reason",
    "last_touch_resolved_channel",
    "last_touch_attribution_reason",
    "has_channel_conflict",
    "missing_utm_flag",
    "first_touch_campaign_id",
    "last_touch_campaign_id",
    "first_touch_campaign_match_status",
    "last_touch_campaign_match_status",
    "campaign_match_status",
    "attribution_confidence",
)


# All that a journey's matches and grades depend on, and what tells its touches apart.
GRADED_BY = (
    "company_id",
    "signup_date",
    "utm_campaign",
    "first_touch_resolved_channel",
    "first_touch_attribution_reason",
    "last_touch_resolved_channel",
    "last_touch_attribution_reason",
    "has_channel_conflict",
    "missing_utm_flag",
)


def user_journeys(
    signups: DataFrame, campaigns: DataFrame, config: SkewConfig = SKEW, counted: bool = False
) -> DataFrame:
    """One row per signup and pair of campaigns matched, NULL where a touch has none.

    ``counted`` merges signups that agree in all that their matches and grades depend on:
    rows have ``signups``, their number, and not the columns in which they may differ. For
    counts per campaign, where signups x campaigns would be too many rows to list.
    """
    touches = resolve_touches(signups)
    columns = JOURNEY_COLUMNS
    if counted:
        touches = touches.groupBy(*GRADED_BY).agg(F.count(F.lit(1)).alias("signups"))
        kept = {*GRADED_BY, *JOURNEY_COLUMNS[JOURNEY_COLUMNS.index("first_touch_campaign_id"):]}
        columns = (*(c for c in JOURNEY_COLUMNS if c in kept), "signups")
        touches = materialize(touches, "counted-signups")
    graded = grade_matches(match_campaigns(touches, campaigns, config))
    return graded.select(*columns)
