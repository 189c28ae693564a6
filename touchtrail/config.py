"""Vocabularies, thresholds and layer names used by the operators.

Everything here is a default: operators take the vocabulary as a parameter, so
another business can pass its own channels, companies and thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values (must equal the source system's for matching results) -------

SOURCE_NULL = "__SOURCE_NULL__"

UNKNOWN = "unknown"

CHANNEL_ALIASES = {"x": "twitter", "twitter/x": "twitter"}

# channel key -> (display name, group)
CHANNEL_DESCRIPTORS = {
    "youtube": ("YouTube", "social"),
    "twitter": ("Twitter/X", "social"),
    "instagram": ("Instagram", "social"),
    "newsletter": ("Newsletter", "owned_content"),
    "podcast": ("Podcast", "owned_content"),
    "blog": ("Blog", "owned_content"),
    "organic": ("Organic", "organic"),
    "referral": ("Referral", "referral"),
    "direct": ("Direct", "referral"),
    "word_of_mouth": ("Word of Mouth", "referral"),
    "unknown": ("Unknown", "unknown"),
}
OTHER_CHANNEL_GROUP = "other"

# company id -> (display name, industry)
COMPANY_DESCRIPTORS = {
    "CTC-001": ("GreenLeaf Landscaping", "Home Services"),
    "CTC-002": ("BrightPath Education", "Education"),
    "CTC-003": ("QuickFix Auto Repair", "Automotive"),
    "CTC-004": ("Summit Dental Group", "Healthcare"),
}

# Channels campaigns and content are published on, and channels a touch may carry.
PUBLISHED_CHANNELS = ("youtube", "twitter", "instagram", "newsletter", "podcast", "blog")
TOUCH_CHANNELS = PUBLISHED_CHANNELS + ("organic", "referral")

# Referral sources that are never compared with a UTM source.
UNCOMPARED_REFERRALS = ("direct", "word_of_mouth")

# --- End of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class AnomalyConfig:
    """Lagged rolling z-score settings."""

    window: int = 6
    threshold: float = 2.75
    severe_above: float = 3.5
    excluded_keys: tuple[str, ...] = (UNKNOWN,)


@dataclass(frozen=True)
class ForecastConfig:
    """Additive-trend exponential smoothing settings."""

    horizon: int = 6
    holdout: int = 3
    interval_z: float = 1.96
    model_name: str = "holt_exponential_smoothing"
    grid_steps: int = 20
    zoom_rounds: int = 3
    zoom_half_width: int = 5

    @property
    def minimum_history(self) -> int:
        """Shortest series that can be fitted and evaluated."""
        return self.holdout + 3


@dataclass(frozen=True)
class CalendarConfig:
    """Whole months the calendar may span. Dates outside are reported and do not stretch it."""

    first_day: str = "1900-01-01"
    last_day: str = "2199-12-31"


@dataclass(frozen=True)
class SkewConfig:
    """How joins protect themselves from hot keys.

    A key is hot when it holds more than ``hot_share`` of the rows, so a list of
    hot keys never has more than ``1 / hot_share`` entries. From ``crowded`` campaigns of
    one slug and channel on, campaigns are looked up by day through an index.
    """

    hot_share: float = 0.001
    salts: int = 200
    broadcast_rows: int = 200_000
    crowded: int = 32


# Layer -> database name; used verbatim by the table sink.
LAYERS = {
    "raw": "raw",
    "staging": "staging",
    "intermediate": "intermediate",
    "marts": "marts",
    "analytics": "analytics",
    "forecasting": "forecasting",
    "anomaly": "anomaly",
}

ANOMALY = AnomalyConfig()
FORECAST = ForecastConfig()
CALENDAR = CalendarConfig()
SKEW = SkewConfig()
