"""Declared types of the four raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S = T.StringType()

RAW_SCHEMAS: dict[str, T.StructType] = {
    "campaign_metadata": _table(
        campaign_id=_S, campaign_name=_S, channel=_S, budget_usd=_MONEY,
        start_date=_S, end_date=_S, target_company_id=_S,
    ),
    "content_performance": _table(
        content_id=_S, channel=_S, publish_date=_S, views=T.LongType(), clicks=T.LongType(),
        utm_source=_S, utm_campaign=_S,
    ),
    "portfolio_revenue": _table(
        revenue_id=_S, company_id=_S, user_id=_S, month=_S, revenue_amount=_MONEY,
        is_recurring=T.BooleanType(),
    ),
    "user_signups": _table(
        user_id=_S, signup_date=_S, company_id=_S, referral_source=_S, utm_source=_S,
        utm_medium=_S, utm_campaign=_S, first_touch_channel=_S, last_touch_channel=_S,
    ),
}

# Default file per raw table, relative to the source folder.
SOURCE_FILES = {
    "campaign_metadata": "campaign_metadata.csv",
    "content_performance": "content_performance.csv",
    "portfolio_revenue": "portfolio_revenue.csv",
    "user_signups": "user_signups.json",
}
