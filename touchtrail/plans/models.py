"""The model graph: every table as a DataFrame over one set of raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from touchtrail.config import SKEW, SkewConfig
from touchtrail.operators import (
    attribution,
    audience,
    cleaning,
    dimensions,
    drilldown,
    facts,
    journeys,
    summaries,
)
from touchtrail.sources.store import materialize

# (table name, planned table) -> the table later models read
Keep = Callable[[str, DataFrame], DataFrame]


def as_planned(name: str, df: DataFrame) -> DataFrame:
    """Keep nothing: later models extend the same lazy plan."""
    return df


def in_scratch(name: str, df: DataFrame) -> DataFrame:
    """Store every table in the session's shared scratch folder."""
    return materialize(df, name)


class Models:
    """Tables by attribute name, planned on first use and passed through ``keep``.

    With a storing ``keep`` each table is computed from stored inputs, and only
    the inputs that are needed get built. ``plan(name)`` gives a table's own plan
    over its (kept) inputs.
    """

    def __init__(
        self, raw: Mapping[str, DataFrame], keep: Keep = as_planned, config: SkewConfig = SKEW
    ) -> None:
        self.raw = raw
        self.keep = keep
        self.config = config

    def plan(self, name: str) -> DataFrame:
        return TABLES[name](self)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        table = self.keep(name, self.plan(name))
        setattr(self, name, table)
        return table

    @property
    def dated(self) -> tuple[DataFrame, ...]:
        """The tables whose dates make the calendar."""
        return (
            self.stg_campaign_metadata, self.stg_content_performance, self.stg_portfolio_revenue,
            self.stg_user_signups,
        )

    @property
    def detail(self) -> DataFrame:
        """Revenue records with company name and month, as the drill-downs read them."""
        return drilldown.revenue_detail(
            self.fct_attributed_revenue, self.dim_company, self.dim_time, self.config
        )

    @property
    def cells(self) -> DataFrame:
        """Revenue for summaries: the stored fact, or pre-aggregated cells when lazy."""
        if self.keep is as_planned:
            return attribution.attribution_cells(
                self.stg_portfolio_revenue, self.int_user_journeys
            )
        return attribution.as_cells(self.fct_attributed_revenue)


# Table name -> plan over the tables it reads, in dependency order.
TABLES: dict[str, Callable[[Models], DataFrame]] = {
    "stg_campaign_metadata": lambda m: cleaning.stage_campaigns(m.raw["campaign_metadata"]),
    "stg_content_performance": lambda m: cleaning.stage_content(m.raw["content_performance"]),
    "stg_portfolio_revenue": lambda m: cleaning.stage_revenue(m.raw["portfolio_revenue"]),
    "stg_user_signups": lambda m: cleaning.stage_signups(m.raw["user_signups"]),
    "int_user_journeys": lambda m: journeys.user_journeys(
        m.stg_user_signups, m.stg_campaign_metadata, m.config
    ),
    "int_attributed_revenue": lambda m: attribution.attributed_revenue(
        m.stg_portfolio_revenue, m.int_user_journeys, m.config
    ),
    "dim_channel": lambda m: dimensions.dim_channel(
        m.stg_campaign_metadata,
        m.stg_content_performance,
        journeys.resolve_touches(m.stg_user_signups),
    ),
    "dim_company": lambda m: dimensions.dim_company(
        m.stg_campaign_metadata, m.stg_portfolio_revenue, m.stg_user_signups
    ),
    "dim_time": lambda m: dimensions.dim_time(dimensions.date_bounds(*m.dated)),
    "dim_user_cohort": lambda m: dimensions.dim_user_cohort(m.stg_user_signups),
    "fct_attributed_revenue": lambda m: facts.fct_attributed_revenue(m.int_attributed_revenue),
    "fct_campaign_roi": lambda m: facts.fct_campaign_roi(m.stg_campaign_metadata, m.cells),
    "fct_content_performance": lambda m: facts.fct_content_performance(
        m.stg_content_performance, m.stg_campaign_metadata, m.config
    ),
    "channel_performance": lambda m: summaries.channel_performance(
        m.dim_channel, m.cells, m.fct_content_performance, m.fct_campaign_roi
    ),
    "campaign_performance": lambda m: summaries.campaign_performance(
        m.fct_campaign_roi, m.dim_channel, m.dim_company, m.dim_time, m.config
    ),
    "company_metrics": lambda m: summaries.company_metrics(m.cells),
    "company_revenue_analysis": lambda m: summaries.company_revenue_analysis(
        m.dim_company, m.company_metrics
    ),
    "monthly_revenue_customer_growth": lambda m: summaries.monthly_revenue_customer_growth(
        m.cells, m.dim_time, m.config
    ),
    "user_numbers": lambda m: audience.number_users(m.detail),
    "audience_cells": lambda m: audience.audience_cells(m.detail, m.user_numbers),
}
