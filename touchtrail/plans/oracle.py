"""Independent SQL for the registered queries, over the same test tables.

Each query is assembled from named relations; only the relations it needs are
included. The SQL works at record grain with plain joins and distinct counts, so
it shares none of the pre-aggregation of the Spark plans.
"""

from __future__ import annotations

import re

from touchtrail.config import ANOMALY, CHANNEL_DESCRIPTORS, COMPANY_DESCRIPTORS, FORECAST
from touchtrail.operators.contracts import CONTRACTS
from touchtrail.operators.reconciliation import ANALYTICS_TOTALS, NONNEGATIVE
from touchtrail.operators.quality import PRIMARY_KEYS, REQUIRED
from touchtrail.plans.registry import (
    CHANGED_SERIES,
    CHANNEL_NAMES,
    CHANNELS,
    COMPANIES,
    FIXED_ALPHA,
    FIXED_BETA,
    MOVED_USER,
    PICKED,
    gap_of,
)
from touchtrail.sources import derived
from touchtrail.sources.schemas import RAW_SCHEMAS


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(v if isinstance(v, str) and v.startswith("'") else
                           (_quote(v) if isinstance(v, str) else str(v).lower())
                           for v in values) + ")"


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(_quote(v) for v in values)
    return f"([{listed}])[(({index}) % {len(values)}) + 1]"


def _filled(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _channel(c: str) -> str:
    return f"regexp_replace(lower({_filled(c)}), '^(x|twitter/x)$', 'twitter')"


def _slug(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower(trim({c})), '[^a-z0-9]+', '_', 'g'), '_'), '')"


def _day(c: str) -> str:
    return f"try_cast({_filled(c)} AS DATE)"


def _key(d: str, pattern: str = "%Y%m%d") -> str:
    return f"CAST(strftime({d}, '{pattern}') AS INTEGER)"


def _share(top: str, bottom: str, digits: int) -> str:
    # Adding zero turns a negative zero into a plain one.
    return f"(round(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), {digits}) + 0)"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)


_CHANNEL_ROWS = _values((k, n, g) for k, (n, g) in CHANNEL_DESCRIPTORS.items())
_COMPANY_ROWS = _values((k, n, i) for k, (n, i) in COMPANY_DESCRIPTORS.items())

_USERS = derived.CAMPAIGN_USERS
_EXCLUDED = _in(ANOMALY.excluded_keys)

# relation name -> SQL; a relation may name those above it
RELATIONS: dict[str, str] = {}

RELATIONS["raw_campaign_metadata"] = f"""
  SELECT 'cmp-' || p_partkey || ' ' AS campaign_id,
         'Launch ' || p_partkey || ' / Wave' AS campaign_name,
         {_pick(derived.RAW_PUBLISHED, 'p_partkey')} AS channel,
         CAST(p_retailprice * CASE WHEN p_partkey % 59 = 0 THEN -10 ELSE 10 END AS DECIMAL(18, 2))
           AS budget_usd,
         CAST(DATE '1995-01-01' + CAST(p_partkey % 12 * 60 AS INTEGER) AS VARCHAR) AS start_date,
         CAST(DATE '1995-01-01' + CAST(p_partkey % 12 * 60 + CASE WHEN p_partkey % 53 = 0 THEN -1
              ELSE {derived.CAMPAIGN_DAYS} END AS INTEGER) AS VARCHAR) AS end_date,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'CTC-00' || (p_partkey % 4 + 1) END
           AS target_company_id
  FROM part"""

_CONTENT_CHANNEL = _pick(
    derived.RAW_PUBLISHED, "CASE WHEN l_suppkey % 5 = 0 THEN l_suppkey ELSE l_partkey END"
)
RELATIONS["raw_content_performance"] = f"""
  SELECT 'cnt-' || l_orderkey || '-' || l_linenumber AS content_id,
         {_CONTENT_CHANNEL} AS channel,
         CASE WHEN l_orderkey % 307 = 0 THEN '31/12/1996' ELSE strftime(l_shipdate, '%Y-%m-%d') END
           AS publish_date,
         CASE WHEN l_orderkey % 401 = 0 THEN -1 ELSE 1 END * CAST(l_quantity * 100 AS BIGINT) AS views,
         CASE WHEN l_orderkey % 409 = 0 THEN -1 - CAST(round(l_quantity * l_discount * 100) AS BIGINT)
              ELSE CAST(round(l_quantity * l_discount * 100) AS BIGINT) END AS clicks,
         CASE WHEN l_orderkey % 311 = 0 THEN NULL WHEN l_suppkey % 12 = 0 THEN ''
              ELSE {_CONTENT_CHANNEL} END AS utm_source,
         CASE WHEN l_partkey % 3 = 0 THEN ' ' ELSE 'Launch-' || l_partkey || ' Wave' END
           AS utm_campaign
  FROM lineitem"""

RELATIONS["raw_portfolio_revenue"] = f"""
  SELECT 'rev-' || o_orderkey AS revenue_id,
         CASE WHEN o_orderkey % 31 = 0 AND month IN {_in(derived.SHORT_MONTHS)} THEN 'CTC-007'
              WHEN o_orderkey % 37 = 0 AND month IN {_in(derived.GAPPED_MONTHS)} THEN 'CTC-008'
              ELSE 'CTC-00' || (o_custkey % 4 + 1) END AS company_id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'ghost-' ELSE 'usr-' END || o_custkey AS user_id,
         CASE WHEN o_orderkey % 223 = 0 THEN '1996/07' ELSE month END AS month,
         CAST(CASE WHEN o_orderkey % 211 = 0 THEN -1 ELSE 1 END
              * CAST(o_totalprice AS DECIMAL(18, 2)) AS DECIMAL(18, 2)) AS revenue_amount,
         o_orderpriority <> '1-URGENT' AS is_recurring
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders)"""

_WAVE = f"c_custkey // {_USERS}"
RELATIONS["raw_user_signups"] = f"""
  SELECT 'usr-' || c_custkey AS user_id,
         CASE WHEN c_custkey % 83 = 0 THEN '1995-02-30' ELSE
           coalesce((SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM orders
                     WHERE o_custkey = c_custkey), '') END AS signup_date,
         'CTC-00' || (c_custkey % 4 + 1) AS company_id,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE {_pick(derived.RAW_REFERRAL, 'c_custkey')} END
           AS referral_source,
         CASE WHEN c_custkey % 8 = 0 THEN '' ELSE {_pick(derived.RAW_PUBLISHED, _WAVE)} END
           AS utm_source,
         CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE {_pick(derived.RAW_MEDIUM, 'c_custkey // 7')} END
           AS utm_medium,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'LAUNCH ' || ({_WAVE}) || ' wave!' END
           AS utm_campaign,
         CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 61 = 0 THEN 'Billboard'
              WHEN c_custkey % 13 = 0 THEN 'organic'
              ELSE {_pick(derived.RAW_PUBLISHED, _WAVE)} END AS first_touch_channel,
         CASE WHEN c_custkey % 7 = 0 THEN ' ' WHEN c_custkey % 127 = 0 THEN 'Billboard'
              WHEN c_custkey % 9 < 5 THEN {_pick(derived.RAW_PUBLISHED, _WAVE)}
              ELSE {_pick(derived.RAW_TOUCH, 'c_nationkey')} END AS last_touch_channel
  FROM customer"""

RELATIONS["stg_campaign_metadata"] = f"""
  SELECT upper({_filled('campaign_id')}) AS campaign_id, {_filled('campaign_name')} AS campaign_name,
         {_slug('campaign_name')} AS campaign_slug, {_channel('channel')} AS channel, budget_usd,
         {_day('start_date')} AS start_date, {_day('end_date')} AS end_date,
         upper({_filled('target_company_id')}) AS target_company_id
  FROM raw_campaign_metadata"""

RELATIONS["stg_content_performance"] = f"""
  SELECT upper({_filled('content_id')}) AS content_id, {_channel('channel')} AS channel,
         {_day('publish_date')} AS publish_date,
         CAST(date_trunc('month', {_day('publish_date')}) AS DATE) AS publish_month,
         views, clicks, {_channel('utm_source')} AS utm_source, {_slug('utm_campaign')} AS utm_campaign
  FROM raw_content_performance"""

RELATIONS["stg_portfolio_revenue"] = f"""
  SELECT upper({_filled('revenue_id')}) AS revenue_id, upper({_filled('company_id')}) AS company_id,
         upper({_filled('user_id')}) AS user_id,
         CAST(try_strptime({_filled('month')}, '%Y-%m') AS DATE) AS revenue_month,
         revenue_amount, is_recurring
  FROM raw_portfolio_revenue"""

RELATIONS["stg_user_signups"] = f"""
  SELECT upper({_filled('user_id')}) AS user_id, {_day('signup_date')} AS signup_date,
         CAST(date_trunc('month', {_day('signup_date')}) AS DATE) AS signup_month,
         upper({_filled('company_id')}) AS company_id,
         lower({_filled('referral_source')}) AS referral_source,
         {_channel('utm_source')} AS utm_source, lower({_filled('utm_medium')}) AS utm_medium,
         {_slug('utm_campaign')} AS utm_campaign,
         {_channel('first_touch_channel')} AS first_touch_channel,
         {_channel('last_touch_channel')} AS last_touch_channel
  FROM raw_user_signups"""


def _reason(touch: str) -> str:
    return (
        f"CASE WHEN {touch}_channel IS NOT NULL THEN '{touch}_channel' "
        "WHEN utm_source IS NOT NULL THEN 'utm_source' "
        "WHEN referral_source IS NOT NULL THEN 'referral_source' ELSE 'unknown' END"
    )


RELATIONS["touches"] = f"""
  SELECT * EXCLUDE (signup_month),
         coalesce(first_touch_channel, utm_source, referral_source, 'unknown')
           AS first_touch_resolved_channel,
         {_reason('first_touch')} AS first_touch_attribution_reason,
         coalesce(last_touch_channel, utm_source, referral_source, 'unknown')
           AS last_touch_resolved_channel,
         {_reason('last_touch')} AS last_touch_attribution_reason,
         first_touch_channel IS NOT NULL AND last_touch_channel IS NOT NULL
           AND first_touch_channel IS DISTINCT FROM last_touch_channel AS has_channel_conflict,
         utm_source IS NULL OR utm_medium IS NULL OR utm_campaign IS NULL AS missing_utm_flag
  FROM stg_user_signups"""


def _fit(alias: str, touch: str) -> str:
    return (
        f"{alias}.campaign_slug = t.utm_campaign AND {alias}.channel = t.{touch}_resolved_channel "
        f"AND t.signup_date >= {alias}.start_date AND t.signup_date <= {alias}.end_date "
        f"AND ({alias}.target_company_id IS NULL OR {alias}.target_company_id = t.company_id)"
    )


def _status(touch: str) -> str:
    return (
        f"CASE WHEN utm_campaign IS NULL THEN 'missing_utm_campaign' "
        f"WHEN {touch}_campaign_id IS NULL THEN 'unmatched_or_invalid' ELSE 'matched' END"
    )


RELATIONS["int_user_journeys"] = f"""
  SELECT *, {_status('first_touch')} AS first_touch_campaign_match_status,
         {_status('last_touch')} AS last_touch_campaign_match_status,
         CASE WHEN utm_campaign IS NULL THEN 'missing_utm_campaign'
              ELSE (['unmatched_or_invalid', 'matched_last_touch_only', 'matched_first_touch_only',
                     'matched_both'])[1 + CAST(last_touch_campaign_id IS NOT NULL AS INTEGER)
                                        + 2 * CAST(first_touch_campaign_id IS NOT NULL AS INTEGER)]
         END AS campaign_match_status,
         CASE WHEN 'unknown' IN (first_touch_resolved_channel, last_touch_resolved_channel) THEN 'low'
              WHEN first_touch_campaign_id IS NOT NULL AND last_touch_campaign_id IS NOT NULL
                   AND NOT (has_channel_conflict OR missing_utm_flag) THEN 'high'
              WHEN 'referral_source' IN (first_touch_attribution_reason, last_touch_attribution_reason)
                   THEN 'low'
              ELSE 'medium' END AS attribution_confidence
  FROM (SELECT t.*, f.campaign_id AS first_touch_campaign_id, l.campaign_id AS last_touch_campaign_id
        FROM touches t
        LEFT JOIN stg_campaign_metadata f ON {_fit('f', 'first_touch')}
        LEFT JOIN stg_campaign_metadata l ON {_fit('l', 'last_touch')})"""

_CARRIED = (
    "signup_date, first_touch_channel, last_touch_channel, first_touch_resolved_channel, "
    "last_touch_resolved_channel, first_touch_attribution_reason, last_touch_attribution_reason, "
    "first_touch_campaign_id AS first_touch_campaign, last_touch_campaign_id AS last_touch_campaign, "
    "has_channel_conflict, missing_utm_flag, first_touch_campaign_match_status, "
    "last_touch_campaign_match_status, campaign_match_status, attribution_confidence"
)
RELATIONS["int_attributed_revenue"] = f"""
  SELECT r.revenue_id, r.user_id, r.company_id, r.revenue_amount, r.revenue_month, r.is_recurring,
         j.* EXCLUDE (journey_user), j.journey_user IS NULL AS missing_journey_flag
  FROM stg_portfolio_revenue r
  LEFT JOIN (SELECT user_id AS journey_user, {_CARRIED} FROM int_user_journeys) j
    ON j.journey_user = r.user_id"""

RELATIONS["dim_channel"] = f"""
  SELECT k.channel_key, coalesce(d.name, replace(k.channel_key, '_', ' ')) AS channel_name,
         coalesce(d.grp, 'other') AS channel_group
  FROM (SELECT DISTINCT unnest([a, b]) AS channel_key FROM (
          SELECT channel AS a, 'unknown' AS b FROM stg_campaign_metadata
          UNION ALL SELECT channel, 'unknown' FROM stg_content_performance
          UNION ALL SELECT first_touch_resolved_channel, last_touch_resolved_channel FROM touches)) k
  LEFT JOIN (VALUES {_CHANNEL_ROWS}) d(channel_key, name, grp) USING (channel_key)
  WHERE k.channel_key IS NOT NULL"""

RELATIONS["dim_company"] = f"""
  SELECT k.company_id, d.name AS company_name, d.industry
  FROM (SELECT company_id FROM stg_user_signups UNION SELECT company_id FROM stg_portfolio_revenue
        UNION SELECT target_company_id FROM stg_campaign_metadata
              WHERE target_company_id IS NOT NULL) k
  LEFT JOIN (VALUES {_COMPANY_ROWS}) d(company_id, name, industry) USING (company_id)"""

RELATIONS["dim_time"] = f"""
  SELECT {_key('d')} AS date_key, d AS date_day,
         d - CAST(isodow(d) - 1 AS INTEGER) AS week_start_date,
         d - CAST(day(d) - 1 AS INTEGER) AS month_start_date,
         {_key('d', '%Y%m')} AS month_key, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
         CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS year_number,
         CAST(isodow(d) AS INTEGER) AS iso_day_of_week, isodow(d) > 5 AS is_weekend
  FROM (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT CAST(min(x) AS TIMESTAMP) AS lo, CAST(max(x) AS TIMESTAMP) AS hi FROM (
          SELECT publish_date AS x FROM stg_content_performance
          UNION ALL SELECT signup_date FROM stg_user_signups
          UNION ALL SELECT revenue_month FROM stg_portfolio_revenue
          UNION ALL SELECT unnest([start_date, end_date]) FROM stg_campaign_metadata)))"""

RELATIONS["dim_user_cohort"] = f"""
  SELECT {_key('m', '%Y%m')} AS cohort_key, m AS cohort_month, strftime(m, '%Y-%m') AS cohort_label,
         CAST(month(m) AS INTEGER) AS cohort_month_number, CAST(quarter(m) AS INTEGER) AS cohort_quarter,
         CAST(year(m) AS INTEGER) AS cohort_year
  FROM (SELECT signup_month AS m FROM stg_user_signups GROUP BY ALL) WHERE m IS NOT NULL"""

RELATIONS["fct_attributed_revenue"] = f"""
  SELECT revenue_id, user_id, company_id, {_key('revenue_month')} AS revenue_date_key,
         {_key('signup_date')} AS signup_date_key, {_key('signup_date', '%Y%m')} AS cohort_key,
         first_touch_resolved_channel AS first_touch_channel,
         last_touch_resolved_channel AS last_touch_channel,
         first_touch_campaign AS first_touch_campaign_id,
         last_touch_campaign AS last_touch_campaign_id,
         first_touch_attribution_reason, last_touch_attribution_reason, revenue_amount, is_recurring,
         has_channel_conflict, missing_utm_flag, first_touch_campaign_match_status,
         last_touch_campaign_match_status, campaign_match_status, attribution_confidence
  FROM int_attributed_revenue"""


def _by(key: str, name: str, prefix: str, where: str = "") -> str:
    return f"""(SELECT {key} AS {name}, sum(revenue_amount) AS {prefix}_revenue,
           count(DISTINCT user_id) AS {prefix}_customers, count(*) AS {prefix}_records
           FROM fct_attributed_revenue {where} GROUP BY {key})"""


RELATIONS["fct_campaign_roi"] = f"""
  SELECT campaign_id, channel, target_company_id, {_key('start_date')} AS start_date_key,
         {_key('end_date')} AS end_date_key, budget_usd,
         f_rev AS first_touch_attributed_revenue, l_rev AS last_touch_attributed_revenue,
         f_cust AS first_touch_customers, l_cust AS last_touch_customers,
         {_share('f_rev', 'budget_usd', 4)} AS first_touch_roas,
         {_share('l_rev', 'budget_usd', 4)} AS last_touch_roas,
         {_share('(f_rev - budget_usd)', 'budget_usd', 4)} AS first_touch_roi,
         {_share('(l_rev - budget_usd)', 'budget_usd', 4)} AS last_touch_roi
  FROM (SELECT c.*, coalesce(f.f_revenue, 0) AS f_rev, coalesce(l.l_revenue, 0) AS l_rev,
               coalesce(f.f_customers, 0) AS f_cust, coalesce(l.l_customers, 0) AS l_cust
        FROM stg_campaign_metadata c
        LEFT JOIN {_by('first_touch_campaign_id', 'campaign_id', 'f')} f USING (campaign_id)
        LEFT JOIN {_by('last_touch_campaign_id', 'campaign_id', 'l')} l USING (campaign_id))"""

RELATIONS["fct_content_performance"] = f"""
  SELECT md5(concat(CAST(publish_month AS VARCHAR), '|', channel, '|',
                    coalesce(campaign_id, 'NO_CAMPAIGN'))) AS content_performance_key,
         {_key('publish_month')} AS publish_month_date_key, channel, campaign_id,
         count(*) AS content_count, CAST(sum(views) AS BIGINT) AS views,
         CAST(sum(clicks) AS BIGINT) AS clicks,
         {_share('sum(clicks)', 'sum(views)', 6)} AS click_through_rate
  FROM (SELECT x.publish_month, x.channel, c.campaign_id, x.views, x.clicks
        FROM stg_content_performance x
        LEFT JOIN stg_campaign_metadata c
          ON c.campaign_slug = x.utm_campaign AND c.channel = x.channel
         AND x.publish_date BETWEEN c.start_date AND c.end_date)
  GROUP BY publish_month, channel, campaign_id"""

RELATIONS["channel_performance"] = f"""
  SELECT d.channel_key, d.channel_name, d.channel_group,
         coalesce(f_revenue, 0) AS first_touch_revenue, coalesce(l_revenue, 0) AS last_touch_revenue,
         coalesce(f_customers, 0) AS first_touch_customers,
         coalesce(l_customers, 0) AS last_touch_customers,
         coalesce(f_records, 0) AS first_touch_revenue_records,
         coalesce(l_records, 0) AS last_touch_revenue_records,
         CAST(coalesce(n_items, 0) AS BIGINT) AS content_count,
         CAST(coalesce(n_views, 0) AS BIGINT) AS views,
         CAST(coalesce(n_clicks, 0) AS BIGINT) AS clicks,
         {_share('coalesce(n_clicks, 0)', 'coalesce(n_views, 0)', 6)} AS click_through_rate,
         coalesce(n_campaigns, 0) AS campaign_count,
         coalesce(budget, 0) AS campaign_budget_usd
  FROM dim_channel d
  LEFT JOIN {_by('first_touch_channel', 'channel_key', 'f')} f USING (channel_key)
  LEFT JOIN {_by('last_touch_channel', 'channel_key', 'l')} l USING (channel_key)
  LEFT JOIN (SELECT channel AS channel_key, sum(content_count) AS n_items, sum(views) AS n_views,
                    sum(clicks) AS n_clicks FROM fct_content_performance GROUP BY 1) c
    USING (channel_key)
  LEFT JOIN (SELECT channel AS channel_key, count(*) AS n_campaigns, sum(budget_usd) AS budget
             FROM fct_campaign_roi GROUP BY 1) b USING (channel_key)"""

RELATIONS["campaign_performance"] = f"""
  SELECT r.campaign_id, r.channel AS channel_key, ch.channel_name, r.target_company_id,
         co.company_name AS target_company_name, s.date_day AS start_date, e.date_day AS end_date,
         r.budget_usd, r.first_touch_attributed_revenue, r.last_touch_attributed_revenue,
         r.first_touch_customers, r.last_touch_customers, r.first_touch_roas, r.last_touch_roas,
         r.first_touch_roi, r.last_touch_roi,
         {_share('r.budget_usd', 'r.first_touch_customers', 2)} AS first_touch_cost_per_customer,
         {_share('r.budget_usd', 'r.last_touch_customers', 2)} AS last_touch_cost_per_customer,
         r.last_touch_attributed_revenue - r.first_touch_attributed_revenue
           AS attribution_revenue_difference
  FROM fct_campaign_roi r
  JOIN dim_channel ch ON ch.channel_key = r.channel
  LEFT JOIN dim_company co ON co.company_id = r.target_company_id
  JOIN dim_time s ON s.date_key = r.start_date_key
  JOIN dim_time e ON e.date_key = r.end_date_key"""

RELATIONS["company_revenue_analysis"] = f"""
  SELECT company_id, company_name, industry, coalesce(total, 0) AS total_revenue,
         coalesce(recurring, 0) AS recurring_revenue, coalesce(initial, 0) AS initial_revenue,
         coalesce(records, 0) AS revenue_record_count, coalesce(users, 0) AS customer_count,
         coalesce(firsts, 0) AS first_touch_channel_count,
         coalesce(lasts, 0) AS last_touch_channel_count,
         coalesce(first_campaign, 0) AS first_touch_campaign_revenue,
         coalesce(last_campaign, 0) AS last_touch_campaign_revenue,
         {_share('coalesce(total, 0)', 'coalesce(users, 0)', 2)} AS average_revenue_per_customer,
         {_share('coalesce(total, 0)', 'sum(total) OVER ()', 6)} AS portfolio_revenue_share
  FROM dim_company LEFT JOIN (
    SELECT company_id, sum(revenue_amount) AS total,
           coalesce(sum(revenue_amount) FILTER (WHERE is_recurring), 0) AS recurring,
           coalesce(sum(revenue_amount) FILTER (WHERE NOT is_recurring), 0) AS initial,
           count(*) AS records, count(DISTINCT user_id) AS users,
           count(DISTINCT first_touch_channel) AS firsts, count(DISTINCT last_touch_channel) AS lasts,
           sum(revenue_amount) FILTER (WHERE first_touch_campaign_id IS NOT NULL) AS first_campaign,
           sum(revenue_amount) FILTER (WHERE last_touch_campaign_id IS NOT NULL) AS last_campaign
    FROM fct_attributed_revenue GROUP BY company_id) USING (company_id)"""

RELATIONS["monthly_revenue_customer_growth"] = f"""
  SELECT month_key, month_date_key, month_start_date, total_revenue, recurring_revenue,
         initial_revenue, revenue_record_count, active_customers, new_customers,
         total_revenue - before_revenue AS revenue_change,
         {_share('(total_revenue - before_revenue)', 'before_revenue', 6)} AS revenue_growth_rate,
         active_customers - before_customers AS customer_change,
         {_share('(active_customers - before_customers)', 'before_customers', 6)}
           AS customer_growth_rate
  FROM (SELECT *, lag(total_revenue) OVER m AS before_revenue,
               lag(active_customers) OVER m AS before_customers
        FROM (SELECT t.month_key, t.month_start_date, min(r.revenue_date_key) AS month_date_key,
                     sum(r.revenue_amount) AS total_revenue,
                     coalesce(sum(r.revenue_amount) FILTER (WHERE r.is_recurring), 0)
                       AS recurring_revenue,
                     coalesce(sum(r.revenue_amount) FILTER (WHERE NOT r.is_recurring), 0)
                       AS initial_revenue,
                     count(*) AS revenue_record_count, count(DISTINCT r.user_id) AS active_customers,
                     count(DISTINCT r.user_id) FILTER (WHERE r.cohort_key = t.month_key)
                       AS new_customers
              FROM fct_attributed_revenue r JOIN dim_time t ON t.date_key = r.revenue_date_key
              GROUP BY t.month_key, t.month_start_date)
        WINDOW m AS (ORDER BY month_key))"""

RELATIONS["panel"] = f"""
  SELECT m.month_start_date, c.channel_key AS channel,
         coalesce(CAST(sum(r.revenue_amount) AS DOUBLE), 0.0) AS monthly_revenue
  FROM monthly_revenue_customer_growth m CROSS JOIN channel_performance c
  LEFT JOIN (SELECT t.month_start_date, f.last_touch_channel, f.revenue_amount
             FROM fct_attributed_revenue f JOIN dim_time t ON t.date_key = f.revenue_date_key) r
    ON r.month_start_date = m.month_start_date AND r.last_touch_channel = c.channel_key
  WHERE lower(c.channel_key) NOT IN {_EXCLUDED}
  GROUP BY m.month_start_date, c.channel_key"""

_W = ANOMALY.window
RELATIONS["baseline"] = f"""
  SELECT month_start_date, channel, monthly_revenue, rolling_mean, rolling_std
  FROM (SELECT *, avg(monthly_revenue) OVER w AS rolling_mean,
               stddev_pop(monthly_revenue) OVER w AS rolling_std, count(*) OVER w AS seen
        FROM panel
        WINDOW w AS (PARTITION BY channel ORDER BY month_start_date
                     ROWS BETWEEN {_W} PRECEDING AND 1 PRECEDING))
  WHERE seen = {_W}"""

_MONEY = "'$' || format('{{:,.0f}}', {})"


def _money(x: str) -> str:
    return _MONEY.format(x)


_LABEL = (
    "array_to_string(list_transform(string_split(channel, '_'), "
    "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
)
RELATIONS["anomalies"] = f"""
  SELECT *, CASE WHEN NOT is_anomaly
       THEN {_LABEL} || ' revenue in ' || strftime(month_start_date, '%b %Y')
            || ' was close to the {_W}-month baseline (actual ' || {_money('monthly_revenue')}
            || ' vs expected ' || {_money('expected_revenue')} || ').'
       ELSE {_LABEL} || ' revenue in ' || strftime(month_start_date, '%b %Y') || ' was '
            || coalesce(format('{{:.1f}}', abs(deviation_percent)) || '%', 'n/a')
            || CASE WHEN z_score > 0 THEN ' above' ELSE ' below' END
            || ' the {_W}-month average (actual ' || {_money('monthly_revenue')} || ' vs expected '
            || {_money('expected_revenue')} || ', difference ' || {_money('revenue_difference')}
            || '). This is a ' || severity || ' ' || anomaly_direction || ' anomaly (z='
            || format('{{:.2f}}', z_score) || ', rank ' || anomaly_rank || ').' END AS explanation
  FROM (SELECT *, CASE WHEN NOT is_anomaly THEN 'normal'
                       WHEN abs(z_score) > {ANOMALY.severe_above} THEN 'severe'
                       ELSE 'moderate' END AS severity,
               CASE WHEN NOT is_anomaly THEN 'normal' WHEN z_score > 0 THEN 'positive'
                    ELSE 'negative' END AS anomaly_direction,
               CASE WHEN is_anomaly THEN CAST(row_number() OVER (
                 PARTITION BY is_anomaly ORDER BY abs(z_score) DESC, channel, month_start_date)
                 AS INTEGER) END AS anomaly_rank
        FROM (SELECT *, coalesce(abs(z_score) >= {ANOMALY.threshold}, false) AS is_anomaly
              FROM (SELECT month_start_date, channel, monthly_revenue,
                           rolling_mean AS expected_revenue,
                           monthly_revenue - rolling_mean AS revenue_difference,
                           rolling_mean, rolling_std,
                           (monthly_revenue - rolling_mean) / nullif(rolling_std, 0) AS z_score,
                           (monthly_revenue - rolling_mean) / nullif(rolling_mean, 0) * 100
                             AS deviation_percent
                    FROM baseline)))"""

RELATIONS["odd_panel"] = """
  SELECT month_start_date, channel,
         CASE channel WHEN 'blog' THEN 250.0
              WHEN 'podcast' THEN CASE WHEN i % 7 = 6 THEN 10000.0 WHEN i % 2 = 0 THEN 100.0 ELSE -100.0 END
              ELSE monthly_revenue END AS monthly_revenue
  FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY month_start_date) - 1 AS i FROM panel)"""
RELATIONS["odd_baseline"] = re.sub(r"\bpanel\b", "odd_panel", RELATIONS["baseline"])
RELATIONS["odd_anomalies"] = re.sub(r"\bbaseline\)", "odd_baseline)", RELATIONS["anomalies"])

RELATIONS["detail"] = """
  SELECT f.revenue_id, f.user_id, f.company_id, c.company_name, t.date_day AS revenue_month,
         f.first_touch_channel, f.last_touch_channel, f.revenue_amount
  FROM fct_attributed_revenue f JOIN dim_company c ON c.company_id = f.company_id
  JOIN dim_time t ON t.date_key = f.revenue_date_key"""

_TOUCHED = f"(first_touch_channel IN {_in(CHANNELS)} OR last_touch_channel IN {_in(CHANNELS)})"
RELATIONS["chosen_detail"] = f"""
  SELECT * FROM detail WHERE company_id IN {_in(COMPANIES)} AND {_TOUCHED}"""


def _chosen(touch: str, prefix: str) -> str:
    return f"""(SELECT {touch}_channel AS channel_key, sum(revenue_amount) AS {prefix}_revenue,
           count(DISTINCT user_id) AS {prefix}_customers
           FROM detail WHERE company_id IN {_in(COMPANIES)} GROUP BY 1)"""


RELATIONS["chosen_channels"] = f"""
  SELECT p.channel_key, channel_name, channel_group, campaign_budget_usd, click_through_rate, views,
         clicks, campaign_count, coalesce(f_revenue, 0) AS first_touch_revenue,
         coalesce(l_revenue, 0) AS last_touch_revenue,
         coalesce(f_customers, 0) AS first_touch_customers,
         coalesce(l_customers, 0) AS last_touch_customers
  FROM channel_performance p
  LEFT JOIN {_chosen('first_touch', 'f')} f USING (channel_key)
  LEFT JOIN {_chosen('last_touch', 'l')} l USING (channel_key)"""

RELATIONS["chosen_campaigns"] = f"""
  SELECT * FROM campaign_performance
  WHERE (target_company_id IS NULL OR target_company_id IN {_in(COMPANIES)})
    AND channel_key IN {_in(CHANNELS)}"""

RELATIONS["named_anomalies"] = """
  SELECT a.*, coalesce(c.channel_name, a.channel) AS channel_name
  FROM anomalies a LEFT JOIN channel_performance c ON c.channel_key = a.channel
  WHERE lower(a.channel) <> 'unknown'"""

RELATIONS["series"] = """
  SELECT 'portfolio' AS k, month_start_date AS m, CAST(total_revenue AS DOUBLE) AS v
  FROM monthly_revenue_customer_growth
  UNION ALL SELECT channel, month_start_date, monthly_revenue FROM panel
  UNION ALL SELECT company_id, t.month_start_date, CAST(sum(revenue_amount) AS DOUBLE)
            FROM fct_attributed_revenue f JOIN dim_time t ON t.date_key = f.revenue_date_key
            WHERE company_id IS NOT NULL GROUP BY 1, 2"""

RELATIONS["numbered"] = """
  SELECT k, m, v, row_number() OVER (PARTITION BY k ORDER BY m) AS i FROM series
  WHERE k IN (SELECT k FROM series GROUP BY k
              HAVING count(*) >= 6 AND date_diff('month', min(m), max(m)) + 1 = count(*))"""

RELATIONS["training"] = f"""
  SELECT k, v, i FROM numbered
  WHERE i <= (SELECT max(x.i) FROM numbered x WHERE x.k = numbered.k) - {FORECAST.holdout}"""

_A, _B = f"{FIXED_ALPHA}::DOUBLE", f"{FIXED_BETA}::DOUBLE"


def _with(needed: str, recursive: str = "") -> str:
    """WITH clause holding the relations the text needs, directly or not."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                visit(RELATIONS[name])

    visit(needed + recursive)
    parts = [f"{n} AS ({sql})" for n, sql in RELATIONS.items() if n in wanted]
    if recursive:
        return "WITH RECURSIVE " + ",\n".join([*parts, recursive]) + "\n"
    return "WITH " + ",\n".join(parts) + "\n"


def _select(body: str) -> str:
    return _with(body) + body


def _table(
    name: str, money: str = "", dates: str = "", rounded: dict[str, int] | None = None
) -> str:
    """All columns of a relation: money as doubles, dates as text, doubles rounded."""
    changes = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    changes += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    changes += [f"round({c}, {n}) AS {c}" for c, n in (rounded or {}).items()]
    replaced = f" REPLACE ({', '.join(changes)})" if changes else ""
    return _select(f"SELECT *{replaced} FROM {name}")


# Revenue that the earlier version lacked, or had with other amounts.
_NUMBER = "CAST(regexp_extract(revenue_id, '[0-9]+') AS BIGINT)"
_MISSING = f"coalesce(revenue_month = DATE '1996-03-01' AND {_NUMBER} % 3 = 0, false)"
_OTHER_AMOUNT = f"coalesce(revenue_month = DATE '1995-07-01' AND {_NUMBER} % 5 = 0, false)"

_CROWDED = """(
  SELECT 'cmp-' || l_orderkey || '-' || l_linenumber AS id, CAST(l_shipdate AS DATE) AS a,
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 7 AS INTEGER) AS b,
         CASE WHEN l_partkey % 3 <> 0 THEN 'CTC-00' || (l_partkey % 4 + 1) END AS target
  FROM lineitem)"""

_ANOMALY_DIGITS = {
    "monthly_revenue": 2, "expected_revenue": 4, "revenue_difference": 4, "rolling_mean": 4,
    "rolling_std": 4, "z_score": 6, "deviation_percent": 6,
}


# -- quality -------------------------------------------------------------------------


def _gaps_report() -> str:
    rows = []
    for table, columns in REQUIRED.items():
        number = f"CAST(regexp_extract({PRIMARY_KEYS[table]}, '[0-9]+') AS BIGINT)"
        for c in columns:
            text = RAW_SCHEMAS[table][c].dataType.simpleString() == "string"
            empty = f"{c} IS NULL" + (f" OR trim({c}) = ''" if text else "")
            rows.append(
                f"SELECT 'required_value_{table}_{c}' AS check_name, count(*) AS n "
                f"FROM raw_{table} WHERE {number} % {gap_of(table, c)} = 0 OR {empty}")
    return _select(
        "SELECT check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS issue_count "
        f"FROM ({' UNION ALL '.join(rows)})")


def _raw_checks() -> str:
    """(check, severity, good, bad, count) rows of every value rule."""
    rows: list[str] = []

    def add(name: str, severity: str, good: str, bad: str, count: str) -> None:
        rows.append(
            f"SELECT {_quote(name)} AS check_name, {_quote(severity)} AS severity, "
            f"{_quote(good)} AS good, {_quote(bad)} AS bad, CAST(({count}) AS BIGINT) AS issue_count"
        )

    def where(table: str, condition: str) -> str:
        return f"SELECT count(*) FROM raw_{table} WHERE {condition}"

    def blank(c: str) -> str:
        return f"({c} IS NULL OR trim({c}) = '')"

    def filled(c: str) -> str:
        return f"({c} IS NOT NULL AND trim({c}) <> '')"

    required = {
        "campaign_metadata": "campaign_id campaign_name budget_usd start_date end_date",
        "content_performance": "content_id publish_date views clicks",
        "portfolio_revenue": "revenue_id company_id user_id month revenue_amount is_recurring",
        "user_signups": "user_id signup_date company_id",
    }
    for table, columns in required.items():
        for c in columns.split():
            text = RAW_SCHEMAS[table][c].dataType.simpleString() == "string"
            add(f"required_value_{table}_{c}", "FAIL", f"raw.{table}.{c} has no missing values",
                f"raw.{table}.{c} has missing values",
                where(table, blank(c) if text else f"{c} IS NULL"))
    for table, columns in required.items():
        c = columns.split()[0]
        add(f"duplicate_primary_key_{table}", "FAIL", f"raw.{table}.{c} is unique",
            f"raw.{table}.{c} contains duplicate keys",
            f"SELECT count(*) FROM (SELECT {c} FROM raw_{table} GROUP BY {c} HAVING count(*) > 1)")
    for name, table, c in (
        ("campaign_start_date", "campaign_metadata", "start_date"),
        ("campaign_end_date", "campaign_metadata", "end_date"),
        ("content_publish_date", "content_performance", "publish_date"),
        ("signup_date", "user_signups", "signup_date"),
    ):
        add(f"valid_date_{name}", "FAIL", f"raw.{table}.{c} contains valid dates",
            f"raw.{table}.{c} contains invalid dates",
            where(table, f"{filled(c)} AND try_cast({c} AS DATE) IS NULL"))
    add("valid_date_revenue_month", "FAIL",
        "raw.portfolio_revenue.month contains valid YYYY-MM values",
        "raw.portfolio_revenue.month contains invalid YYYY-MM values",
        where("portfolio_revenue", f"{filled('month')} AND try_strptime(month, '%Y-%m') IS NULL"))
    add("valid_campaign_date_range", "FAIL",
        "All campaign start dates are on or before end dates",
        "Campaign start date occurs after end date",
        where("campaign_metadata", "try_cast(start_date AS DATE) > try_cast(end_date AS DATE)"))
    for name, table, c in (
        ("campaign_budget", "campaign_metadata", "budget_usd"),
        ("content_views", "content_performance", "views"),
        ("content_clicks", "content_performance", "clicks"),
        ("revenue_amount", "portfolio_revenue", "revenue_amount"),
    ):
        add(f"nonnegative_{name}", "FAIL", f"raw.{table}.{c} is non-negative",
            f"raw.{table}.{c} contains negative values", where(table, f"{c} < 0"))
    add("revenue_user_exists", "FAIL", "Every revenue user_id exists in raw.user_signups",
        "Revenue rows reference an unknown user_id",
        "SELECT count(*) FROM raw_portfolio_revenue r WHERE NOT EXISTS "
        "(SELECT 1 FROM raw_user_signups s WHERE s.user_id = r.user_id)")
    companies = _in(COMPANY_DESCRIPTORS)
    add("valid_revenue_company", "FAIL", "Every revenue company_id is valid",
        "Revenue rows reference an invalid company_id",
        where("portfolio_revenue", f"company_id NOT IN {companies}"))
    add("valid_signup_company", "FAIL", "Every signup company_id is valid",
        "Signup rows reference an invalid company_id",
        where("user_signups", f"company_id NOT IN {companies}"))
    add("valid_campaign_target_company", "FAIL",
        "Every populated campaign target_company_id is valid",
        "Campaign rows reference an invalid target_company_id",
        where("campaign_metadata",
              f"{filled('target_company_id')} AND target_company_id NOT IN {companies}"))
    for name, table, c in (
        ("content_utm_source", "content_performance", "utm_source"),
        ("content_utm_campaign", "content_performance", "utm_campaign"),
        ("signup_utm_source", "user_signups", "utm_source"),
        ("signup_utm_medium", "user_signups", "utm_medium"),
        ("signup_utm_campaign", "user_signups", "utm_campaign"),
        ("campaign_channel", "campaign_metadata", "channel"),
        ("content_channel", "content_performance", "channel"),
        ("signup_first_touch_channel", "user_signups", "first_touch_channel"),
        ("signup_last_touch_channel", "user_signups", "last_touch_channel"),
    ):
        add(f"missing_attribution_{name}", "WARN", f"raw.{table}.{c} has no missing values",
            f"raw.{table}.{c} has missing values", where(table, blank(c)))

    def conflict(a: str, b: str) -> str:
        return f"{filled(a)} AND {filled(b)} AND lower({a}) <> lower({b})"

    add("conflicting_first_last_touch", "WARN",
        "First-touch and last-touch channels agree for all signups",
        "Signups have different first-touch and last-touch channels",
        where("user_signups", conflict("first_touch_channel", "last_touch_channel")))
    add("conflicting_utm_first_touch", "WARN",
        "Populated UTM sources agree with first-touch channels",
        "Signups have conflicting UTM source and first-touch channel",
        where("user_signups", conflict("utm_source", "first_touch_channel")))
    add("conflicting_referral_utm", "WARN",
        "Comparable referral sources agree with populated UTM sources",
        "Signups have conflicting referral and UTM sources",
        where("user_signups", conflict("referral_source", "utm_source")
              + " AND lower(referral_source) NOT IN ('direct', 'word_of_mouth')"))
    return "\nUNION ALL ".join(rows)


def _raw_report() -> str:
    body = _raw_checks()
    return _with(body) + f"""SELECT check_name, CASE WHEN issue_count = 0 THEN 'PASS' ELSE severity END
      AS status, issue_count, CASE WHEN issue_count = 0 THEN good
      ELSE bad || ': ' || format('{{:,}}', issue_count) || ' row(s)' END AS message
    FROM ({body})"""


# Column lists of the stored tables, in the order the contracts name them.
_COLUMNS = {
    "stg_campaign_metadata": "campaign_id campaign_name campaign_slug channel budget_usd start_date "
    "end_date target_company_id",
    "stg_content_performance": "content_id channel publish_date publish_month views clicks utm_source "
    "utm_campaign",
    "stg_portfolio_revenue": "revenue_id company_id user_id revenue_month revenue_amount is_recurring",
    "stg_user_signups": "user_id signup_date signup_month company_id referral_source utm_source "
    "utm_medium utm_campaign first_touch_channel last_touch_channel",
    "int_user_journeys": "user_id company_id signup_date first_touch_resolved_channel "
    "first_touch_attribution_reason last_touch_resolved_channel last_touch_attribution_reason "
    "has_channel_conflict missing_utm_flag first_touch_campaign_match_status "
    "last_touch_campaign_match_status campaign_match_status attribution_confidence",
    "int_attributed_revenue": "revenue_id user_id company_id revenue_amount revenue_month is_recurring "
    "signup_date first_touch_resolved_channel last_touch_resolved_channel "
    "first_touch_attribution_reason last_touch_attribution_reason has_channel_conflict "
    "missing_utm_flag first_touch_campaign_match_status last_touch_campaign_match_status "
    "campaign_match_status attribution_confidence missing_journey_flag",
    "dim_channel": "channel_key channel_name channel_group",
    "dim_company": "company_id company_name industry",
    "dim_time": "date_key date_day week_start_date month_start_date month_key day_of_month "
    "month_number month_name quarter_number year_number iso_day_of_week is_weekend",
    "dim_user_cohort": "cohort_key cohort_month cohort_label cohort_month_number cohort_quarter "
    "cohort_year",
    "fct_attributed_revenue": "revenue_id user_id company_id revenue_date_key signup_date_key "
    "cohort_key first_touch_channel last_touch_channel first_touch_attribution_reason "
    "last_touch_attribution_reason revenue_amount is_recurring has_channel_conflict missing_utm_flag "
    "first_touch_campaign_match_status last_touch_campaign_match_status campaign_match_status "
    "attribution_confidence",
    "fct_campaign_roi": "campaign_id channel start_date_key end_date_key budget_usd "
    "first_touch_attributed_revenue last_touch_attributed_revenue first_touch_customers "
    "last_touch_customers first_touch_roas last_touch_roas first_touch_roi last_touch_roi",
    "fct_content_performance": "content_performance_key publish_month_date_key channel content_count "
    "views clicks",
    "channel_performance": "channel_key channel_name channel_group first_touch_revenue "
    "last_touch_revenue first_touch_customers last_touch_customers first_touch_revenue_records "
    "last_touch_revenue_records content_count views clicks campaign_count campaign_budget_usd",
    "campaign_performance": "campaign_id channel_key channel_name start_date end_date budget_usd "
    "first_touch_attributed_revenue last_touch_attributed_revenue first_touch_customers "
    "last_touch_customers first_touch_roas last_touch_roas first_touch_roi last_touch_roi "
    "attribution_revenue_difference",
    "company_revenue_analysis": "company_id company_name industry total_revenue recurring_revenue "
    "initial_revenue revenue_record_count customer_count first_touch_channel_count "
    "last_touch_channel_count first_touch_campaign_revenue last_touch_campaign_revenue "
    "average_revenue_per_customer portfolio_revenue_share",
    "monthly_revenue_customer_growth": "month_key month_date_key month_start_date total_revenue "
    "recurring_revenue initial_revenue revenue_record_count active_customers new_customers",
}


def _generic_report() -> str:
    rows: list[str] = []

    def add(name: str, count: str) -> None:
        rows.append(f"SELECT {_quote(name)} AS constraint_name, ({count}) AS n")

    for table, contract in CONTRACTS.items():
        for c in _COLUMNS[table].split():
            if c not in contract.optional:
                add(f"not_null:{table}.{c}", f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
        for c in contract.unique:
            add(f"unique:{table}.{c}",
                f"SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)")
        for c, vocabulary in contract.accepted.items():
            add(f"accepted:{table}.{c}",
                f"SELECT count(DISTINCT {c}) FROM {table} WHERE {c} NOT IN {_in(vocabulary)}")
        for c, parent, pc in contract.references:
            add(f"reference:{table}.{c}->{parent}.{pc}",
                f"SELECT count(*) FROM {table} x WHERE x.{c} IS NOT NULL AND x.{c} NOT IN "
                f"(SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL)")
    body = "\nUNION ALL ".join(rows)
    return _with(body) + (
        f"SELECT constraint_name, CAST(n AS BIGINT) AS failures, n = 0 AS passed FROM ({body})"
    )


def _unique_keys() -> str:
    rows = [
        f"SELECT 'duplicate_primary_key_{t}' AS check_name, count(*) AS duplicated FROM "
        f"(SELECT {c} FROM raw_{t} GROUP BY {c} HAVING count(*) > 1)"
        for t, c in PRIMARY_KEYS.items()
    ]
    rows += [
        f"SELECT 'unique:{t}.{c}', count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
        f"GROUP BY {c} HAVING count(*) > 1)"
        for t, contract in CONTRACTS.items() for c in contract.unique
    ]
    return _select(" UNION ALL ".join(rows))


def _conservation() -> str:
    def total(table: str, column: str) -> str:
        return f"(SELECT CAST(sum({column}) AS DOUBLE) FROM {table})"

    rows = [
        "SELECT 'fact_record_count' AS check_name, "
        "CAST((SELECT count(*) FROM int_attributed_revenue) AS DOUBLE) AS e, "
        "CAST((SELECT count(*) FROM fct_attributed_revenue) AS DOUBLE) AS a",
        f"SELECT 'fact_revenue', {total('int_attributed_revenue', 'revenue_amount')}, "
        f"{total('fct_attributed_revenue', 'revenue_amount')}",
    ]
    for name, (ta, ca, tb, cb) in ANALYTICS_TOTALS.items():
        rows.append(f"SELECT {_quote(name)}, {total(ta, ca)}, {total(tb, cb)}")
    body = "\nUNION ALL ".join(rows)
    return _with(body) + (
        "SELECT check_name, round(e, 2) AS expected_value, round(a, 2) AS actual_value, "
        f"abs(e - a) <= 0.01 AS conserved FROM ({body})"
    )


def _nonnegative() -> str:
    rows = []
    for table, measures in NONNEGATIVE.items():
        negative = " OR ".join(f"{c} < 0" for c in measures)
        rows.append(
            f"SELECT {_quote(table)} AS model_name, count(*) AS invalid_row_count "
            f"FROM {table} WHERE {negative}"
        )
    return _select("\nUNION ALL ".join(rows))


def _fixed_holt() -> str:
    recursion = f"""state AS (
      SELECT k, i, y1 AS level, y2 - y1 AS trend, CAST(0 AS DOUBLE) AS sse
      FROM (SELECT k, CAST(0 AS BIGINT) AS i, max(v) FILTER (WHERE i = 1) AS y1,
                   max(v) FILTER (WHERE i = 2) AS y2 FROM numbered GROUP BY k)
      UNION ALL
      SELECT k, i, nl, {_B} * (nl - level) + (1 - {_B}) * trend, sse + (v - p) * (v - p)
      FROM (SELECT s.k, n.i, s.level, s.trend, s.sse, n.v, s.level + s.trend AS p,
                   {_A} * n.v + (1 - {_A}) * (s.level + s.trend) AS nl
            FROM state s JOIN numbered n ON n.k = s.k AND n.i = s.i + 1))"""
    return _with("numbered", recursion) + """SELECT k AS series_key, CAST(i AS INTEGER) AS months_fitted,
      round(level, 3) AS level, round(trend, 3) AS trend, round(sqrt(sse / i), 3) AS rmse
    FROM state WHERE (k, i) IN (SELECT k, max(i) FROM numbered GROUP BY k)"""


# -- parameter search -------------------------------------------------------------------


def _double(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _search(source: str, tag: str) -> str:
    """CTEs ending in ``{tag}_best``: the grid search as recursive runs over all candidates."""
    steps, half = FORECAST.grid_steps, FORECAST.zoom_half_width
    parts = [f"""{tag}_grid0 AS (
      SELECT k, CAST(a AS DOUBLE) / {steps} AS alpha, CAST(b AS DOUBLE) / {steps} AS beta
      FROM (SELECT DISTINCT k FROM {source}), range({steps + 1}) x(a), range({steps + 1}) y(b)
      WHERE b <= a)"""]
    step = 1.0 / steps
    for i in range(FORECAST.zoom_rounds + 1):
        if i:
            step /= half
            parts.append(f"""{tag}_grid{i} AS (
              SELECT k, na AS alpha, least(greatest(beta + b * {_double(step)}, 0), na) AS beta
              FROM (SELECT k, beta, least(greatest(alpha + a * {_double(step)}, 0), 1) AS na
                    FROM {tag}_best{i - 1}, range(-{half}, {half + 1}) x(a)),
                   range(-{half}, {half + 1}) y(b))""")
        parts.append(f"""{tag}_run{i} AS (
          SELECT k, alpha, beta, CAST(0 AS BIGINT) AS i,
                 {", ".join(f"CAST({x} AS DOUBLE) AS {n}" for n, x in (
                     ("l", 0), ("b", 0), ("lu", 1), ("bu", 0), ("lv", 0), ("bv", 1),
                     ("ee", 0), ("eu", 0), ("ev", 0), ("uu", 0), ("uv", 0), ("vv", 0)))}
          FROM {tag}_grid{i}
          UNION ALL
          SELECT k, alpha, beta, i, nl, beta * (nl - l) + (1 - beta) * b,
                 nlu, beta * (nlu - lu) + (1 - beta) * bu, nlv, beta * (nlv - lv) + (1 - beta) * bv,
                 ee + e * e, eu - e * pu, ev - e * pv, uu + pu * pu, uv + pu * pv, vv + pv * pv
          FROM (SELECT r.* EXCLUDE (i), s.i, s.v - (r.l + r.b) AS e, r.lu + r.bu AS pu,
                       r.lv + r.bv AS pv, r.alpha * s.v + (1 - r.alpha) * (r.l + r.b) AS nl,
                       (1 - r.alpha) * (r.lu + r.bu) AS nlu, (1 - r.alpha) * (r.lv + r.bv) AS nlv
                FROM {tag}_run{i} r JOIN {source} s ON s.k = r.k AND s.i = r.i + 1))""")
        parts.append(f"""{tag}_best{i} AS (
          SELECT k, alpha, beta, l0, b0, n, greatest(ee + 2 * (l0 * eu + b0 * ev) + l0 * l0 * uu
                   + 2 * l0 * b0 * uv + b0 * b0 * vv, 0) AS sse
          FROM (SELECT r.*, n, CASE WHEN flat THEN y1 ELSE (uv * ev - vv * eu) / det END AS l0,
                       CASE WHEN flat THEN y2 - y1 ELSE (uv * eu - uu * ev) / det END AS b0
                FROM (SELECT *, uu * vv - uv * uv AS det,
                             uu * vv - uv * uv <= uu * vv * 1e-12 AS flat FROM {tag}_run{i}) r
                JOIN (SELECT k, max(i) AS n, max(v) FILTER (WHERE i = 1) AS y1,
                             max(v) FILTER (WHERE i = 2) AS y2 FROM {source} GROUP BY k) y
                  ON y.k = r.k AND y.n = r.i)
          QUALIFY row_number() OVER (PARTITION BY k ORDER BY sse, alpha, beta) = 1)""")
    parts.append(f"""{tag}_smooth AS (
      SELECT k, alpha, beta, CAST(0 AS BIGINT) AS i, l0 AS level, b0 AS trend,
             CAST(NULL AS DOUBLE) AS p, CAST(NULL AS DOUBLE) AS v FROM {tag}_best{i}
      UNION ALL
      SELECT k, alpha, beta, i, nl, beta * (nl - level) + (1 - beta) * trend, p, v
      FROM (SELECT r.k, r.alpha, r.beta, s.i, r.level, r.trend, s.v, r.level + r.trend AS p,
                   r.alpha * s.v + (1 - r.alpha) * (r.level + r.trend) AS nl
            FROM {tag}_smooth r JOIN {source} s ON s.k = r.k AND s.i = r.i + 1))""")
    parts.append(f"""{tag}_end AS (
      SELECT s.k, s.level, s.trend, e.spread, s.i AS n
      FROM {tag}_smooth s
      JOIN (SELECT k, max(i) AS n, coalesce(stddev_samp(v - p), 0) AS spread FROM {tag}_smooth
            GROUP BY k) e ON e.k = s.k AND e.n = s.i)""")
    return ",\n".join(parts)


_LAST_ROUND = FORECAST.zoom_rounds


def _fitted(body: str, *searches: tuple[str, str]) -> str:
    return _with(body, ",\n".join(_search(source, tag) for source, tag in searches)) + body


def _holt_fit() -> str:
    return _fitted(f"""
      SELECT k AS series_key, round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(l0, 0) AS l0,
             round(b0, 0) AS b0, round(sqrt(sse / n), 1) AS rmse FROM full_best{_LAST_ROUND}""",
                   ("numbered", "full"))


def _future(where: str = "true") -> str:
    margin = f"{FORECAST.interval_z}::DOUBLE * e.spread"
    return f"""
      SELECT e.k AS series_key, CAST(CAST(x.m + to_months(CAST(h AS INTEGER)) AS DATE) AS VARCHAR) AS month,
             round(round(e.level + h * e.trend, 2), 0) AS predicted_revenue,
             round(round(e.level + h * e.trend - {margin}, 2), 0) AS lower_bound,
             round(round(e.level + h * e.trend + {margin}, 2), 0) AS upper_bound,
             '{FORECAST.model_name}' AS model_name
      FROM full_end e JOIN numbered x ON x.k = e.k AND x.i = e.n, range(1, {FORECAST.horizon + 1}) f(h)
      WHERE {where}"""


def _holt_comparison() -> str:
    return _fitted("""
      SELECT x.k AS series_key, CAST(x.m AS VARCHAR) AS month, round(x.v, 2) AS actual_revenue,
             round(round(s.p, 2), 0) AS predicted_revenue,
             round(round(x.v - round(s.p, 2), 2), 0) AS prediction_error
      FROM full_smooth s JOIN numbered x ON x.k = s.k AND x.i = s.i""", ("numbered", "full"))


def _holt_holdout() -> str:
    return _fitted(f"""
      SELECT e.k AS series_key, '{FORECAST.model_name}' AS model_name, round(mae, 0) AS mae,
             round(rmse, 0) AS rmse,
             CASE WHEN ss_tot > 0 THEN round(1 - ss_res / ss_tot, 4) ELSE CAST('nan' AS DOUBLE) END
               AS r2_score,
             CAST(t.n AS INTEGER) AS train_months, CAST(held AS INTEGER) AS holdout_months,
             round(e.spread, 0) AS residual_std, round(e.level, 0) AS intercept,
             round(e.trend, 0) AS slope
      FROM full_end e JOIN train_end t ON t.k = e.k
      JOIN (SELECT x.k, count(*) AS held, avg(abs(x.v - (t.level + (x.i - t.n) * t.trend))) AS mae,
                   sqrt(avg(pow(x.v - (t.level + (x.i - t.n) * t.trend), 2))) AS rmse,
                   sum(pow(x.v - (t.level + (x.i - t.n) * t.trend), 2)) AS ss_res,
                   var_pop(x.v) * count(*) AS ss_tot
            FROM numbered x JOIN train_end t ON t.k = x.k AND x.i > t.n GROUP BY x.k) m
        ON m.k = e.k""", ("numbered", "full"), ("training", "train"))


def _history_plus_forecast() -> str:
    return _fitted(f"""
      SELECT CAST(revenue_month AS VARCHAR) AS month,
             round(CAST(sum(revenue_amount) AS DOUBLE), 0) AS revenue, 'Historical' AS series
      FROM chosen_detail GROUP BY revenue_month
      UNION ALL SELECT month, predicted_revenue, 'Forecast' FROM ({_future("e.k = 'portfolio'")})""",
                   ("numbered", "full"))


_CAMPAIGN_MONEY = (
    "budget_usd first_touch_attributed_revenue last_touch_attributed_revenue "
    "attribution_revenue_difference"
)
_CHANNEL_MONEY = "first_touch_revenue last_touch_revenue campaign_budget_usd"
_COMPANY_MONEY = (
    "total_revenue recurring_revenue initial_revenue first_touch_campaign_revenue "
    "last_touch_campaign_revenue"
)


def oracle_sql() -> dict[str, str]:
    chosen = _in(CHANNELS)
    return {
        "stg_campaigns": _table("stg_campaign_metadata", "budget_usd", "start_date end_date"),
        "stg_content": _table("stg_content_performance", "", "publish_date publish_month"),
        "stg_revenue": _table("stg_portfolio_revenue", "revenue_amount", "revenue_month"),
        "stg_signups": _table("stg_user_signups", "", "signup_date signup_month"),
        "user_journeys": _table("int_user_journeys", "", "signup_date"),
        "attributed_revenue": _table(
            "int_attributed_revenue", "revenue_amount", "revenue_month signup_date"),
        "dim_channel": _table("dim_channel"),
        "dim_company": _table("dim_company"),
        "dim_time": _table("dim_time", "", "date_day week_start_date month_start_date"),
        "dim_user_cohort": _table("dim_user_cohort", "", "cohort_month"),
        "fct_attributed_revenue": _table("fct_attributed_revenue", "revenue_amount"),
        "fct_campaign_roi": _table(
            "fct_campaign_roi",
            "budget_usd first_touch_attributed_revenue last_touch_attributed_revenue"),
        "fct_content_performance": _table("fct_content_performance"),
        "channel_performance": _table("channel_performance", _CHANNEL_MONEY),
        "campaign_performance": _table(
            "campaign_performance", _CAMPAIGN_MONEY, "start_date end_date"),
        "company_revenue_analysis": _table("company_revenue_analysis", _COMPANY_MONEY),
        "monthly_growth": _table(
            "monthly_revenue_customer_growth",
            "total_revenue recurring_revenue initial_revenue revenue_change", "month_start_date"),
        "touch_revenue_by_channel": _select(f"""
          SELECT channel_key, CAST(f_revenue AS DOUBLE) AS first_touch_revenue,
                 coalesce(f_customers, 0) AS first_touch_customers,
                 f_records AS first_touch_records,
                 CAST(l_revenue AS DOUBLE) AS last_touch_revenue,
                 coalesce(l_customers, 0) AS last_touch_customers, l_records AS last_touch_records
          FROM {_by('first_touch_channel', 'channel_key', 'f')} f
          FULL JOIN {_by('last_touch_channel', 'channel_key', 'l')} l USING (channel_key)
          WHERE channel_key IS NOT NULL"""),
        "quality_raw_report": _raw_report(),
        "quality_gaps_report": _gaps_report(),
        "quality_unique_keys": _unique_keys(),
        "absent_sources": "SELECT unnest(['content_performance.csv', 'portfolio_revenue.csv', "
                          "'user_signups.json']) AS file",
        "quality_duplicates": _select(
            "SELECT content_id, count(*) AS rows FROM raw_content_performance "
            "GROUP BY content_id HAVING count(*) > 1"),
        "quality_orphans": _select(
            "SELECT user_id, count(*) AS rows FROM raw_portfolio_revenue x WHERE NOT EXISTS "
            "(SELECT 1 FROM raw_user_signups s WHERE s.user_id = x.user_id) GROUP BY 1"),
        "quality_content_without_campaign": _select(
            "SELECT utm_campaign AS campaign_slug, count(*) AS rows FROM stg_content_performance x "
            "WHERE NOT EXISTS (SELECT 1 FROM stg_campaign_metadata c "
            "WHERE c.campaign_slug = x.utm_campaign) GROUP BY 1"),
        "quality_generic_report": _generic_report(),
        "conservation_report": _conservation(),
        "nonnegative_report": _nonnegative(),
        "channel_month_panel": _table("panel", "", "month_start_date", {"monthly_revenue": 2}),
        "rolling_baseline": _table(
            "baseline", "", "month_start_date",
            {c: _ANOMALY_DIGITS[c] for c in ("monthly_revenue", "rolling_mean", "rolling_std")}),
        "channel_anomalies": _table("anomalies", "", "month_start_date", _ANOMALY_DIGITS),
        "odd_channel_anomalies": _table("odd_anomalies", "", "month_start_date", _ANOMALY_DIGITS),
        "anomaly_summary": _select("""
          SELECT (SELECT count(DISTINCT channel) FROM panel) AS channels_analyzed,
                 (SELECT count(DISTINCT month_start_date) FROM panel) AS months_analyzed,
                 count(*) AS rows_written, count(*) FILTER (WHERE is_anomaly) AS anomalies_detected
          FROM anomalies"""),
        "anomaly_list": _table(
            f"(SELECT * FROM named_anomalies WHERE is_anomaly AND channel IN {chosen})", "",
            "month_start_date", _ANOMALY_DIGITS),
        "anomaly_trend": _select("""
          SELECT channel_name, CAST(month_start_date AS VARCHAR) AS month_start_date,
                 round(monthly_revenue, 2) AS monthly_revenue, is_anomaly
          FROM named_anomalies WHERE channel_name IN
            (SELECT channel_name FROM named_anomalies WHERE is_anomaly)"""),
        "anomaly_kpis": _select("""
          SELECT count(DISTINCT channel) AS channels,
                 count(DISTINCT month_start_date) AS scored_months,
                 count(*) FILTER (WHERE is_anomaly) AS anomalies FROM named_anomalies"""),
        "holt_fixed_params": _fixed_holt(),
        "holt_fit": _holt_fit(),
        "series_report": _select(f"""
          SELECT k AS series_key, CAST(count(*) AS INTEGER) AS months,
                 CAST(min(m) AS VARCHAR) AS first_month, CAST(max(m) AS VARCHAR) AS last_month,
                 CASE WHEN count(*) < {FORECAST.holdout} + 3 THEN 'too_short'
                      WHEN date_diff('month', min(m), max(m)) + 1 <> count(*)
                           OR count(DISTINCT m) <> count(*) THEN 'irregular'
                      ELSE 'ok' END AS status
          FROM series GROUP BY k"""),
        "holt_refit": _select(f"""
          SELECT k AS series_key, k = '{CHANGED_SERIES}' AS searched FROM series GROUP BY k
          HAVING count(*) >= {FORECAST.holdout} + 3
             AND date_diff('month', min(m), max(m)) + 1 = count(*)
             AND count(DISTINCT m) = count(*)"""),
        "holt_forecast": _fitted(_future(), ("numbered", "full")),
        "holt_holdout_metrics": _holt_holdout(),
        "holt_comparison": _holt_comparison(),
        "history_plus_forecast": _history_plus_forecast(),
        "filter_options": _select("""
          SELECT 'company' AS kind, company_id AS key, company_name AS name
          FROM company_revenue_analysis
          UNION ALL SELECT 'channel', channel_key, channel_name FROM channel_performance"""),
        "revenue_detail": _table("detail", "revenue_amount", "revenue_month"),
        "clustered_detail": _table(
            f"(SELECT * FROM detail WHERE company_id = '{COMPANIES[0]}' AND "
            f"first_touch_channel = '{CHANNELS[0]}' AND last_touch_channel = '{CHANNELS[0]}')",
            "revenue_amount", "revenue_month"),
        "channel_by_company": _table(
            f"(SELECT * FROM chosen_channels WHERE channel_key IN {chosen})", _CHANNEL_MONEY),
        "campaigns_by_company": _table("chosen_campaigns", _CAMPAIGN_MONEY, "start_date end_date"),
        "company_filtered": _table(
            f"(SELECT * FROM company_revenue_analysis WHERE company_id IN {_in(COMPANIES)})",
            _COMPANY_MONEY),
        "monthly_filtered": _select("""
          SELECT CAST(revenue_month AS VARCHAR) AS month,
                 CAST(sum(revenue_amount) AS DOUBLE) AS total_revenue,
                 count(DISTINCT user_id) AS active_customers
          FROM chosen_detail GROUP BY revenue_month"""),
        "kpi_overview": _select(f"""
          SELECT round(CAST(coalesce(sum(revenue_amount), 0) AS DOUBLE), 2) AS total_revenue,
                 count(DISTINCT user_id) AS total_customers,
                 (SELECT count(*) FROM chosen_campaigns) AS campaign_count,
                 (SELECT count(*) FROM channel_performance WHERE channel_key IN {chosen})
                   AS channel_count,
                 CAST({FORECAST.horizon} AS BIGINT) AS forecast_horizon
          FROM chosen_detail"""),
        "cells_channel_by_company": _table(
            f"(SELECT * FROM chosen_channels WHERE channel_key IN {chosen})", _CHANNEL_MONEY),
        "cells_monthly_filtered": _select("""
          SELECT CAST(revenue_month AS VARCHAR) AS month,
                 CAST(sum(revenue_amount) AS DOUBLE) AS total_revenue,
                 count(DISTINCT user_id) AS active_customers
          FROM chosen_detail GROUP BY revenue_month"""),
        "cells_kpi_overview": _select(f"""
          SELECT round(CAST(coalesce(sum(revenue_amount), 0) AS DOUBLE), 2) AS total_revenue,
                 count(DISTINCT user_id) AS total_customers,
                 (SELECT count(*) FROM chosen_campaigns) AS campaign_count,
                 (SELECT count(*) FROM channel_performance WHERE channel_key IN {chosen})
                   AS channel_count,
                 CAST({FORECAST.horizon} AS BIGINT) AS forecast_horizon
          FROM chosen_detail"""),
        "dates_beyond_horizon": _select(" UNION ALL ".join(
            f"""SELECT 'content' AS source, 'publish_date' AS column, '{month}' AS month,
                 count(*) AS rows FROM stg_content_performance
            WHERE CAST(regexp_extract(content_id, '[0-9]+') AS BIGINT) % {every} = 0 HAVING count(*) > 0"""
            for month, every in (("9999-12-01", 97), ("1666-06-01", 101)))),
        "calendar_with_outliers": _table("dim_time", "", "date_day week_start_date month_start_date"),
        "refreshed_fact": _table("fct_attributed_revenue", "revenue_amount"),
        "refreshed_months": _select(f"""
          SELECT DISTINCT coalesce(CAST({_key('revenue_month')} AS VARCHAR), 'NULL')
                 AS revenue_date_key, 'rewritten' AS change
          FROM stg_portfolio_revenue WHERE {_MISSING} OR {_OTHER_AMOUNT} OR user_id = '{MOVED_USER}'
          UNION ALL SELECT '19900101', 'removed'"""),
        "version_changes": _select(f"""
          SELECT revenue_id, CASE WHEN {_MISSING} THEN 'added' ELSE 'changed' END AS change
          FROM stg_portfolio_revenue WHERE {_MISSING} OR {_OTHER_AMOUNT} OR user_id = '{MOVED_USER}'
          UNION ALL SELECT 'OLD-' || revenue_id, 'removed' FROM stg_portfolio_revenue
          WHERE {_NUMBER} % 101 = 0"""),
        "crowded_journeys": _select(f"""
          SELECT c.id AS first_touch_campaign_id,
                 CASE WHEN c.id IS NULL THEN 'unmatched_or_invalid' ELSE 'matched_first_touch_only'
                 END AS campaign_match_status,
                 count(*) AS journeys, count(DISTINCT s.company_id) AS companies,
                 CAST(0 AS BIGINT) AS last_touch_matches
          FROM stg_user_signups s LEFT JOIN {_CROWDED} c
            ON s.signup_date BETWEEN c.a AND c.b AND (c.target IS NULL OR c.target = s.company_id)
          GROUP BY 1, 2"""),
        "crowded_content": _select(f"""
          SELECT {_key("date_trunc('month', x.publish_date)")} AS publish_month_date_key, x.channel,
                 c.id AS campaign_id, count(*) AS content_count,
                 CAST(sum(x.views) AS BIGINT) AS views, CAST(sum(x.clicks) AS BIGINT) AS clicks
          FROM stg_content_performance x LEFT JOIN {_CROWDED} c
            ON x.channel = 'youtube' AND x.publish_date BETWEEN c.a AND c.b
          GROUP BY ALL"""),
        "customers_by_selection": _select(" UNION ALL ".join(
            f"""SELECT CAST({i} AS INTEGER) AS selection,
                 CAST(coalesce(sum(revenue_amount), 0) AS DOUBLE) AS revenue,
                 count(DISTINCT user_id) AS customers, count(*) AS records
            FROM detail WHERE {f"company_id IN {_in(companies)}" if companies else "true"}
              AND {f"(first_touch_channel IN {_in(keys)} OR last_touch_channel IN {_in(keys)})"
                   if keys else "true"}"""
            for i, (companies, keys) in enumerate(PICKED))),
        "customers_new_by_month": _select("""
          SELECT CAST(d.revenue_month AS VARCHAR) AS month,
                 count(DISTINCT d.user_id) AS customers,
                 count(DISTINCT d.user_id) FILTER (WHERE f.m = d.revenue_month) AS new_customers
          FROM detail d
          JOIN (SELECT user_id, min(revenue_month) AS m FROM detail WHERE user_id IS NOT NULL
                GROUP BY user_id) f USING (user_id)
          GROUP BY d.revenue_month"""),
        "attribution_comparison": _select("""
          SELECT channel_key, channel_name, CAST(first_touch_revenue AS DOUBLE) AS first_touch_revenue,
                 CAST(last_touch_revenue AS DOUBLE) AS last_touch_revenue,
                 round(CAST(last_touch_revenue - first_touch_revenue AS DOUBLE), 2) AS difference,
                 round(CAST(last_touch_revenue - first_touch_revenue AS DOUBLE)
                       / nullif(CAST(first_touch_revenue AS DOUBLE), 0), 6) AS pct_difference
          FROM chosen_channels"""),
        "attribution_long": _select("""
          SELECT channel_name, 'First Touch' AS attribution_model,
                 CAST(first_touch_revenue AS DOUBLE) AS revenue FROM channel_performance
          UNION ALL SELECT channel_name, 'Last Touch', CAST(last_touch_revenue AS DOUBLE)
          FROM channel_performance"""),
        "top_campaigns": _table(
            "(SELECT * FROM campaign_performance "
            "ORDER BY last_touch_roi DESC NULLS LAST, campaign_id LIMIT 15)",
            _CAMPAIGN_MONEY, "start_date end_date"),
        "loaded_campaigns": _table("raw_campaign_metadata", "budget_usd"),
        "loaded_content": _table("raw_content_performance"),
        "loaded_revenue": _table("raw_portfolio_revenue", "revenue_amount"),
        "loaded_signups": _table("raw_user_signups"),
        "loaded_row_counts": _select("\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows FROM raw_{t}"
            for t in ("campaign_metadata", "content_performance", "portfolio_revenue",
                      "user_signups"))),
        "layer_table_rows": _select(
            "SELECT channel_key, CAST(2 AS BIGINT) AS rows FROM dim_channel"),
        "top_campaigns_by_measure": _select("\nUNION ALL ".join(
            f"""SELECT * FROM (
                SELECT '{m}' AS measure,
                       CAST(row_number() OVER (ORDER BY {m} DESC NULLS LAST, campaign_id) AS INTEGER)
                         AS position,
                       campaign_id, round(CAST({m} AS DOUBLE), 6) AS value
                FROM campaign_performance WHERE campaign_id IS NOT NULL) WHERE position <= 15"""
            for m in ("last_touch_roi", "first_touch_roi", "last_touch_attributed_revenue",
                      "first_touch_attributed_revenue", "budget_usd"))),
        "channel_unfiltered": _select("""
          SELECT channel_key, channel_name, CAST(first_touch_revenue AS DOUBLE) AS first_touch_revenue,
                 CAST(last_touch_revenue AS DOUBLE) AS last_touch_revenue, views, clicks,
                 campaign_count,
                 CAST(row_number() OVER (ORDER BY last_touch_revenue DESC NULLS LAST, channel_key)
                      AS INTEGER) AS position
          FROM channel_performance"""),
        "monthly_unfiltered": _select("""
          SELECT CAST(month_start_date AS VARCHAR) AS month,
                 CAST(total_revenue AS DOUBLE) AS total_revenue, active_customers, new_customers,
                 CAST(row_number() OVER (ORDER BY month_start_date NULLS LAST) AS INTEGER) AS position
          FROM monthly_revenue_customer_growth"""),
        "anomaly_all_rows": _table(
            f"(SELECT * FROM named_anomalies WHERE channel_name IN {_in(CHANNEL_NAMES)})", "",
            "month_start_date", _ANOMALY_DIGITS),
        "rank_order_violations": _select("""
          SELECT count(anomaly_rank) AS ranks,
                 (SELECT count(*) FROM (
                    SELECT anomaly_rank, abs(z_score) AS a,
                           row_number() OVER (ORDER BY anomaly_rank) AS i,
                           lag(abs(z_score)) OVER (ORDER BY anomaly_rank) AS b
                    FROM anomalies WHERE is_anomaly)
                  WHERE i <> anomaly_rank OR b < a) AS violations
          FROM anomalies"""),
        "forecast_overlap": _select(f"""
          SELECT CAST({FORECAST.horizon} AS BIGINT) AS forecast_months,
                 CAST(CAST(max(month_start_date) + INTERVAL 1 MONTH AS DATE) AS VARCHAR)
                   AS first_forecast_month,
                 CAST(max(month_start_date) AS VARCHAR) AS last_observed_month,
                 CAST(0 AS BIGINT) AS overlapping_months
          FROM monthly_revenue_customer_growth"""),
        "channels_with_ctr": _select("""
          SELECT channel_name, format('{:.1f}', click_through_rate * 100) || '%' AS click_through_rate,
                 '$' || format('{:,.0f}', CAST(campaign_budget_usd AS DOUBLE)) AS campaign_budget_usd
          FROM channel_performance WHERE click_through_rate IS NOT NULL"""),
    }
