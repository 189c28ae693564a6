"""The four raw tables, derived by Spark from the driver's test tables.

Plain per-row arithmetic on whole tables: every part is a campaign, every
customer a signup, every order a revenue record, every line item a content item.
Spellings are varied on purpose (case, padding, aliases, blanks), so that the
cleaning operators have work to do. With ``flawed`` (the default) some rows also
break the rules a source should keep, chosen by key arithmetic: unknown users, negative
amounts, reversed or malformed dates, unlisted companies and channels, and companies with
few or missing months. Without it the tables pass validation but for repeated keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.functions.columns import MONEY

# Raw spellings of the six published channels, and of the eight touch channels.
RAW_PUBLISHED = ("YouTube", "X", "instagram", " Newsletter", "podcast ", "blog")
RAW_TOUCH = ("youtube", "twitter/x", "Instagram", "newsletter", "podcast", "blog", "organic", "Referral")
RAW_REFERRAL = ("direct", "word_of_mouth", "", "Referral")
RAW_MEDIUM = ("social", "Email", "organic", "paid", "referral", "")

# Columns read from the test tables; a declared schema needs no inference job.
TEST_SCHEMAS = {
    "part": "p_partkey bigint, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
}

CAMPAIGN_USERS = 10  # customers per campaign
CAMPAIGN_DAYS = 365

SHORT_MONTHS = ("1995-01", "1995-03")
GAPPED_MONTHS = tuple(f"1996-{m:02d}" for m in range(1, 10) if m != 5)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _company(key: Column) -> Column:
    return F.concat(F.lit("CTC-00"), (key % 4 + 1).cast("string"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(TEST_SCHEMAS[name]).parquet(path)


def _if(flawed: bool, condition: Column, value: Column | str, otherwise: Column) -> Column:
    return F.when(condition, value).otherwise(otherwise) if flawed else otherwise


def campaign_metadata(spark: SparkSession, sf_dir: str, flawed: bool = True) -> DataFrame:
    key = F.col("p_partkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), ((key % 12) * 60).cast("int"))
    length = _if(flawed, key % 53 == 0, F.lit(-1), F.lit(CAMPAIGN_DAYS))
    sign = _if(flawed, key % 59 == 0, F.lit(-10), F.lit(10))
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("cmp-"), key.cast("string"), F.lit(" ")).alias("campaign_id"),
        F.concat(F.lit("Launch "), key.cast("string"), F.lit(" / Wave")).alias("campaign_name"),
        _pick(RAW_PUBLISHED, key).alias("channel"),
        (F.col("p_retailprice") * sign).cast(MONEY).alias("budget_usd"),
        start.cast("string").alias("start_date"),
        F.date_add(start, length).cast("string").alias("end_date"),
        F.when(key % 3 == 0, "").otherwise(_company(key)).alias("target_company_id"),
    )


def content_performance(spark: SparkSession, sf_dir: str, flawed: bool = True) -> DataFrame:
    part, supplier, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    views = (F.col("l_quantity") * 100).cast("bigint")
    clicks = F.round(F.col("l_quantity") * F.col("l_discount") * 100).cast("bigint")
    channel = _pick(RAW_PUBLISHED, F.when(supplier % 5 == 0, supplier).otherwise(part))
    return _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("cnt-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("content_id"),
        channel.alias("channel"),
        _if(flawed, order % 307 == 0, "31/12/1996", day).alias("publish_date"),
        _if(flawed, order % 401 == 0, -views, views).alias("views"),
        _if(flawed, order % 409 == 0, -clicks - 1, clicks).alias("clicks"),
        F.when(order % 311 == 0, None)
        .when(supplier % 12 == 0, "")
        .otherwise(channel)
        .alias("utm_source"),
        F.when(part % 3 == 0, " ")
        .otherwise(F.concat(F.lit("Launch-"), part.cast("string"), F.lit(" Wave")))
        .alias("utm_campaign"),
    )


def portfolio_revenue(spark: SparkSession, sf_dir: str, flawed: bool = True) -> DataFrame:
    user, order = F.col("o_custkey"), F.col("o_orderkey")
    month = F.date_format("o_orderdate", "yyyy-MM")
    amount = F.col("o_totalprice").cast(MONEY)
    # One company with two months only, and one whose months have a gap.
    short = (order % 31 == 0) & month.isin(*SHORT_MONTHS)
    gapped = (order % 37 == 0) & month.isin(*GAPPED_MONTHS)
    company = _if(flawed, short, "CTC-007", _if(flawed, gapped, "CTC-008", _company(user)))
    name = F.concat(F.lit("usr-"), user.cast("string"))
    ghost = F.concat(F.lit("ghost-"), user.cast("string"))
    return _table(spark, sf_dir, "orders").select(
        F.concat(F.lit("rev-"), order.cast("string")).alias("revenue_id"),
        company.alias("company_id"),
        _if(flawed, order % 97 == 0, ghost, name).alias("user_id"),
        _if(flawed, order % 223 == 0, "1996/07", month).alias("month"),
        _if(flawed, order % 211 == 0, -amount, amount).cast(MONEY).alias("revenue_amount"),
        (F.col("o_orderpriority") != "1-URGENT").alias("is_recurring"),
    )


def user_signups(spark: SparkSession, sf_dir: str, flawed: bool = True) -> DataFrame:
    """Customers with their first order date; a customer without orders has none."""
    first_order = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key = F.col("c_custkey")
    campaign = F.expr(f"c_custkey div {CAMPAIGN_USERS}")
    seventh = F.expr("c_custkey div 7")
    day = F.coalesce(F.date_format("first_order", "yyyy-MM-dd"), F.lit(""))
    # No touch, no UTM source and no referral are independent of each other, so that every
    # step of the channel fallback occurs.
    referral = F.when(key % 5 == 0, "").otherwise(_pick(RAW_REFERRAL, key))
    touched = F.when(key % 13 == 0, "organic").otherwise(_pick(RAW_PUBLISHED, campaign))
    last = F.when(key % 9 < 5, _pick(RAW_PUBLISHED, campaign)).otherwise(
        _pick(RAW_TOUCH, F.col("c_nationkey"))
    )
    return customers.join(first_order, "c_custkey", "left").select(
        F.concat(F.lit("usr-"), key.cast("string")).alias("user_id"),
        _if(flawed, key % 83 == 0, "1995-02-30", day).alias("signup_date"),
        _company(key).alias("company_id"),
        referral.alias("referral_source"),
        F.when(key % 8 == 0, "").otherwise(_pick(RAW_PUBLISHED, campaign)).alias("utm_source"),
        F.when(key % 67 == 0, None).otherwise(_pick(RAW_MEDIUM, seventh)).alias("utm_medium"),
        F.when(key % 5 == 0, "")
        .otherwise(F.concat(F.lit("LAUNCH "), campaign.cast("string"), F.lit(" wave!")))
        .alias("utm_campaign"),
        F.when(key % 7 == 0, "")
        .otherwise(_if(flawed, key % 61 == 0, "Billboard", touched))
        .alias("first_touch_channel"),
        F.when(key % 7 == 0, " ")
        .otherwise(_if(flawed, key % 127 == 0, "Billboard", last))
        .alias("last_touch_channel"),
    )


def crowded_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned campaigns, one per line item, that all share a slug and a channel.

    Each runs for one to seven days from the shipping date.
    """
    part = F.col("l_partkey")
    start = F.col("l_shipdate").cast("date")
    return _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.lit("cmp"), "l_orderkey", "l_linenumber").alias("campaign_id"),
        F.lit("shared").alias("campaign_slug"),
        F.lit("youtube").alias("channel"),
        start.alias("start_date"),
        F.date_add(start, (part % 7).cast("int")).alias("end_date"),
        F.when(part % 3 != 0, _company(part)).alias("target_company_id"),
    )


def earlier_revenue(revenue: DataFrame) -> DataFrame:
    """Cleaned revenue as an earlier load may have had it.

    A third of one month is still missing, a fifth of another has other amounts, and there is
    a month whose records were withdrawn since.
    """
    number = F.regexp_extract("revenue_id", r"(\d+)", 1).cast("bigint")

    def some(month: str, every: int) -> Column:
        return F.coalesce((F.col("revenue_month") == month) & (number % every == 0), F.lit(False))

    amount = F.col("revenue_amount") + F.when(some("1995-07-01", 5), 1).otherwise(0)
    kept = revenue.where(~some("1996-03-01", 3)).withColumn("revenue_amount", amount.cast(MONEY))
    withdrawn = revenue.where(number % 101 == 0).withColumns(
        {
            "revenue_id": F.concat(F.lit("OLD-"), "revenue_id"),
            "revenue_month": F.lit("1990-01-01").cast("date"),
        }
    )
    return kept.unionByName(withdrawn)


_DERIVERS: dict[str, Callable[[SparkSession, str, bool], DataFrame]] = {
    "campaign_metadata": campaign_metadata,
    "content_performance": content_performance,
    "portfolio_revenue": portfolio_revenue,
    "user_signups": user_signups,
}


class RawTables(Mapping[str, DataFrame]):
    """The derived raw tables by name; each is planned when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, flawed: bool = True) -> None:
        self._spark, self._sf_dir, self._flawed = spark, sf_dir, flawed
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._planned:
            self._planned[name] = _DERIVERS[name](
                self._spark, self._sf_dir, self._flawed
            )
        return self._planned[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_DERIVERS)

    def __len__(self) -> int:
        return len(_DERIVERS)


def raw_tables(spark: SparkSession, sf_dir: str, flawed: bool = True) -> RawTables:
    return RawTables(spark, sf_dir, flawed)
