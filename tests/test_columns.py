"""Cleaning, date and number expressions against the SQL oracle engine and by hand."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from touchtrail.functions import columns as C
from touchtrail.functions import text as X

TEXTS = [None, "", "   ", " abc ", "\tabc", "X", " twitter/X ", "YouTube", "Word_Of Mouth"]
DATES = [
    None, "", "2024", "2024-01", "2024/01/05", "2024-1-5", " 2024-01-05 ", "2024-01-05",
    "2024-01-05 10:00:00", "2024 01 05", "2024\\01\\05", "2024-01/05", "2024-13-01", "2024-02-30",
    "2024-01-05x", "2024-01-05T10", "20240105", "12024-01-05", "2024-001-05", "2024-01-005",
    "0999-12-31", "2024-02-29", "2023-02-29", "abcd-ef-gh",
]
MONTHS = [None, "", "2024-01", "2024-1", "2024-13", " 2024-01", "2024-01 ", "2024-01-05", "2024"]
SLUGS = [None, "", "!!!", " Spring Launch 2023 ", "Twitter/X & co", "__a__b__", "ÄB c", "a-b_c"]


def spark_values(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def duck_values(values, expression):
    con = duckdb.connect()
    return [con.execute(f"SELECT {expression} FROM (SELECT ?::VARCHAR AS v)", [v]).fetchone()[0]
            for v in values]


@pytest.mark.parametrize(
    ("values", "ours", "sql"),
    [
        (TEXTS, C.blank_to_null, "nullif(trim(v), '')"),
        (TEXTS, C.clean_id, "upper(nullif(trim(v), ''))"),
        (DATES, C.safe_date, "try_cast(nullif(trim(v), '') AS DATE)"),
        (MONTHS, C.safe_month, "CAST(try_strptime(nullif(trim(v), ''), '%Y-%m') AS DATE)"),
        (SLUGS, C.slugify,
         "nullif(trim(regexp_replace(lower(trim(v)), '[^a-z0-9]+', '_', 'g'), '_'), '')"),
    ],
)
def test_matches_sql_engine(spark, values, ours, sql):
    mine = spark_values(spark, values, lambda c: ours(c).cast("string"))
    mine = [v and v.removeprefix("+") for v in mine]  # Spark signs years above 9999
    theirs = [None if v is None else str(v) for v in duck_values(values, sql)]
    assert mine == theirs


def test_channel_aliases(spark):
    got = spark_values(spark, ["X", " Twitter/x ", "twitter", "x.com", "", None], C.canonical_channel)
    assert got == ["twitter", "twitter", "twitter", "x.com", None, None]


def test_referral_label_keeps_its_spelling(spark):
    assert spark_values(spark, [" X "], C.lower_label) == ["x"]


def test_ratio_divides_decimals_as_doubles(spark):
    row = spark.sql(
        "SELECT CAST(1 AS DECIMAL(18,2)) AS a, CAST(3 AS DECIMAL(18,2)) AS b, CAST(0 AS DECIMAL(18,2)) AS z"
    ).select(C.ratio("a", "b"), C.ratio("a", "z"), C.safe_ratio("a", "b", 4)).first()
    assert row[0] == 1 / 3 and row[1] is None and row[2] == 0.3333


@pytest.mark.parametrize("x", [1.005, 2.675, 50.005, 1125.125, -2.5, 0.125, 1e-9, 123456.785])
@pytest.mark.parametrize("digits", [0, 2, 4])
def test_round_like_the_sql_engine(spark, x, digits):
    mine = spark.range(1).select(C.round_half_away(F.lit(x), digits)).first()[0]
    sql = f"SELECT round({x!r}::DOUBLE, {digits})"
    assert mine == duckdb.connect().execute(sql).fetchone()[0]


def test_compound_key_skips_nulls(spark):
    import hashlib

    row = spark.sql("SELECT DATE'2024-01-01' AS m, CAST(NULL AS STRING) AS c, 'CMP-1' AS k")
    got = row.select(C.compound_key("m", "c", "k")).first()[0]
    assert got == hashlib.md5(b"2024-01-01||CMP-1").hexdigest()


def test_keys(spark):
    row = spark.sql("SELECT DATE'2024-03-09' AS d").select(
        C.date_key("d"), C.month_key("d"), C.month_start("d").cast("string")).first()
    assert tuple(row) == (20240309, 202403, "2024-03-01")


@pytest.mark.parametrize("value", [1234.5, 1235.5, -0.3, -1234567.0, 0.0, 999999.5])
def test_money_rounds_ties_to_even(spark, value):
    assert spark.range(1).select(X.money(F.lit(value))).first()[0] == f"${value:,.0f}"


@pytest.mark.parametrize("value", [0.25, 0.35, 1234.05, 2.675, -0.05])
def test_fixed_has_no_separators(spark, value):
    assert spark.range(1).select(X.fixed(F.lit(value), 1)).first()[0] == f"{value:.1f}"


@pytest.mark.parametrize("label", ["word_of_mouth", "twitter/x", "tik-tok", "a1b", "BLOG", ""])
def test_title_label(spark, label):
    got = spark.createDataFrame([(label,)], "v string").select(X.title_label(F.col("v"))).first()[0]
    assert got == label.replace("_", " ").title()


def test_percent(spark):
    assert spark.range(1).select(X.percent(F.lit(0.1234))).first()[0] == "12.3%"
