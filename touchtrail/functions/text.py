"""Number and label formatting used in generated sentences and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(x: Column) -> Column:
    """``$1,235``: no decimals, thousands separators, ties to even."""
    return F.concat(F.lit("$"), F.format_number(x, 0))


def fixed(x: Column, digits: int) -> Column:
    """Plain fixed-point text without thousands separators, ties to even."""
    return F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))


def percent(x: Column, digits: int = 1) -> Column:
    """A fraction as a percentage text."""
    return F.concat(fixed(x * 100, digits), F.lit("%"))


def count_text(n: Column) -> Column:
    """An integer with thousands separators."""
    return F.format_number(n, 0)


def title_label(c: Column) -> Column:
    """Underscores to spaces; each run of letters starts with a capital."""
    words = F.regexp_extract_all(F.replace(c, F.lit("_"), F.lit(" ")), F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return F.array_join(F.transform(words, F.initcap), "")


def month_label(d: Column) -> Column:
    """``Jan 2024``."""
    return F.date_format(d, "MMM yyyy")
