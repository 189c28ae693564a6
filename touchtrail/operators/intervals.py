"""Which dated intervals hold a day: an equi join on an index of day ranges.

An interval of days is filed under the smallest power of two that is at least as long, in
the one or two aligned cells of that width which it touches. A day meets an interval only
if, at the interval's width, it stands in such a cell, so it is compared with intervals
that are alive about then and not with all that share the other keys. Widths follow the
intervals: short and long ones are filed side by side, each at its own.

Days are looked up once per distinct (key, day), however many rows have it. A key that is
shared by many intervals and by a third of all rows then has at most one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTHS = 32  # powers of two; all days of the calendar fit below


def _day(date: Column) -> Column:
    return F.unix_date(date)


def _cell(day: Column, width: Column) -> Column:
    return F.call_function("shiftright", day, width)


def indexed(intervals: DataFrame, first: str, last: str) -> DataFrame:
    """The intervals with ``_width`` and ``_cell``, one row per cell they touch.

    Intervals without a bound, or that end before they start, hold no day and drop out.
    """
    length = F.col("_last") - F.col("_first") + 1
    width = F.ceil(F.log2(length.cast("double"))).cast("int")
    placed = (
        intervals.withColumns({"_first": _day(F.col(first)), "_last": _day(F.col(last))})
        .where("_last >= _first")
        .withColumn("_width", width)
    )
    low, high = (_cell(F.col(c), F.col("_width")) for c in ("_first", "_last"))
    return placed.withColumn("_cell", F.explode(F.sequence(low, high))).drop("_first", "_last")


def widths_in_use(index: DataFrame) -> DataFrame:
    """The distinct widths, at most WIDTHS, as one row with an array."""
    return index.agg(F.array_sort(F.collect_set("_width")).alias("_widths"))


def _meetings(
    days: DataFrame,
    index: DataFrame,
    keys: Sequence[str],
    day: str,
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """Each day once per width in use, joined with the intervals filed in its cell.

    With ``widths`` known, days are few and go to where the intervals are.
    """
    few = widths is not None
    widths = F.array(*map(F.lit, widths)).cast("array<int>") if few else widths_in_use(index).scalar()
    looked_up = (
        days.where(F.col(day).isNotNull())
        .withColumn("_width", F.explode(widths))
        .withColumn("_cell", _cell(_day(F.col(day)), F.col("_width")))
    )
    return (F.broadcast(looked_up) if few else looked_up).join(index, [*keys, "_width", "_cell"])


def alive(
    days: DataFrame,
    index: DataFrame,
    keys: Sequence[str],
    day: str,
    first: str,
    last: str,
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of distinct ``days`` joined with the index rows whose interval holds the day.

    ``days`` and ``index`` share the names of the keys. Every (row, interval) pair comes
    once: an interval's cells are disjoint.
    """
    met = _meetings(days, index, keys, day, widths)
    return met.where(F.col(day).between(F.col(first), F.col(last))).drop("_width", "_cell")


def work(days: DataFrame, index: DataFrame, keys: Sequence[str], day: str, first: str, last: str) -> DataFrame:
    """One row: pairs that meet in a cell, pairs whose interval holds the day."""
    met = _meetings(days, index, keys, day)
    holds = F.col(day).between(F.col(first), F.col(last))
    return met.agg(
        F.count(F.lit(1)).alias("examined"), F.coalesce(F.sum(holds.cast("long")), F.lit(0)).alias("matched")
    )


def most_shared(intervals: DataFrame, keys: Sequence[str]) -> int:
    """Intervals of the most shared key; keys with a NULL are nobody's."""
    counts = intervals.dropna("any", subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).first()["n"]
