"""A global rank that no single task has to sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchtrail.sources.store import materialize


def placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows range-partitioned and sorted by ``order``, with ``_task`` and ``_place``.

    Ranges are cut by the whole order, so equal leading values do not meet in one task as
    long as later ones tell rows apart. ``_place`` counts from 0 within ``_task``. Where a
    row stands is not repeatable: store the result before it is used.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the task in its upper bits and the row within the task below.
    number = F.monotonically_increasing_id()
    return ordered.withColumn("_number", number).select(
        "*",
        F.shiftright("_number", 33).cast("int").alias("_task"),
        F.col("_number").bitwiseAND((1 << 33) - 1).alias("_place"),
    ).drop("_number")


def global_rank(df: DataFrame, order: Sequence[Column], name: str, label: str) -> DataFrame:
    """The rows with ``name``, their rank from 1 by ``order``, which should leave no ties.

    A range's ranks follow from its sorted places and the sizes of the ranges before it:
    a running sum over as many numbers as there are tasks.
    """
    rows = materialize(placed(df, order), label)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_task").select(
        *df.columns, (F.col("_before") + F.col("_place") + 1).alias(name)
    )
