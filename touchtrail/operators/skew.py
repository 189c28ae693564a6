"""Left/inner joins that stay balanced when one key holds a large part of the rows.

Two routes, chosen by the size of the lookup side:

* at most ``SkewConfig.broadcast_rows`` rows: broadcast it, nothing is shuffled;
* more: shuffle join, with hot keys split over ``SkewConfig.salts`` tasks. Only
  lookup rows of a hot key are repeated, and there are at most ``1 / hot_share``
  hot keys, so the repetition is bounded. Rows with a NULL key cannot match and
  are spread over the salts too.

Both routes return the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.config import SKEW, SkewConfig

Residual = Callable[[DataFrame, DataFrame], Column]


def is_small(df: DataFrame, config: SkewConfig = SKEW) -> bool:
    """Whether the table may be broadcast, by its rows.

    Files tell little of the memory rows take: campaigns of 11 bytes each are 300 in a
    broadcast, and pass through the driver. Rows are counted without any columns, which for
    a stored table is a read of the footers.
    """
    return config.broadcast_rows > 0 and df.count() <= config.broadcast_rows


def hot_keys(df: DataFrame, keys: Sequence[str], config: SkewConfig = SKEW) -> DataFrame:
    """Key values holding more than ``hot_share`` of the rows: at most ``1 / hot_share``.

    Reads only the key columns and counts before the shuffle.
    """
    named = df.select(*keys).dropna("any")
    total = df.select(F.count(F.lit(1)).alias("rows")).scalar()
    return (
        named.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > F.lit(config.hot_share) * total)
        .select(*keys)
    )


def _spread(columns: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    residual: Residual | None = None,
    config: SkewConfig = SKEW,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join on ``keys`` (same names on both sides) with hot keys split.

    ``spread_by`` names left columns that differ between rows of a hot key. The
    right side's key columns are dropped from the result. ``keys_from`` is a frame
    with the same keys as ``left`` that is cheaper to count; which keys count as
    hot only steers the spreading, never the result.
    """
    counted = left if keys_from is None else keys_from
    hot = F.broadcast(hot_keys(counted, keys, config).withColumn("_hot", F.lit(True)))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    split = any_null | F.col("_hot").isNotNull()
    salted_left = (
        left.join(hot, list(keys), "left")
        .withColumn("_salt", F.when(split, _spread(spread_by, config.salts)).otherwise(0))
        .drop("_hot")
    )
    copies = F.when(
        F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(config.salts - 1))
    ).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(hot, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    # By its size in the files alone Spark would broadcast what was found to have too many rows.
    return plain_join(salted_left, salted_right.hint("merge"), [*keys, "_salt"], how, residual)


def plain_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, residual: Residual | None
) -> DataFrame:
    """Join on equally named keys plus a residual condition, keeping the left keys."""
    # The right key columns get private names, so that nothing is ambiguous.
    private = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(private)
    condition = F.lit(True)
    for k in keys:
        condition = condition & (left[k] == right[private[k]])
    if residual is not None:
        condition = condition & residual(left, right)
    return left.join(right, condition, how).drop(*private.values()).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    residual: Residual | None = None,
    config: SkewConfig = SKEW,
    small: bool | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Broadcast ``right`` if its counted size allows, else :func:`salted_join`.

    ``small`` passes on a size check made earlier for the same lookup table.
    """
    if is_small(right, config) if small is None else small:
        return plain_join(left, F.broadcast(right), keys, how, residual)
    return salted_join(left, right, keys, spread_by, how, residual, config, keys_from)
