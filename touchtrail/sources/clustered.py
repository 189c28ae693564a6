"""Tables laid out along a space-filling curve, for reads that select on several columns.

Each column becomes a number of BITS bits; the numbers' bits, taken in turns, make one key,
and rows are range-partitioned and sorted by it. Rows that are close in all columns then
stand close together, so a file's row groups span a small range of every column, and a
selection on any of them skips most row groups by their statistics. A single sort order
would do so for its first column alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
# Values of a column that are listed to number them in order; more are hashed instead.
LISTED = 4096
ROW_GROUP_BYTES = 8 << 20


def numbered(df: DataFrame, column: str) -> Column:
    """The column as a number of BITS bits, NULL as 0.

    Dates and numbers are scaled between their bounds. Of other columns up to LISTED distinct
    values keep their order; a column with more is spread by a hash, which still keeps equal
    values together.
    """
    c = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    top = (1 << BITS) - 1
    if isinstance(kind, (T.DateType, T.NumericType)):
        value = F.unix_date(c).cast("double") if isinstance(kind, T.DateType) else c.cast("double")
        low, high = df.agg(F.min(value), F.max(value)).first()
        if low is None or high == low:
            return F.lit(0)
        share = (value - F.lit(float(low))) / F.lit(float(high) - float(low))
        return F.coalesce(F.floor(share * top), F.lit(0)).cast("long")
    values = [r[0] for r in df.select(c).where(c.isNotNull()).distinct().limit(LISTED + 1).collect()]
    if len(values) > LISTED:
        return F.coalesce(F.pmod(F.xxhash64(c), F.lit(1 << BITS)), F.lit(0))
    if not values:
        return F.lit(0)
    place = F.array_position(F.array(*(F.lit(v) for v in sorted(values))), c)
    return F.coalesce(F.floor(place * top / len(values)), F.lit(0)).cast("long")


def curve(numbers: Sequence[Column]) -> Column:
    """The numbers' bits in turns, highest first."""
    key = F.lit(0).cast("long")
    for bit in reversed(range(BITS)):
        for number in numbers:
            taken = F.shiftright(number.cast("long"), bit).bitwiseAND(1)
            key = key * 2 + taken
    return key


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write the rows to Parquet files along the curve through the columns.

    ``df`` is read once per column for its bounds or values and once for the rows.
    """
    if not 0 < len(columns) * BITS <= 63:
        raise ValueError("One to seven columns")
    key = curve([numbered(df, c) for c in columns])
    keyed = df.withColumn("_curve", key)
    (
        keyed.repartitionByRange("_curve")
        .sortWithinPartitions("_curve")
        .drop("_curve")
        .write.option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )
