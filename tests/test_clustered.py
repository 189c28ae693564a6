"""Layout along a space-filling curve: what a selective read has to open."""

from __future__ import annotations

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from touchtrail.sources import clustered


def sales(spark, n):
    return spark.range(n).select(
        "id",
        F.concat(F.lit("C"), (F.col("id") * 7919 % 20).cast("string")).alias("company"),
        F.concat(F.lit("ch"), (F.col("id") * 104729 % 13).cast("string")).alias("channel"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 31 % 1500).cast("int")).alias("day"),
        F.md5(F.col("id").cast("string")).alias("note"),
    )


def opened(path, **wanted):
    """Share of row groups whose statistics admit the wanted values."""
    found = total = 0
    for fragment in ds.dataset(path).get_fragments():
        for group in fragment.row_groups:
            total += 1
            stats = group.statistics
            found += all(stats[c]["min"] <= v <= stats[c]["max"] for c, v in wanted.items())
    return found / total, total


def scanned_rows(df):
    """Rows that left the scan of an executed plan without exchanges."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    return node.metrics().get("numOutputRows").get().value()


def test_selections_on_any_column_skip_most_row_groups(spark, tmp_path):
    df = sales(spark, 200_000).repartition(8)
    path = str(tmp_path / "t")
    clustered.write_clustered(df, path, ["company", "channel", "day"], 64 << 10)
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 200_000 and back.agg(F.sum("id")).first() == df.agg(F.sum("id")).first()
    share, groups = opened(path, company="C7", channel="ch4")
    assert groups > 50 and share <= 0.3
    assert opened(path, company="C7")[0] <= 0.5 and opened(path, channel="ch4")[0] <= 0.5
    chosen = back.where("company = 'C7' AND channel = 'ch4'")
    assert scanned_rows(chosen) <= 0.3 * 200_000
    plain = str(tmp_path / "plain")
    df.sortWithinPartitions("day").write.option("parquet.block.size", 64 << 10).parquet(plain)
    assert opened(plain, company="C7", channel="ch4")[0] > 0.9


def test_bits_in_turns(spark):
    a, b = F.lit(0b10110011), F.lit(0b01010101)
    key = spark.range(1).select(clustered.curve([a, b]).alias("k")).first()["k"]
    expected = "".join(x + y for x, y in zip("10110011", "01010101"))
    assert f"{key:016b}" == expected


def test_nulls_single_values_many_values_and_no_rows(spark, tmp_path, monkeypatch):
    df = sales(spark, 500).withColumn("one", F.lit(3)).withColumn(
        "gone", F.lit(None).cast("string")).withColumn(
        "channel", F.when(F.col("id") % 3 == 0, F.col("channel")))
    monkeypatch.setattr(clustered, "LISTED", 50)
    columns = ["note", "channel", "one", "gone", "company", "day"]
    for i, rows in enumerate((df, df.limit(0))):
        path = str(tmp_path / str(i))
        clustered.write_clustered(rows, path, columns)
        assert spark.read.schema(df.schema).parquet(path).exceptAll(rows).count() == 0
        assert spark.read.schema(df.schema).parquet(path).count() == rows.count()
    with pytest.raises(ValueError):
        clustered.write_clustered(df, str(tmp_path / "x"), [])
