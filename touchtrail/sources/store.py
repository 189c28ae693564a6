"""Table sinks: scratch tables, versioned raw loads, catalog tables and append logs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.config import LAYERS
from touchtrail.sources import files, versions

_LOCAL_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder, as named by the session's ``spark.checkpoint.dir``.

    Only a single-machine session may go without the setting; it then gets one
    temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="touchtrail-"))
    return _LOCAL_SCRATCH[0]


# Folders that this process has written under the scratch folder.
_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the scratch folder, remembered for :func:`clear_scratch`."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this process; tables read from them are gone too."""
    removed = sum(files.remove(spark, path) for path in _WRITTEN)
    _WRITTEN.clear()
    return removed


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    Cuts lineage for results with several consumers, survives executor loss, and
    gives later joins the measured table size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- versioned raw load ----------------------------------------------------------


def publish_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str
) -> dict[str, int]:
    """Rebuild a set of tables as one version, visible all at once or not at all.

    Every table goes to a folder of its own. Only after all writes succeeded is the
    version committed, so readers keep seeing the previous version when any write fails.
    Loaders that publish at once both succeed, one version after the other.

    Returns the rows written per table, counted while writing.
    """
    written = {name: versions.write(df, root, name) for name, df in tables.items()}
    versions.commit(spark, root, lambda latest: written)
    return {name: table.digests[versions.NO_PART][0] for name, table in written.items()}


def current_version(spark: SparkSession, root: str) -> int:
    return versions.entry(spark, root).number


def read_published(
    spark: SparkSession, root: str, names: list[str], version: int | None = None
) -> dict[str, DataFrame]:
    """Tables of one version, the latest if none is named; later versions do not matter."""
    at = versions.entry(spark, root, version)
    return {name: versions.read(spark, at, name) for name in names}


# -- layer tables ----------------------------------------------------------------


def layer_table(layer: str, name: str, layers: Mapping[str, str] = LAYERS) -> str:
    """Catalog name of a table: the layer's database name, used verbatim."""
    return f"{layers[layer]}.{name}"


def overwrite_table(
    df: DataFrame, layer: str, name: str, partition_by: str | None = None
) -> None:
    """Full rebuild of a catalog table.

    A partitioned write is rebalanced on the partition column first: hot values
    are split over several tasks and small ones merged, so files stay even.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {LAYERS[layer]}")
    writer_input = df if partition_by is None else df.hint("rebalance", F.col(partition_by))
    writer = writer_input.write.mode("overwrite").format("parquet")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(layer_table(layer, name))


def append_table(df: DataFrame, layer: str, name: str) -> None:
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {LAYERS[layer]}")
    df.write.mode("append").format("parquet").saveAsTable(layer_table(layer, name))


def read_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return spark.table(layer_table(layer, name))
