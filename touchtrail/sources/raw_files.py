"""Typed reads of the source files.

Every source may be one file or a folder of files; a CSV file is splittable, so
large files are read in parallel. Casts are strict: under ANSI mode a bad value
fails the job instead of becoming NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.config import SOURCE_NULL
from touchtrail.sources import files, json_ranges
from touchtrail.sources.schemas import RAW_SCHEMAS, SOURCE_FILES


def source_paths(data_dir: str, files: Mapping[str, str] = SOURCE_FILES) -> dict[str, str]:
    return {table: f"{data_dir.rstrip('/')}/{name}" for table, name in files.items()}


def missing_sources(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Paths that do not exist, as a list."""
    return [path for path in paths.values() if not files.exists(spark, path)]


def require_sources(spark: SparkSession, paths: Mapping[str, str]) -> None:
    absent = missing_sources(spark, paths)
    if absent:
        raise FileNotFoundError("Missing required source file(s): " + ", ".join(absent))


def _text_value(name: str) -> Column:
    """Blank stays an empty text; only the sentinel is NULL."""
    value = F.col(f"`{name}`")
    return F.when(value == SOURCE_NULL, F.lit(None)).otherwise(F.coalesce(value, F.lit("")))


def _typed(value: Column, kind: T.DataType) -> Column:
    return value if isinstance(kind, T.StringType) else value.cast(kind)


def read_csv_source(
    spark: SparkSession, path: str, schema: T.StructType, *, multiline_values: bool = False
) -> DataFrame:
    """CSV with a header, columns matched by header name, then cast strictly.

    ``multiline_values`` allows line breaks inside quotes; such files cannot be
    split, so it is off unless asked for.
    """
    lines = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multiline_values)
        .csv(path)
    )
    return lines.select(
        *[_typed(_text_value(f.name), f.dataType).alias(f.name) for f in schema.fields]
    )


def read_json_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    list_field: str | None = "signups",
) -> DataFrame:
    """Records of JSON documents ``{list_field: [{...}, ...]}``.

    A document of any size is read by as many tasks as it has byte ranges. With
    ``list_field=None`` files hold one record per line.
    """
    if list_field is None:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return json_ranges.read_document(spark, path, schema, list_field)


def read_sources(
    spark: SparkSession, data_dir: str, named: Mapping[str, str] = SOURCE_FILES
) -> dict[str, DataFrame]:
    """All raw tables of a source folder; fails early when any file is absent."""
    paths = source_paths(data_dir, named)
    require_sources(spark, paths)
    tables = {}
    for table, path in paths.items():
        schema = RAW_SCHEMAS[table]
        if path.endswith(".json"):
            tables[table] = read_json_source(spark, path, schema)
        elif path.endswith(".jsonl"):
            tables[table] = read_json_source(spark, path, schema, list_field=None)
        else:
            tables[table] = read_csv_source(spark, path, schema)
    return tables


# -- writing -----------------------------------------------------------------------

# Compressed files are read whole by one task each, so large ones are cut.
ROWS_PER_FILE = 2_000_000


def write_csv_source(df: DataFrame, path: str) -> None:
    """A folder of compressed CSV files with headers; NULL is written as the sentinel."""
    values = [
        F.coalesce(F.col(c).cast("string"), F.lit(SOURCE_NULL)).alias(c) for c in df.columns
    ]
    (
        df.select(*values)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(path)
    )


def write_json_source(
    df: DataFrame, path: str, key: str, documents: int = 8, list_field: str = "signups"
) -> None:
    """A folder of JSON documents ``{list_field: [{...}, ...]}``, rows dealt by ``key``."""
    record = F.struct(*df.columns)
    dealt = df.groupBy(F.pmod(F.xxhash64(key), F.lit(documents)).alias("_document")).agg(
        F.collect_list(record).alias(list_field)
    )
    text = F.to_json(F.struct(list_field), {"ignoreNullFields": "false"})
    dealt.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def write_sources(
    tables: Mapping[str, DataFrame], data_dir: str, files: Mapping[str, str] = SOURCE_FILES
) -> None:
    """The raw tables as a source folder that :func:`read_sources` reads."""
    for table, path in source_paths(data_dir, files).items():
        if path.endswith(".json"):
            write_json_source(tables[table], path, tables[table].columns[0])
        else:
            write_csv_source(tables[table], path)
