"""Tables in numbered versions: an optimistic commit log over immutable folders.

Data files are written to folders of their own and never changed. An entry of the log maps
every table to its parts, each a folder; committing means creating the entry with the next
number, which fails if another writer has just created it. A writer that loses reads the
new latest entry, applies its change to that one and tries again, so no commit is lost and
all are visible in one order. Readers pin an entry: what they read stays as it is until the
entry expires.

A table may be kept in parts, one per month for instance. The entry then also holds each
part's row count and content digest, so a rebuild can tell which parts differ, rewrite those
alone and carry the folders of all others over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.sources import files

NO_PART = ""  # of a table that is kept whole
NULL_PART = "NULL"
RETRIES = 50


class Conflict(RuntimeError):
    """Another writer changed what this one had read."""


@dataclass
class Table:
    """Where a table's parts are, and what was in them when they were written."""

    schema: str
    parts: dict[str, str] = field(default_factory=dict)
    digests: dict[str, list[int]] = field(default_factory=dict)  # rows, digest
    origin: int = 0  # number of the entry that last changed the table


@dataclass
class Entry:
    number: int
    tables: dict[str, Table]


# -- the log ---------------------------------------------------------------------------


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/_log"


def _entry_path(root: str, number: int) -> str:
    return f"{_log(root)}/{number:020d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the entries that have not expired, ascending."""
    return [int(n[:20]) for n in files.names(spark, _log(root)) if n.endswith(".json") and n[0] != "_"]


def entry(spark: SparkSession, root: str, number: int | None = None) -> Entry:
    """The entry of that number, or the latest; number 0, without tables, if there is none."""
    if number is None:
        number = max(numbers(spark, root), default=0)
    if not number:
        return Entry(0, {})
    held = json.loads(files.read_text(spark, _entry_path(root, number)))
    return Entry(number, {n: Table(**t) for n, t in held["tables"].items()})


def commit(
    spark: SparkSession, root: str, change: Callable[[Entry], Mapping[str, Table | None]]
) -> int:
    """Add an entry: the latest one with the tables that ``change`` returns for it.

    ``change`` is called anew whenever another writer was faster; it may raise
    :class:`Conflict` if what it finds no longer fits. None removes a table.
    """
    for _ in range(RETRIES):
        latest = entry(spark, root)
        number = latest.number + 1
        tables = dict(latest.tables)
        for name, table in change(latest).items():
            tables.pop(name, None)
            if table is not None:
                table.origin = number
                tables[name] = table
        text = json.dumps({"tables": {n: asdict(t) for n, t in sorted(tables.items())}})
        if files.create_text(spark, _entry_path(root, number), text):
            return number
    raise Conflict(f"No commit to {root} after {RETRIES} attempts")


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove all entries but the latest ``keep``, and the folders that only they used.

    Folders no entry ever named, such as those of a writer still at work, are left alone.
    """
    if keep < 1:
        raise ValueError("At least the latest version must be kept")
    held = [entry(spark, root, n) for n in numbers(spark, root)]
    old, kept = held[:-keep], held[-keep:]

    def folders(entries: list[Entry]) -> set[str]:
        return {p for e in entries for t in e.tables.values() for p in t.parts.values()}

    for e in old:  # a reader that comes later finds no entry rather than half of one
        files.remove(spark, _entry_path(root, e.number))
    gone = sorted(folders(old) - folders(kept))
    for folder in gone:
        files.remove(spark, folder)
    return gone


# -- reading and writing -----------------------------------------------------------------


def row_digest(df: DataFrame) -> Column:
    """64 bits of a row's whole content."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))


def _digest_of(df: DataFrame) -> Column:
    """Of a set of rows in any order. A sum, so that equal rows do not cancel."""
    total = F.sum(row_digest(df).cast("decimal(38,0)")) % F.lit(1 << 61).cast("decimal(38,0)")
    return F.coalesce(total, F.lit(0)).cast("long")


def part_digests(df: DataFrame, part: Column) -> dict[str, list[int]]:
    """Rows and digest of every part; there is one part per month or the like."""
    rows = (
        df.groupBy(F.coalesce(part.cast("string"), F.lit(NULL_PART)).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), _digest_of(df).alias("digest"))
        .collect()
    )
    return {r["part"]: [r["rows"], r["digest"]] for r in rows}


def write(df: DataFrame, root: str, name: str) -> Table:
    """Write a table whole, to a folder of its own."""
    folder = f"{root.rstrip('/')}/data/{name}-{uuid.uuid4().hex}"
    seen = Observation(f"version-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(folder)
    return Table(df.schema.json(), {NO_PART: folder}, {NO_PART: [seen.get["rows"], 0]})


def write_parts(df: DataFrame, root: str, name: str, part: Column) -> dict[str, str]:
    """Write rows in parts, each in a folder of its own; the folder of every part."""
    folder = f"{root.rstrip('/')}/data/{name}-{uuid.uuid4().hex}"
    label = F.coalesce(part.cast("string"), F.lit(NULL_PART))
    # Hot parts are split over several tasks and small ones merged before writing.
    labelled = df.withColumn("_part", label).hint("rebalance", F.col("_part"))
    labelled.write.mode("errorifexists").partitionBy("_part").parquet(folder)
    found = files.names(df.sparkSession, folder)
    return {n.split("=", 1)[1]: f"{folder}/{n}" for n in found if n.startswith("_part=")}


def read(spark: SparkSession, at: Entry, name: str, parts: Sequence[str] | None = None) -> DataFrame:
    """A table as of an entry, or some parts of it."""
    table = at.tables[name]
    schema = T.StructType.fromJson(json.loads(table.schema))
    chosen = [p for k, p in table.parts.items() if parts is None or k in parts]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*chosen)


# -- changes -----------------------------------------------------------------------------


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., change): keys whose rows differ, as added, removed or changed.

    Rows of both sides are reduced to digests and counted per key in one shuffle; a key may
    have several rows, and a NULL key is a key.
    """
    names = [c for c in new.columns]

    def side(df: DataFrame, sign: int) -> DataFrame:
        same = df.select(*names)
        return same.select(*keys, row_digest(same).cast("decimal(38,0)").alias("_digest"), F.lit(sign).alias("_side"))

    both = side(old, -1).unionByName(side(new, 1))
    digest = F.sum(F.col("_digest") * F.col("_side"))
    held = F.sum((F.col("_side") < 0).cast("long")), F.sum((F.col("_side") > 0).cast("long"))
    return (
        both.groupBy(*keys)
        .agg(digest.alias("_differ"), held[0].alias("_old"), held[1].alias("_new"))
        .where("_differ <> 0 OR _old <> _new")
        .select(
            *keys,
            F.when(F.col("_old") == 0, "added").when(F.col("_new") == 0, "removed")
            .otherwise("changed").alias("change"),
        )
    )


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the new entry, and the parts rewritten and removed."""

    number: int
    rewritten: tuple[str, ...]
    removed: tuple[str, ...]


def refresh(
    spark: SparkSession,
    root: str,
    name: str,
    source: DataFrame,
    part: Column,
    build: Callable[[DataFrame], DataFrame],
    built_part: Column,
    touched: Sequence[str] = (),
    others: Mapping[str, DataFrame] | None = None,
) -> Refresh:
    """Bring a table up to date with its source by rewriting only parts that differ.

    The source's parts are compared by count and digest with those the last version was
    built from. Parts that differ, are new, or are named in ``touched`` (because something
    else they depend on has changed) are built from their source rows alone; parts without
    source rows go. ``build`` must keep rows in their part (``built_part`` of its result).
    ``others`` are tables to store whole in the same commit. A commit of another writer to
    the table in between is a :class:`Conflict`.
    """
    base = entry(spark, root)
    last = base.tables.get(name)
    digests = part_digests(source, part)
    before = last.digests if last else {}
    again = sorted(p for p in digests if digests[p] != before.get(p) or p in set(touched))
    gone = sorted(set(before) - set(digests))
    label = F.coalesce(part.cast("string"), F.lit(NULL_PART))
    built = build(source.where(label.isin(again)) if last else source)
    written = write_parts(built, root, name, built_part) if again else {}
    schema = built.schema.json()
    whole = {n: write(df, root, n) for n, df in (others or {}).items()}

    def change(latest: Entry) -> dict[str, Table]:
        now = latest.tables.get(name)
        if (now.origin if now else 0) != (last.origin if last else 0):
            raise Conflict(f"{name} was changed by version {now.origin if now else latest.number}")
        kept = {p: f for p, f in (last.parts if last else {}).items() if p in digests and p not in again}
        return whole | {name: Table(schema, kept | written, digests)}

    number = commit(spark, root, change)
    return Refresh(number, tuple(again), tuple(gone))
