"""One large JSON document ``{list_field: [{...}, ...], ...}``, read by many tasks.

The text reader splits any file it can cut at a separator; with ``}`` as the separator a
document of any size becomes fragments, dealt over as many tasks as it has byte ranges.
What a fragment means depends on what came before it: whether the range starts inside a
string, and how deep. Both are found in two steps:

1. every range reports the parity of its unescaped quotes and how much its brackets change
   the depth, for either assumption about its start. Running sums over the ranges of a
   document, a few numbers each, give every range its true start;
2. every range cuts its own records out of the text. Records that cross into the next
   range leave as pieces, at most two per range, and are joined by a small shuffle.

Text is never shuffled, but for those pieces. Braces, brackets and quotes inside strings
are text like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.sources.store import materialize

# A whole flat record that a fragment may be, up to its closing brace.
FLAT = re.compile(r'[\s,]*(\{(?:[^"{}\[\]\\]|"(?:[^"\\]|\\.)*")*)\Z', re.DOTALL)
TOKEN = re.compile(r'"|\\.|[{}\[\]]', re.DOTALL)
ESCAPED = re.compile(r"\\.", re.DOTALL)
# Depth of the list's records: document, list, record.
DOCUMENT, LIST, RECORD = 1, 2, 3
WHOLE, ARRAY, TAIL, HEAD = range(4)

Fragments = Iterator[tuple[tuple[int, int], list[str]]]


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """(doc, start, value): text up to each ``}``, in order within a byte range."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Fragments:
    """Consecutive fragments of one range; a range may come in several parts."""
    for batch in batches:
        docs, starts = batch.column("doc").to_pylist(), batch.column("start").to_pylist()
        values = batch.column("value").to_pylist()
        first = 0
        for i in range(1, len(docs) + 1):
            if i == len(docs) or (docs[i], starts[i]) != (docs[first], starts[first]):
                yield (docs[first], starts[first]), values[first:i]
                first = i


# -- where ranges start ------------------------------------------------------------------


def _depth(parts: list[str]) -> int:
    text = "".join(parts)
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part of a range: unescaped quotes, depth change if it starts outside or inside a string."""
    out: list[tuple] = []
    for n, ((doc, start), values) in enumerate(_by_range(batches)):
        parts = ESCAPED.sub("", "}".join(values) + "}").split('"')
        out.append((doc, start, n, len(parts) - 1, _depth(parts[0::2]), _depth(parts[1::2])))
    names = ["doc", "start", "part", "quotes", "outside", "inside"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in out], pa.int64()) for i in range(6)], names=names
    )


def range_starts(pieces: DataFrame) -> DataFrame:
    """(doc, start, in_string, depth) at the start of every range: one short row per range.

    Raises nothing; ``final_depth`` is the depth at the end of the document, for a check.
    """
    measured = pieces.mapInArrow(
        _measure, "doc long, start long, part long, quotes long, outside long, inside long"
    )
    earlier = Window.partitionBy("doc").orderBy("start", "part")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    told = measured.withColumn("in_string", quotes % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    told = told.withColumn("change", change).withColumn(
        "depth", F.coalesce(F.sum("change").over(before), F.lit(0))
    )
    every = Window.partitionBy("doc")
    told = told.withColumn("final_depth", F.sum("change").over(every))
    return told.groupBy("doc", "start").agg(
        F.min_by("in_string", "part").alias("in_string"),
        F.min_by("depth", "part").cast("int").alias("depth"),
        F.max("final_depth").alias("final_depth"),
    )


# -- records -----------------------------------------------------------------------------


class Cutter:
    """Cuts the records of one range; ``take`` gets a fragment without its closing brace.

    ``arrays`` counts the lists of the document that were opened in this range; a record is
    told by the last of them, or, for 0, by the list that was open before.
    """

    def __init__(self, in_string: bool, depth: int) -> None:
        self.in_string, self.depth = in_string, depth
        # What is open at the start belongs to a record of an earlier range.
        self.held: list[str] | None = [] if depth >= RECORD else None
        self.kind = HEAD
        self.arrays = 0
        self.key_from: tuple[str, int] | None = None
        self.key: str | None = None

    def take(self, value: str) -> Iterator[tuple[int, int, str]]:
        if self.held is None and self.depth == LIST and not self.in_string:
            flat = FLAT.match(value)
            if flat:
                yield WHOLE, self.arrays, flat[1] + "}"
                return
        text = value + "}"
        from_, opened = 0, -1
        for token in TOKEN.finditer(text):
            sign, at = token[0], token.start()
            if sign == '"':
                self.in_string = not self.in_string
                if self.depth == DOCUMENT:
                    if self.in_string:
                        opened = at
                    else:
                        self.key = text[opened : at + 1] if opened >= 0 else None
            elif self.in_string or len(sign) > 1:
                continue
            elif sign in "{[":
                self.depth += 1
                if self.depth == LIST:  # an object in a list's place is nobody's list
                    self.arrays += 1
                    yield ARRAY, self.arrays, (self.key or "") if sign == "[" else ""
                elif self.depth == RECORD and self.held is None:
                    self.held, self.kind, from_ = [], WHOLE, at
            else:
                self.depth -= 1
                if self.depth == LIST and self.held is not None:
                    self.held.append(text[from_ : at + 1])
                    yield self.kind, self.arrays, "".join(self.held)
                    self.held = None
        if self.held is not None:
            self.held.append(text[from_:])

    def rest(self) -> Iterator[tuple[int, int, str]]:
        """A record that goes on in the next range; of a range within one record, all of it."""
        if self.held is not None:
            yield (TAIL if self.kind == WHOLE else HEAD), self.arrays, "".join(self.held)


CUT = "doc long, start long, kind int, arrays int, text string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter: Cutter | None = None
    here: tuple[int, int] | None = None

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
            names=["doc", "start", "kind", "arrays", "text"],
        )

    for batch in batches:
        rows: list[tuple] = []
        offset = 0
        for place, values in _by_range(iter([batch])):
            if place != here:
                if cutter is not None:
                    rows += [(*here, *r) for r in cutter.rest()]
                start = (batch.column(c)[offset].as_py() for c in ("in_string", "depth"))
                cutter, here = Cutter(*start), place
            offset += len(values)
            for value in values:
                rows += [(*here, *r) for r in cutter.take(value)]
        yield packed(rows)
    if cutter is not None:
        yield packed([(*here, *r) for r in cutter.rest()])


def read_document(
    spark: SparkSession, path: str, schema: T.StructType, list_field: str
) -> DataFrame:
    """Records of the documents' top-level list ``list_field``, by the schema.

    ``path`` is a file or a folder of files, one document each; columns that a record lacks
    are NULL, other fields are ignored. Elements of the list are objects. A document
    without the list, or with NULL in its place, has no records. Raises if the brackets of a
    document do not close, or a record does not parse. Not for list names with ``}`` or
    escapes.
    """
    if re.search(r'[}"\\]', list_field):
        raise ValueError(f"Unsupported name of a list: {list_field!r}")
    pieces = fragments(spark, path)
    starts = range_starts(pieces)
    # One row of a few numbers per byte range: 800,000 rows, some 40 MB, for 100 TB in splits
    # of 128 MB. Collected once, it also tells whether every document closes.
    known = starts.collect()
    # The text after the last brace reads as a fragment of its own and counts one more.
    unclosed = sum(r["final_depth"] not in (0, -1) for r in known)
    if unclosed:
        raise ValueError(f"Brackets do not close in a document of {path}")
    begins = spark.createDataFrame(known, starts.schema).select("doc", "start", "in_string", "depth")
    told = pieces.join(F.broadcast(begins), ["doc", "start"])
    cut = materialize(
        told.select("doc", "start", "in_string", "depth", "value").mapInArrow(_cut, CUT), "json-records"
    )

    # Which list a record belongs to: the last one opened in its range, or before it.
    quoted = f'"{list_field}"'
    lists = cut.where(F.col("kind") == ARRAY).select(
        "doc", "start", "arrays", (F.col("text") == quoted).alias("wanted")
    )
    in_range = lists.groupBy("doc", "start").agg(F.max_by("wanted", "arrays").alias("last"))
    before = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carried = begins.select("doc", "start").join(in_range, ["doc", "start"], "left").select(
        "doc", "start", F.lit(0).alias("arrays"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(False)).alias("wanted"),
    )
    wanted = lists.unionByName(carried).where("wanted").drop("wanted")

    # Pieces: a tail opens a record, heads up to the next tail continue it.
    crossing = cut.where(F.col("kind").isin(TAIL, HEAD))
    order = Window.partitionBy("doc").orderBy("start", F.desc("kind"))
    numbered = crossing.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = numbered.groupBy("doc", "record").agg(
        F.min_by("start", F.struct("start", F.col("kind") == HEAD)).alias("start"),
        F.min_by("arrays", F.struct("start", F.col("kind") == HEAD)).alias("arrays"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("start", (F.col("kind") == HEAD).alias("later"), "text"))),
                lambda p: p["text"],
            ),
            "",
        ).alias("text"),
    )
    records = (
        cut.where(F.col("kind") == WHOLE)
        .select("doc", "start", "arrays", "text")
        .unionByName(joined.select("doc", "start", "arrays", "text"))
        .join(F.broadcast(wanted), ["doc", "start", "arrays"], "left_semi")
    )
    parsed = F.from_json("text", schema, {"mode": "FAILFAST"})
    return records.select(parsed.alias("record")).select("record.*")
