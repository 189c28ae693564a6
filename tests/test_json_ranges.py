"""Large JSON documents cut at byte ranges, against the reader that takes them whole."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchtrail.sources import json_ranges, raw_files
from touchtrail.sources.json_ranges import Cutter

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("inner", T.StructType([T.StructField("a", T.StringType())])),
])
AWKWARD = ['}', '{"', '\\', '"]', '},{', '\\"}', "é日本", "[[", '{"list": [', "\n\t", "}}}}", ""]


def whole(spark, path, field):
    """The plain reader: one task per document."""
    document = T.StructType([T.StructField(field, T.ArrayType(SCHEMA))])
    return spark.read.schema(document).option("multiLine", True).json(path).select(F.inline(field))


def rows(df):
    return sorted(map(repr, df.collect()))


def records(n, seed):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        r = {"id": i, "name": "".join(rng.choice(AWKWARD) for _ in range(rng.randrange(6)))}
        if rng.random() < 0.4:
            r["tags"] = [rng.choice(AWKWARD) for _ in range(rng.randrange(3))]
        if rng.random() < 0.4:
            r["inner"] = {"a": rng.choice(AWKWARD), "unknown": [{"x": [1, {"y": "}"}]}]}
        if rng.random() < 0.1:
            r["name"] = None
        found.append(r)
    return found


@pytest.fixture
def narrow(spark):
    """Byte ranges of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, size) for n in names]
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("size, n, style", [
    (19, 5, {}),
    (61, 30, {"indent": 2}),
    (301, 120, {"ensure_ascii": False, "separators": (",", ":")}),
    (1 << 20, 120, {}),
])
def test_every_border(spark, narrow, tmp_path, size, n, style):
    """Ranges down to a few bytes: borders fall inside strings, escapes and nested values."""
    document = {
        "meta": {"list": [{"id": -1}], "deep": {"list": [{"id": -2}]}},
        "other": [{"id": -3, "name": "}"}], "note": "list", "list": records(n, size),
        "after": {"x": {"id": -4}}, "list2": [{"id": -5}], "end": [1, "]", None],
    }
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(document, **style), encoding="utf-8")
    narrow(size)
    got = json_ranges.read_document(spark, str(path), SCHEMA, "list")
    assert rows(got) == rows(whole(spark, str(path), "list"))
    assert got.count() == n


def test_many_documents_and_odd_ones(spark, narrow, tmp_path):
    documents = [{"list": records(40, i)} for i in range(2)]
    documents += [{"list": []}, {"list": None}, {"none": [{"id": 1}]}, {}, {"list": [{}]}]
    for i, document in enumerate(documents):
        end = ("", "\n", " \n ")[i % 3]
        (tmp_path / f"{i}.json").write_text(json.dumps(document, indent=i % 2) + end)
    narrow(700)
    got = json_ranges.read_document(spark, str(tmp_path), SCHEMA, "list")
    assert rows(got) == rows(whole(spark, str(tmp_path), "list"))
    assert got.count() == 81


def test_a_record_longer_than_ranges(spark, narrow, tmp_path):
    big = [{"id": 1, "name": "}\\\"" * 900}, {"id": 2, "tags": ["{"] * 1200}, {"id": 3}]
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"list": big}))
    narrow(512)
    assert rows(json_ranges.read_document(spark, str(path), SCHEMA, "list")) == rows(whole(spark, str(path), "list"))


def test_one_document_is_many_tasks(spark, narrow, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps({"list": [{"id": i, "name": "x" * 50} for i in range(20_000)]}))
    narrow(path.stat().st_size // 10)
    assert json_ranges.fragments(spark, str(path)).rdd.getNumPartitions() >= 8
    got = json_ranges.read_document(spark, str(path), SCHEMA, "list")
    assert got.agg(F.count("id"), F.sum("id")).first()[:] == (20_000, 19_999 * 10_000)


def test_unclosed_documents_and_bad_records_fail(spark, tmp_path):
    (tmp_path / "open.json").write_text('{"list": [{"id": 1}, {"id": 2}')
    with pytest.raises(ValueError, match="do not close"):
        json_ranges.read_document(spark, str(tmp_path / "open.json"), SCHEMA, "list")
    (tmp_path / "bad.json").write_text('{"list": [{"id": "text"}]}')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        json_ranges.read_document(spark, str(tmp_path / "bad.json"), SCHEMA, "list").collect()
    with pytest.raises(ValueError, match="Unsupported name"):
        json_ranges.read_document(spark, str(tmp_path), SCHEMA, "a}b")


def test_cutting_at_any_fragment():
    """A range that starts anywhere gives the same records as one range, piece by piece."""
    text = json.dumps({"list": records(30, 99)})
    pieces = text.split("}")[:-1]
    one = Cutter(False, 0)
    expected = [t for p in pieces for k, _, t in one.take(p) if k == json_ranges.WHOLE]
    assert [json.loads(t)["id"] for t in expected] == list(range(30))
    for at in range(1, len(pieces)):
        first = Cutter(False, 0)
        got = [r for p in pieces[:at] for r in first.take(p)]
        second = Cutter(first.in_string, first.depth)
        later = [r for p in pieces[at:] for r in second.take(p)]
        texts = [t for k, _, t in got if k == json_ranges.WHOLE]
        crossing = "".join(t for _, _, t in first.rest()) + "".join(
            t for k, _, t in later if k == json_ranges.HEAD)
        texts += [crossing] if crossing else []
        assert texts + [t for k, _, t in later if k == json_ranges.WHOLE] == expected


def test_sources_take_this_route(spark, narrow, tmp_path):
    table = spark.range(500).select(
        *(F.concat(F.lit(c), F.col("id").cast("string"), F.lit('"}{')).alias(c)
          for c in ("user_id", "signup_date")))
    raw_files.write_json_source(table, str(tmp_path / "s.json"), "user_id", documents=2)
    narrow(999)
    got = raw_files.read_json_source(spark, str(tmp_path / "s.json"), table.schema)
    assert rows(got) == rows(table)
