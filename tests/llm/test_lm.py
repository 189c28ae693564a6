"""The mixture of the word model against a plain computation with given weights."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.llm import interpolation_lm as lm
from touchtrail.llm import rolling


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10


def mixture(rows, weights):
    words, pairs = Counter(), Counter()
    for doc_id, tokens in rows:
        if fold(doc_id):
            words.update(tokens)
            pairs.update(zip([False, *tokens], tokens))
    total, types = sum(words.values()), len(words)
    words[False] = words[None]  # before a text: as often as ends
    found = []
    for doc_id, tokens in rows:
        value = 0.0
        for before, word in zip([False, *tokens], tokens):
            seen = words[before]
            w = weights[min(lm.BUCKETS - 1, seen.bit_length())]
            two = pairs[before, word] / seen if seen else 0.0
            value += math.log10(w[0] * two + w[1] * words[word] / max(total, 1) + w[2] / (types + 1))
        found.append((doc_id, round(value, 6)))
    return sorted(found, key=repr)


@pytest.fixture(scope="module")
def weights():
    raw = np.random.default_rng(1).random((lm.BUCKETS, 3)) + 0.05
    return raw / raw.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("name", ["corpus", "untidy"])
def test_score_is_the_mixture(request, name, weights):
    docs = request.getfixturevalue(name)
    rows = [
        (r["doc_id"], [*(r["text"] or "").encode().lower().split(), None])
        for r in docs.select("doc_id", "text").collect()
    ]
    found = [(r["doc_id"], round(r["score"], 6)) for r in lm.score(docs, weights=weights).collect()]
    assert sorted(found, key=repr) == mixture(rows, weights)


def test_many_buckets_and_few_files_change_nothing(corpus, weights, monkeypatch):
    expected = sorted(map(tuple, lm.score(corpus, weights=weights).collect()), key=repr)
    monkeypatch.setattr(rolling, "BUCKET_BYTES", rolling.BUCKET_BYTES // 4096)
    monkeypatch.setattr(lm, "MOST_FILES", 3)
    monkeypatch.setattr(lm, "CODED_BYTES", 1 << 12)
    found = sorted(map(tuple, lm.score(corpus, weights=weights).collect()), key=repr)
    assert [f[:6] for f in found] == [e[:6] for e in expected]
    assert [f[6:] for f in found] == [pytest.approx(e[6:]) for e in expected]


def test_word_numbers_are_as_wide_as_a_chunk_needs():
    for words in (10, (1 << 24), (1 << 24) + 1):
        width = lm.code_width(words)
        top = np.array([0, words - 1], dtype="<u4")
        assert rolling.unplanes(rolling.planes(top, width), "<u4", width).tolist() == top.tolist()


def test_coded_texts_read_back_with_wide_numbers(spark, corpus, monkeypatch, weights):
    expected = sorted(map(tuple, lm.score(corpus, weights=weights).collect()), key=repr)
    original = lm.code_width
    monkeypatch.setattr(lm, "code_width", lambda words: 4)
    rows = rolling.numbered(corpus, "doc_id", "text", "rows").withColumn("fold", F.lit(2))
    row = lm.encode(rows).first().asDict()
    wide = lm.Coded(row)
    monkeypatch.setattr(lm, "code_width", original)
    narrow = lm.Coded(lm.encode(rows).where(F.col("chunk") == row["chunk"]).first().asDict())
    assert wide.codes.tolist() == narrow.codes.tolist() and row["codes"][0] in (3, 4)
    assert expected


def test_left_tables_can_be_dropped(spark, corpus):
    lm.score(corpus).count()
    assert len(lm.drop_tables(spark)) >= 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(lm.TABLE_PREFIX)]
