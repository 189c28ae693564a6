"""The stages of the corpus pipeline on a small table with planted cases."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F


def planted(spark, folder):
    rng = random.Random(11)
    common = ["the", "and", "of", "to", "in"]

    def words(n):
        return [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(4000)}" for _ in range(n)]

    clean = [" ".join(words(150)) for _ in range(12)]
    item = " ".join(words(30))
    copied = clean[0].split()
    copied[70] = "edited"
    rows = {i: t for i, t in enumerate(clean)}
    rows |= {
        50: clean[1],  # exact copy
        51: " ".join(copied),  # near copy
        52: " ".join(words(60) + item.split() + words(60)),  # benchmark leak
        53: " ".join(words(80)) + " token=abcdefgh1234 " + " ".join(words(80)),
        54: "too short",
        55: None,
        56: "again and again " * 60,
    }
    docs = spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows.items()],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return docs


def test_stages(spark, tmp_path):
    docs = planted(spark, str(tmp_path))
    columns = docs.columns
    gone = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, str(tmp_path))
        assert docs.columns == columns, name
        left = {r["doc_id"] for r in docs.collect()}
        gone.append({r["doc_id"] for r in before.collect()} - left)
    assert gone == [{54, 55, 56}, {50, 51}, {52}, set()]
    secret = docs.where("doc_id = 53").first()
    assert "[assign]" in secret["text"] and "abcdefgh1234" not in secret["text"]
    assert docs.where(F.col("n_chars") != F.char_length("text")).isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == {*range(12), 53}


def test_run_is_the_stages_one_after_another(spark, tmp_path):
    planted(spark, str(tmp_path))
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in result.collect()} == {*range(12), 53}
    assert corpus_pipeline.ORACLE_SQL is None


NAMES = ("_row", "__row", "_clean", "_hits", "findings", "_whole", "blob", "node", "language", "key", "kept", "length")


def test_every_column_stays(spark, tmp_path, corpus, benchmark):
    """Columns named like the stages' own keep their values; changed are text and n_chars alone."""
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = corpus.select("doc_id", "text", "lang", "source", "n_chars")
    docs = plain.select("*", *(F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in NAMES))
    own = [c for c in docs.columns if c not in ("text", "n_chars")]
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        rows = docs.collect()
        assert rows and docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *NAMES], name
        for r in rows:
            assert [r[c] for c in own] == [before[r["doc_id"]][c] for c in own], name
            if name != "secret_scan":
                assert r == before[r["doc_id"]], name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in rows}


def test_run_on_clashing_and_untidy_tables(spark, tmp_path, untidy, benchmark):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = untidy.select("*", *(F.lit(i).alias(c) for i, c in enumerate(NAMES)))
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_no_text_is_too_long_or_in_the_wrong_language(spark):
    russian = " ".join(f"слово{i}" for i in range(120))
    japanese = " ".join(f"言葉{i}" for i in range(120))
    finnish = " ".join(f"sana{i} ja" for i in range(60))
    polish = " ".join(f"wyraz{i} że" for i in range(60))
    nothing = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, russian, "ru"), (2, japanese, "ja"), (3, finnish, "fi"), (4, polish, None),
        (5, nothing, "en"), (6, nothing + " the of and", "EN"), (7, nothing, ""), (8, "short", "ru"),
        (9, " ".join(f"the w{i}" for i in range(500_001)), "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.quality(spark, docs, "")
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {1, 2, 3, 4, 6, 7, 9}
    without = corpus_pipeline.quality(spark, docs.drop("lang"), "")
    assert {r["doc_id"] for r in without.select("doc_id").collect()} == {1, 2, 3, 4, 5, 6, 7, 9}


def test_untidy_rows_pass_through(spark, tmp_path, untidy, benchmark):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = untidy
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == untidy.columns, name
    assert docs.count() < untidy.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    pieces = packed.select("doc_id").distinct().count()
    assert pieces == docs.select("doc_id").distinct().count()
    empty = untidy.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
