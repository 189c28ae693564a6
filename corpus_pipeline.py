"""A training corpus in five stages, each written as Parquet and read by the next.

1. quality rules: documents that the threshold table rejects go;
2. near-duplicates: of each group of similar documents the one with the smallest id stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: every found span is replaced by its kind, the document stays;
5. packing: what is left, as token pieces placed in sequences.

A stage takes (spark, docs, sf_dir) and works on all rows of ``docs``. Rows may repeat and
columns may hold NULLs; further columns are passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.llm import decontaminate, packing, quality_rules, secret_ledger, simhash
from touchtrail.llm.common import free_name, read_table, stored, with_row
from touchtrail.llm.queries import packing_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality table keeps. NULL and empty texts have no words and go; repeated
    rows are judged one by one. Stop words count only where ``lang`` names a covered language.
    """
    return quality_rules.kept_rows(docs, lang_col="lang" if "lang" in docs.columns else None)


def _but(rows: DataFrame, gone: DataFrame, row: str, docs: DataFrame) -> DataFrame:
    """The rows whose number is not in ``gone``, with the columns of ``docs``."""
    numbers = gone.select(F.col("doc_id").alias(row)).distinct()
    return rows.join(numbers, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.8 or more; one row of each group stays.

    Repeated rows are copies of each other; NULL texts are empty ones and alike.
    """
    row = free_name(docs, "_row")
    rows = with_row(docs, row)
    groups = simhash.similar_groups(rows, shingle=5, least=0.8, id_col=row)
    return _but(rows, groups.where("doc_id <> group_id"), row, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item; NULL and empty texts hold none. An empty benchmark
    keeps all rows.
    """
    row = free_name(docs, "_row")
    rows = with_row(docs, row)
    found = decontaminate.leaks(rows, read_table(spark, sf_dir, "benchmark"), id_col=row)
    return _but(rows, found, row, docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, every secret in their texts replaced; ``n_chars``, where the table has it,
    follows where a text has changed. NULL texts stay NULL.
    """
    row, hits, clean = (free_name(docs, c) for c in ("_row", "_hits", "_clean"))
    rows = with_row(docs, row)
    found = (
        secret_ledger.scan(rows, id_col=row)
        .where(F.size("findings") > 0)
        .select(F.col("doc_id").alias(row), F.col("findings").alias(hits))
    )
    joined = rows.join(found, row, "left").withColumn(
        clean,
        F.when(F.col(hits).isNull(), F.col("text")).otherwise(
            secret_ledger.redacted(F.col("text"), F.col(hits))
        ),
    )
    changed = {
        "text": F.col(clean),
        "n_chars": F.when(
            F.col(hits).isNotNull(), F.char_length(clean).cast("long")
        ).otherwise(F.col("n_chars") if "n_chars" in docs.columns else None),
    }
    return joined.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of 2,048 tokens; a NULL or empty text is its end token."""
    return packing.pack(docs, packing_tokenizer(), capacity=2048)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("best_fit_packing", packed),
]

# Fingerprints, BM25 and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs
