"""Secret scan with an incremental ledger of blobs.

Every text is addressed by its content (SHA-256). A ledger table remembers which
(blob, rule version) pairs have been scanned and what was found in them. A run

1. reduces the rows to distinct blobs (one row per address, before any text moves),
2. leaves out the pairs the ledger already has,
3. scans the remaining blobs once each and appends them to the ledger,
4. joins the findings back to every row (path, version) with that content.

The ledger is a Parquet table, one folder per rule version, that only grows by appends, so a failed run leaves
earlier entries untouched and a repeated one scans what is still missing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, stored, table_batch, texts
from touchtrail.sources.store import scratch_path


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds candidates; ``group`` must have ``at_least`` characters. A match
    begins where its group ``start`` does, if the pattern has one.

    ``needs``: lower-case ASCII strings of which a text must hold one, or a match is
    impossible. ``run_of``: the text must hold ``at_least`` such characters in a row.
    Both only save work.
    """

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0
    needs: tuple[str, ...] = ()
    run_of: str = ""
    base: bool = False
    flags: int = re.ASCII


# --- Fixed values: the base rules ---------------------------------------------------

BASE_RULES = (
    SecretRule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        at_least=8,
        needs=("password", "passwd", "secret", "token", "api_key", "apikey"),
        base=True,
        flags=re.ASCII | re.IGNORECASE,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", at_least=16, needs=("akia",), base=True),
    SecretRule("hex", r"[0-9a-f]+", at_least=32, run_of="0123456789abcdef", base=True),
)

# --- End of fixed values ------------------------------------------------------------

MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", needs=("private key",)),
    SecretRule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    SecretRule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    # Both patterns look at a run of characters once, from its first one, and only go on to
    # their first possible start in it if what follows the run fits: linear on any text.
    SecretRule(
        "jwt",
        r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8})"
        r"(?:[A-Za-z0-9_]*+-)*?(?P<start>(?<!\w)eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)",
        needs=("eyj",),
    ),
    SecretRule(
        "url_login",
        r"(?<![a-z0-9+.-])(?=[a-z0-9+.-]++://)"
        r"(?:(?<!\w)(?=[a-z])|[a-z0-9]*+(?:[+.-]++[0-9][a-z0-9]*+)*+[+.-]++(?=[a-z]))"
        r"(?P<start>[a-z0-9+.-]++://[^\s/:@]++:[^\s/@]++@)",
        needs=("://",),
    ),
    SecretRule("bearer", r"\bBearer\x20+[A-Za-z0-9._~+/=-]{20,}", needs=("bearer",)),
)

RULES: tuple[SecretRule, ...] = (*BASE_RULES, *MORE_RULES)


def rule_version(rules: Sequence[SecretRule]) -> str:
    """Changes whenever a rule does, so that old scans are not reused for new rules."""
    import hashlib

    return hashlib.sha256(repr([vars(r) for r in rules]).encode()).hexdigest()[:16]


class Scanner:
    """Compiled rules."""

    def __init__(self, rules: Sequence[SecretRule]):
        self.rules = [
            (
                r,
                re.compile(r.pattern, r.flags),
                [n.encode() for n in r.needs],
                bytes(0x78 if chr(b) in r.run_of else 0x20 for b in range(256)) if r.run_of else b"",
                b"x" * r.at_least,
            )
            for r in rules
        ]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in code points, sorted."""
        lowered = data.lower()
        text = None
        found = []
        for number, (rule, pattern, needs, table, run) in enumerate(self.rules):
            if needs and not any(n in lowered for n in needs):
                continue
            if table and run not in data.translate(table):
                continue
            if text is None:
                text = data.decode()
            for match in pattern.finditer(text):
                if len(match[rule.group]) >= rule.at_least:
                    begin = match.start("start" if "start" in pattern.groupindex else 0)
                    found.append((begin, number, match.end()))
        return sorted(found)


FINDINGS = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def find(blobs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """(blob, findings) of (blob, text) rows."""
    schema = pa.schema(
        [
            pa.field("blob", pa.string()),
            pa.field(
                "findings",
                pa.list_(
                    pa.struct(
                        [
                            pa.field("kind", pa.string()),
                            pa.field("start", pa.int64()),
                            pa.field("end", pa.int64()),
                            pa.field("base", pa.bool_()),
                        ]
                    )
                ),
            ),
        ]
    )
    rules = tuple(rules)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                findings = []
                for text in part.column("text"):
                    findings.append(
                        [
                            {
                                "kind": rules[number].kind,
                                "start": start,
                                "end": end,
                                "base": rules[number].base,
                            }
                            for start, number, end in scanner.spans(text.as_buffer().to_pybytes())
                        ]
                    )
                yield table_batch(schema, {"blob": part.column("blob"), "findings": findings})

    return blobs.select("blob", "text").mapInArrow(run, f"blob string, findings {FINDINGS}")


LEDGER = f"blob string, findings {FINDINGS}"


def ledger_of(path: str, version: str) -> str:
    """Folder of one rule version: a run reads the entries of its own rules alone."""
    return f"{path.rstrip('/')}/rules={version}"


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger folder ``path``; created empty if nothing has been written there yet."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def scan(
    docs: DataFrame,
    ledger_path: str | None = None,
    rules: Sequence[SecretRule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, blob, findings) of every row; findings are sorted by start, then rule.

    Scans only blobs without an entry for this rule version and appends them to the
    ledger; without a path a new ledger is begun in the scratch folder. One row per
    input row: repeated rows and equal texts share a blob, an empty or NULL text is the
    blob of the empty string, and a NULL id is kept.
    """
    spark = docs.sparkSession
    whole = ledger_path or scratch_path(spark, "secret-ledger")
    path = ledger_of(whole, rule_version(rules))
    addressed = texts(docs, id_col, text_col).withColumn("blob", F.sha2("text", 256))
    known = open_ledger(spark, path)

    # One row stands for each unseen blob. A blob all of whose rows lack an id is looked
    # up by its address alone.
    unseen = (
        addressed.groupBy("blob")
        .agg(F.min("doc_id").alias("doc_id"))
        .join(known.select("blob"), "blob", "left_anti")
    )
    with_id = addressed.where("doc_id IS NOT NULL").join(
        unseen.where("doc_id IS NOT NULL"), ["doc_id", "blob"], "left_semi"
    )
    without_id = addressed.where("doc_id IS NULL").join(
        unseen.where("doc_id IS NULL").select("blob"), "blob", "left_semi"
    )
    scanned = find(with_id.unionByName(without_id), rules).dropDuplicates(["blob"])
    scanned.select("blob", "findings").write.option("compression", "zstd").mode("append").parquet(path)

    # Stored, so that the join sees its true size and can split hot addresses.
    hits = stored(
        spark.read.schema(LEDGER)
        .parquet(path)
        .where(F.size("findings") > 0)
        .dropDuplicates(["blob"])
        .select("blob", "findings"),
        "secret-hits",
    )
    nothing = F.array().cast(FINDINGS)
    return (
        addressed.select("doc_id", "blob")
        .join(hits, "blob", "left")
        .select("doc_id", "blob", F.coalesce("findings", nothing).alias("findings"))
    )


def listed(findings: Column) -> Column:
    """``kind:start:end`` of each finding, comma-joined."""
    return F.array_join(
        F.transform(
            findings,
            lambda f: F.concat_ws(
                ":", f["kind"], f["start"].cast("string"), f["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, findings: Column) -> Column:
    """The text with every found span replaced by ``[kind]``, overlaps merged.

    Findings are sorted by start; a span that begins inside the one before it only
    prolongs the cut.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(state: Column, f: Column) -> Column:
        kept = F.when(
            f["start"] >= state["at"],
            F.concat(
                state["out"],
                F.substring(text, (state["at"] + 1).cast("int"), (f["start"] - state["at"]).cast("int")),
                F.lit("["),
                f["kind"],
                F.lit("]"),
            ),
        ).otherwise(state["out"])
        return F.struct(kept.alias("out"), F.greatest(state["at"], f["end"]).alias("at"))

    def finish(state: Column) -> Column:
        rest = F.char_length(text).cast("long") - state["at"]
        return F.concat(
            state["out"],
            F.substring(text, (state["at"] + 1).cast("int"), F.greatest(rest, F.lit(0)).cast("int")),
        )

    return F.when(F.size(findings) == 0, text).otherwise(
        F.aggregate(findings, start, cut, finish)
    )
