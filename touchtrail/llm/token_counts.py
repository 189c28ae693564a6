"""Token counts with a whole-token shortcut.

Offline, once per call: every vocabulary string that the tokenizer encodes, alone, as
one token is proved to be a *whole token*. While counting, a pre-token found in that
set counts one without any merging; only the others go through the merges, each
distinct one once per batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, table_batch, texts

# Fixed value: the pre-token pattern of the tokenizer file.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END_OF_WORD = "</w>"

# Chunks of printable Latin-1 without a special string: normalising them is lower-casing,
# and the pattern means the same in every engine. Others are left to the tokenizer.
PLAIN = re.compile(r"[\x21-\x7e\xa1-\xff]+")
MAYBE_SPECIAL = "<|"

# Remembered counts per worker; beyond this many the store starts again.
REMEMBERED = 1_000_000


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that alone encode as exactly one token.

    Every candidate is encoded by the tokenizer itself, so the set is proved, not
    guessed. Its size is bounded by the vocabulary.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters = {c: chr(b) for b, c in _byte_letters().items()}
    candidates = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        if token.endswith(END_OF_WORD):
            spelled = token.removesuffix(END_OF_WORD)
            try:
                text = "".join(letters[c] for c in spelled).encode("latin-1").decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if PLAIN.fullmatch(text):
                candidates.append(text)
    encoded = tokenizer.encode_batch_fast(candidates, add_special_tokens=False)
    return frozenset(t for t, e in zip(candidates, encoded) if len(e.ids) == 1)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _tools(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import regex
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), regex.compile(PRE_TOKEN), {}, {}


def _learn(chunks: set[bytes], path: str, whole: frozenset[str], known: dict, merged: dict) -> None:
    """Token counts of new white-space-separated chunks, added to ``known``."""
    tokenizer, pattern, _, _ = _tools(path)
    pieces: dict[bytes, list[str]] = {}
    foreign: list[bytes] = []
    unmerged: set[str] = set()
    for chunk in chunks:
        text = chunk.decode()
        if not PLAIN.fullmatch(text) or MAYBE_SPECIAL in text:
            foreign.append(chunk)
            continue
        text = text.lower()
        if text in whole and text.isalpha():
            known[chunk] = 1
            continue
        found = pattern.findall(text)
        rest = [p for p in found if p not in whole]
        known[chunk] = len(found) - len(rest)
        if rest:
            pieces[chunk] = rest
            unmerged.update(p for p in rest if p not in merged)
    for texts_, counts in ((list(unmerged), merged), ([c.decode() for c in foreign], None)):
        encoded = tokenizer.encode_batch_fast(texts_, add_special_tokens=False) if texts_ else []
        sizes = [len(e.ids) for e in encoded]
        if counts is None:
            known.update(zip(foreign, sizes))
        else:
            counts.update(zip(texts_, sizes))
    for chunk, rest in pieces.items():
        known[chunk] += sum(merged[p] for p in rest)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    ``path`` names the tokenizer file, which every executor must have. Special strings
    inside texts count as the tokenizer's default counts them; none are added. One row
    per input row; an empty or NULL text has 0 tokens. No shuffle.
    """
    source = texts(docs, id_col, text_col)
    whole = whole_tokens(path)
    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("n_bytes", pa.int64()),
            pa.field("n_tokens", pa.int64()),
        ]
    )

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        _, _, known, merged = _tools(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, totals = [], []
                split = []
                for text in part.column("text"):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    sizes.append(len(data))
                    split.append(data.split())
                if len(known) > REMEMBERED:
                    known.clear()
                if len(merged) > REMEMBERED:
                    merged.clear()
                new = set().union(*split).difference(known)
                if new:
                    _learn(new, path, whole, known, merged)
                totals = [sum(map(known.__getitem__, chunk)) for chunk in split]
                yield table_batch(
                    schema,
                    {"doc_id": part.column("doc_id"), "n_bytes": sizes, "n_tokens": totals},
                )

    return (
        source.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
