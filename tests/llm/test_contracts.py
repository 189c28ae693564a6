"""Every operator against a brute-force reading of what it should return."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from touchtrail.llm import (
    block_anchors,
    decontaminate,
    interpolation_lm,
    license_scan,
    packing,
    quality_rules,
    secret_ledger,
    simhash,
    suffix_lpf,
    token_counts,
)
from touchtrail.llm.queries import packing_tokenizer, tokenizer_file

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def pairs(docs):
    """(id, text) of all rows, NULL texts as empty ones."""
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def sorted_rows(rows):
    return sorted(rows, key=repr)


@pytest.fixture(params=["corpus", "untidy"])
def docs(request):
    return request.getfixturevalue(request.param)


# -- 1 ----------------------------------------------------------------------------------


def fingerprint_of(text: str) -> int:
    from xxhash import xxh64_intdigest

    words = WORD.findall(text.encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [b" ".join(words)]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints: list[tuple]) -> list[tuple]:
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(distinct):
        for q in distinct[i + 1 :]:
            if (p ^ q).bit_count() <= 3:
                root[find(p)] = find(q)
    smallest = defaultdict(list)
    for doc_id, p in prints:
        if doc_id is not None:
            smallest[find(p)].append(doc_id)
    return [(d, p, min(smallest[find(p)], default=None)) for d, p in prints]


def test_simhash(docs):
    found = [
        (r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"])
        for r in simhash.near_duplicates(docs).collect()
    ]
    expected = components_of([(d, fingerprint_of(t)) for d, t in pairs(docs)])
    assert sorted_rows(found) == sorted_rows(expected)


# -- 2 ----------------------------------------------------------------------------------


def test_license_scan(docs):
    found = [
        (r["doc_id"], r["n_words"], sorted((p["start"], p["label"]) for p in r["places"]), r["base_labels"])
        for r in license_scan.scan(docs).collect()
    ]
    expected = []
    for doc_id, text in pairs(docs):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.encode().lower())
        places = [
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.encode().split()
        ]
        expected.append((doc_id, len(words), sorted(places), sorted({x for _, x in places})))
    assert sorted_rows(found) == sorted_rows(expected)
    assert any(p for _, _, p, _ in found)


# -- 3 ----------------------------------------------------------------------------------


def test_suffix_lpf(docs):
    rows = [(d, t.encode()) for d, t in pairs(docs)]
    earliest: dict[bytes, float] = {}
    for doc_id, data in rows:
        order = math.inf if doc_id is None else doc_id
        for i in range(len(data) - 49):
            window = data[i : i + 50]
            earliest[window] = min(order, earliest.get(window, math.inf))
    expected = []
    for doc_id, data in rows:
        order = math.inf if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if earliest[data[i : i + 50]] < order:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        expected.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    result = suffix_lpf.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    assert sorted_rows(map(tuple, result.collect())) == sorted_rows(expected)
    assert sum(e[2] for e in expected) > 1000


# -- 4 ----------------------------------------------------------------------------------

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)


def base_secrets(text: str) -> list[tuple]:
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(spans)]


def test_secrets(docs):
    found = [
        (r["doc_id"], [(f["kind"], f["start"], f["end"]) for f in r["findings"] if f["base"]])
        for r in secret_ledger.scan(docs).collect()
    ]
    expected = [(d, base_secrets(t)) for d, t in pairs(docs)]
    assert sorted_rows(found) == sorted_rows(expected)
    assert {k for _, spans in found for k, _, _ in spans} == {"assign", "access", "hex"}


# -- 5 ----------------------------------------------------------------------------------


def test_token_counts(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = pairs(docs)
    encoded = tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False)
    expected = [
        (d, len(t.encode()), len(e.ids), len(e.ids) > 2048) for (d, t), e in zip(rows, encoded)
    ]
    found = token_counts.count_tokens(docs, tokenizer_file("word_bpe_49k.json"))
    assert sorted_rows(map(tuple, found.collect())) == sorted_rows(expected)


# -- 6 ----------------------------------------------------------------------------------


def test_interpolation_lm(docs):
    rows = [(d, t.encode().lower().split()) for d, t in pairs(docs)]

    def fold(doc_id):
        return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10

    counts: Counter = Counter()
    for doc_id, words in rows:
        if fold(doc_id):
            counts.update([*words, None])
    total, types = sum(counts.values()), len(counts)
    expected = []
    for doc_id, words in rows:
        tokens = [*words, None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        known = sum(counts[w] > 0 for w in tokens)
        expected.append((doc_id, fold(doc_id) == 0, len(tokens), known, total, round(base, 5)))
    scored = interpolation_lm.score(docs).collect()
    found = [
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))
        for r in scored
    ]
    assert sorted_rows(found) == sorted_rows(expected)
    assert all(r["score"] < 0 for r in scored)
    learned = [r for r in scored if not r["held_out"]]
    assert sum(r["score"] for r in learned) > sum(r["base_score"] for r in learned)


# -- 7 ----------------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(docs, capacity):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    rows = packing.pack(docs, packing_tokenizer(), capacity=capacity).collect()
    expected = []
    for doc_id, text in pairs(docs):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        start, piece = 0, 0
        while start < len(ids):
            length = (len(ids) - start - 1) % capacity + 1
            expected.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            start, piece = start + length, piece + 1
    assert sorted_rows(tuple(r)[:5] for r in rows) == sorted_rows(expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    # Pieces of a third or more aside, best fit leaves at most the last sequence half empty.
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // capacity) * 11 / 9 + 1


# -- 8 ----------------------------------------------------------------------------------


def test_quality_rules(docs):
    expected = []
    for doc_id, text in pairs(docs):
        words = [w.decode() for w in WORD.findall(text.encode())]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x.encode())]
        expected.append(
            (
                doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                len(lines) - len(set(lines)), len(covered),
            )
        )
    rows = quality_rules.apply_rules(docs).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted_rows(tuple(r[n] for n in names) for r in rows) == sorted_rows(expected)
    for r in rows:
        if r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]:
            assert not r["kept"]
    assert any(r["kept"] for r in rows)


# -- 9 ----------------------------------------------------------------------------------


def test_decontamination(docs, benchmark):
    items = {
        i: b" ".join(license_scan.words_of((t or "").encode()))
        for i, t in benchmark.collect()
    }
    expected = [
        (d, i)
        for d, t in pairs(docs)
        for i, words in items.items()
        if words and words in b" ".join(license_scan.words_of(t.encode()))
    ]
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()]
    assert sorted_rows(found) == sorted_rows(expected)
    assert len(found) >= 4


# -- 10 ---------------------------------------------------------------------------------


def test_block_anchors(docs):
    rows = [(d, t.encode().split()) for d, t in pairs(docs)]
    counts = Counter(
        tuple(w[i : i + 35]) for _, w in rows for i in range(len(w) - 34)
    )
    expected = []
    for doc_id, words in rows:
        gone = [False] * len(words)
        for i in range(len(words) - 34):
            if counts[tuple(words[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        expected.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    result = block_anchors.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted_rows(map(tuple, result.collect())) == sorted_rows(expected)
    assert sum(e[2] for e in expected) > 500


# -- empty tables -----------------------------------------------------------------------


def test_empty_tables(nothing, benchmark, corpus):
    empty_items = benchmark.limit(0)
    results = [
        simhash.near_duplicates(nothing),
        license_scan.scan(nothing),
        suffix_lpf.remove_repeats(nothing),
        secret_ledger.scan(nothing),
        token_counts.count_tokens(nothing, tokenizer_file("word_bpe_49k.json")),
        interpolation_lm.score(nothing),
        packing.pack(nothing, packing_tokenizer()),
        quality_rules.apply_rules(nothing),
        decontaminate.leaks(nothing, benchmark),
        decontaminate.leaks(corpus, empty_items),
        block_anchors.remove_repeats(nothing),
        simhash.similar_groups(nothing),
    ]
    assert [r.count() for r in results] == [0] * len(results)
