"""Decontamination of edited passages against a plain BM25 over all items."""

from __future__ import annotations

import random
from collections import Counter
from math import ceil, log, log2

import pytest

from touchtrail.llm import decontaminate as d
from touchtrail.llm.license_scan import words_of


def plain_leaks(docs, items, s):
    """Every passage against every item, by the formulas alone."""
    kept = [(i, words_of(t.encode()), len(t.encode())) for i, t in items if words_of(t.encode())]
    n, average = len(kept), sum(len(w) for _, w, _ in kept) / len(kept)
    seen = Counter(w for _, words, _ in kept for w in set(words))
    length_class = {i: max(9, ceil(log2(max(size, 1)))) for i, _, size in kept}
    longest = {}
    for i, words, _ in kept:
        longest[length_class[i]] = max(longest.get(length_class[i], 0), len(words))
    found = {}
    for doc_id, text in docs:
        all_words = words_of(text.encode())
        for i, words, _ in kept:
            norm = d.K1 * (1 - d.B + d.B * len(words) / average)
            impact = {
                w: log(1 + (n - seen[w] + 0.5) / (seen[w] + 0.5)) * c * (d.K1 + 1) / (c + norm)
                for w, c in Counter(words).items()
            }
            cut = len(words) - max(1, int(len(words) * s.answer_share))
            parts = [d.triples(words[:cut] or words, s.triple), d.triples(words[cut:], s.triple)]
            stride = longest[length_class[i]]
            for start in range(0, max(1, len(all_words) - stride), stride):
                passage = all_words[start : start + 2 * stride]
                score = sum(v for w, v in impact.items() if w in set(passage)) / sum(impact.values())
                there = d.triples(passage, s.triple)
                shares = [
                    sum(t in there or (len(t) < s.triple and set(t) <= set(passage)) for t in p) / len(p)
                    for p in parts
                ]
                if score >= s.threshold and min(shares) >= s.overlap:
                    found[doc_id, i] = max(found.get((doc_id, i), 0.0), score)
    return found


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(23)
    vocabulary = [f"w{i}" for i in range(90)] + [f"rare{i}" for i in range(300)]

    def words(n):
        return [rng.choice(vocabulary[:90]) if rng.random() < 0.6 else rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(words(rng.choice([4, 12, 30, 60, 200])))) for i in range(40)]
    items += [(40, items[3][1]), (41, "w1 w2"), (42, "w5")]
    docs = []
    for k in range(60):
        item = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, max(2, len(item) // 2))):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["changed"], [item[at], "added"]])
            item = item or ["left"]
        docs.append((k, " ".join(words(rng.randrange(0, 90)) + item + words(rng.randrange(0, 300)))))
    return docs, items


@pytest.mark.parametrize("shard, passed", [(8 << 20, 16 << 20), (1500, 16 << 20), (700, 2000), (300, 300)])
def test_edited_items_are_found_however_the_index_is_cut(spark, planted, monkeypatch, shard, passed):
    docs, items = planted
    monkeypatch.setattr(d, "SHARD_BYTES", shard)
    monkeypatch.setattr(d, "PASS_BYTES", passed)
    expected = plain_leaks(docs, items, d.Settings())
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in d.leaks(table, benchmark).collect()}
    assert set(found) == set(expected) and len(found) > 30
    # The best passage of ours may be one of two with other overlaps: never a better score.
    assert all(found[k] <= expected[k] + 1e-9 for k in found)


def test_a_small_benchmark_takes_one_pass():
    sizes = [(9, 400_000, 1), (10, 500_000, 1), (14, 20 << 20, 3)]
    passes = list(d._passes(sizes))
    assert passes[0] == [(9, 0, 1), (10, 0, 1), (14, 0, 3), (14, 1, 3)]
    assert passes[1:] == [[(14, 2, 3)]]
