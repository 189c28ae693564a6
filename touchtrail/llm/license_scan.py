"""Licence scan with a generalised suffix automaton over template tokens.

The tokens of all templates (licence texts and short phrases) form one suffix
automaton. Each document is streamed through it: after every token the state and the
length of the longest run of tokens that is a substring of some template are known
(matching statistics). Long matches are chained, in order, into the span of template
they cover; a licence whose template is covered enough is reported beside the phrases
that stand in the text word for word.

The automaton is built on the driver from the templates alone: its size is at most
twice their tokens, whatever the corpus. Documents are independent, so there is no
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import Batches, table_batch, texts

# --- Fixed values: phrases, labels and licence texts -----------------------------

PHRASES: dict[str, str] = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

TEMPLATES: dict[str, str] = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software.""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code
        must retain the above copyright notice, this list of conditions and the following
        disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "cc-by-nc": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
        International License. To view a copy of this license, visit
        http://creativecommons.org/licenses/by-nc/4.0/""",
}

# --- End of fixed values ----------------------------------------------------------

# Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


@dataclass
class Automaton:
    """Generalised suffix automaton; states are numbered, 0 is the root."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    # Places (template, end) of prefixes of templates; a state's substrings stand at its own
    # and at those of all states whose suffix links lead to it.
    own: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])
    # Phrases that are suffixes of a state's substrings: (words, phrase number).
    phrases: list[tuple[tuple[int, int], ...]] = field(default_factory=list)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.step) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """The part of state q reached from p by one token, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(token) == q:
            self.step[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        q = self.step[last].get(token)
        if q is not None:  # this run of tokens is known from an earlier template
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, token)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.step[p]:
            self.step[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][token]
            whole = self.length[q] == self.length[p] + 1
            self.link[new] = q if whole else self._split(p, q, token)
        return new

    def add(self, template: int, tokens: list[int]) -> None:
        last = 0
        for end, token in enumerate(tokens):
            last = self._extend(last, token)
            self.own[last].append((template, end))

    def mark(self, phrases: list[list[int]]) -> None:
        """Note, at every state, the phrases that its substrings end with."""
        own: dict[int, list[tuple[int, int]]] = {}
        for number, tokens in enumerate(phrases):
            state = 0
            for token in tokens:
                state = self.step[state][token]
            own.setdefault(state, []).append((len(tokens), number))
        found: list[tuple[tuple[int, int], ...] | None] = [None] * len(self.step)
        found[0] = ()
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            found[state] = found[self.link[state]] + tuple(own.get(state, ()))
        self.phrases = found


    def places(self, shortest: int) -> list[dict[int, list[int]]]:
        """Ends in each template of the substrings of every state of ``shortest`` tokens or more."""
        found: list[dict[int, list[int]]] = [{} for _ in self.step]
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            if self.length[state] < shortest:
                break
            for template, end in self.own[state]:
                found[state].setdefault(template, []).append(end)
            for template, ends in found[state].items():
                found[self.link[state]].setdefault(template, []).extend(ends)
        return found

    def suffixes(self, shortest: int) -> list[dict[int, int]]:
        """For every state and template the state of the longest suffix that stands in it."""
        places = self.places(shortest)
        found: list[dict[int, int]] = [{} for _ in self.step]
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            if self.length[state] >= shortest:
                found[state] = found[self.link[state]] | dict.fromkeys(places[state], state)
        return found


@dataclass(frozen=True)
class Matcher:
    """What the executors need: vocabulary, automaton, and labels."""

    vocabulary: dict[bytes, int]
    automaton: Automaton
    phrase_labels: tuple[str, ...]
    labels: tuple[str, ...]  # by template; phrases come after the licence texts
    sizes: tuple[int, ...]
    n_texts: int
    shortest_run: int
    places: list[dict[int, list[int]]]
    suffixes: list[dict[int, int]]


def build(
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    min_match: int = 5,
) -> Matcher:
    vocabulary: dict[bytes, int] = {}

    def coded(text: str) -> list[int]:
        return [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text.encode())]

    licence_tokens = [coded(t) for t in templates.values()]
    phrase_tokens = [coded(p) for p in phrases]
    automaton = Automaton()
    for number, tokens in enumerate([*licence_tokens, *phrase_tokens]):
        automaton.add(number, tokens)
    automaton.mark(phrase_tokens)
    return Matcher(
        vocabulary,
        automaton,
        tuple(phrases.values()),
        (*templates, *phrases.values()),
        tuple(len(t) for t in [*licence_tokens, *phrase_tokens]),
        len(licence_tokens),
        min((len(t) for t in phrase_tokens), default=2),
        automaton.places(min_match),
        automaton.suffixes(min_match),
    )


def _chained(matches: list[tuple[int, int, int]], gap: int, reach: int) -> int:
    """Template tokens covered by the best chain of matches.

    A match is (document start, template start, tokens), sorted by document start. In
    a chain both starts grow and at most ``gap`` document tokens lie between two
    matches. No match is longer than ``reach``, so the search back is bounded too.
    """
    best = 0
    covered: list[int] = []
    for i, (at, start, size) in enumerate(matches):
        value = size
        for j in range(i - 1, -1, -1):
            before, begun, n = matches[j]
            if at - before > gap + reach:
                break
            if at - (before + n) > gap:
                continue
            new = size - max(0, begun + n - start)
            if before < at and begun < start and new > 0:
                value = max(value, covered[j] + new)
        covered.append(value)
        best = max(best, value)
    return best


def scan_words(words: list[bytes], m: Matcher, min_match: int, gap: int) -> tuple:
    """(phrase places as (start, phrase), coverage by licence) of one document."""
    known = np.fromiter(map(m.vocabulary.get, words, [-1] * len(words)), np.int32, len(words))
    inside = np.concatenate(([False], known >= 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    places: list[tuple[int, int]] = []
    long_matches: dict[int, list[tuple[int, int, int]]] = {}
    a = m.automaton
    shortest = min(m.shortest_run, min_match)
    runs = edges.reshape(-1, 2)
    for begin, end in runs[runs[:, 1] - runs[:, 0] >= shortest].tolist():
        state, length = 0, 0
        open_: dict[int, tuple[int, int]] = {}  # by template: state and length of its match
        for at, token in enumerate(known[begin:end].tolist(), begin):
            while state and token not in a.step[state]:
                state = a.link[state]
                length = a.length[state]
            if token in a.step[state]:
                state = a.step[state][token]
                length += 1
            else:
                length = 0
            here: dict[int, tuple[int, int]] = {}
            if length >= min_match:
                for template, suffix in m.suffixes[state].items():
                    size = length if suffix == state else a.length[suffix]
                    if size >= min_match:
                        here[template] = suffix, size
            # A template's match is over where it does not grow by this token.
            for template, match in open_.items():
                if here.get(template, (0, 0))[1] <= match[1]:
                    _note(long_matches, m, template, match, at)
            open_ = here
            for size, number in a.phrases[state]:
                if size <= length:
                    places.append((at + 1 - size, number))
        for template, match in open_.items():
            _note(long_matches, m, template, match, end)
    coverage: dict[str, float] = {}
    for template, matches in long_matches.items():
        if template < m.n_texts:
            share = _chained(sorted(matches), gap, m.sizes[template]) / m.sizes[template]
            label = m.labels[template]
            coverage[label] = max(coverage.get(label, 0.0), min(1.0, share))
    return places, coverage


def _note(found: dict, m: Matcher, template: int, match: tuple[int, int], end: int) -> None:
    """A match that ended before document token ``end``, at every place of it in the template."""
    state, length = match
    for last in m.places[state][template]:
        found.setdefault(template, []).append((end - length, last + 1 - length, length))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    min_match: int = 5,
    gap: int = 12,
    covered: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licences of every document, one row per input row.

    ``places``: every (start word, label) of a phrase. ``base_labels``: labels of the
    phrases found; ``labels``: with the licences whose text is covered to at least
    ``covered`` by a chain of matches of ``min_match`` tokens or more with at most
    ``gap`` words between them. ``score``: 1 with a phrase, else the best coverage.
    An empty or NULL text has no words, no places, no labels and score 0.
    """
    matcher = build(phrases, templates, min_match)
    schema = pa.schema(
        [
            pa.field("doc_id", pa.int64()),
            pa.field("n_words", pa.int64()),
            pa.field(
                "places",
                pa.list_(pa.struct([pa.field("start", pa.int64()), pa.field("label", pa.string())])),
            ),
            pa.field("coverage", pa.map_(pa.string(), pa.float64())),
        ]
    )

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                sizes, places, coverages = [], [], []
                for text in part.column("text"):
                    words = words_of(text.as_buffer().to_pybytes())
                    found, coverage = scan_words(words, matcher, min_match, gap)
                    sizes.append(len(words))
                    places.append(
                        [{"start": s, "label": matcher.phrase_labels[n]} for s, n in sorted(found)]
                    )
                    coverages.append(list(coverage.items()))
                yield table_batch(
                    schema,
                    {
                        "doc_id": part.column("doc_id"),
                        "n_words": sizes,
                        "places": places,
                        "coverage": coverages,
                    },
                )

    scanned = (
        texts(docs, id_col, text_col)
        .select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(
            run,
            "doc_id long, n_words long, places array<struct<start: long, label: string>>, "
            "coverage map<string, double>",
        )
    )
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    whole = F.map_keys(F.map_filter("coverage", lambda _, share: share >= covered))
    best = F.coalesce(F.array_max(F.map_values("coverage")), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        "places",
        "coverage",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, whole)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
