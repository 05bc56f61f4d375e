"""Licence notices in texts, by a generalised suffix automaton of the words of templates.

The automaton of all templates has a state for each set of places at which a run of words
stands in them. A text is streamed through it: after each word it knows the longest run,
ending there, that any template has (the matching statistics). Whenever a place of a
template cannot go on with the next word, its run is complete; runs of LONG words and more
are anchors (place in the text, place in the template, length). Anchors of a template that follow
each other in both, at most GAP words apart, are chained; a chain that covers COVER of the
template's words is a span of it. Phrases are templates that must be there whole.

Templates are a parameter, so the automaton has a bounded size; each task builds its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of an anchor, words between two anchors of a chain, share of a template that a span covers.
LONG, GAP, COVER = 4, 12, 0.8

# Phrases, and the label each stands for.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)

# The wording of common notices, and the label of each.
TEMPLATES = (
    ("mit", "Released under the MIT license."),
    ("mit", "Licensed under the MIT license."),
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program.""",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_WORDS = bytes(c if c >= 128 or c in _KEPT else 32 for c in _LOWER)

Notice = tuple[str, int, int, float]


def words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: letters and digits, and all beyond ASCII; A-Z in lower case."""
    return text.translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton of sequences of numbers."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for n, sequence in enumerate(sequences):
            last = 0
            for end, word in enumerate(sequence, 1):
                last = self._extended(last, word, ends)
                ends[last].add((n, end))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        #: Places (sequence, end) at which the runs of a state stand.
        self.ends = ends
        self._lost: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

    def _state(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int, ends: list) -> int:
        """A state for the runs of ``q`` that end after ``p``; ``q`` keeps the longer ones."""
        clone = self._state(self.length[p] + 1, ends)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extended(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word, ends)
        new = self._state(self.length[last] + 1, ends)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word, ends)
        return new

    def lost(self, state: int, word: int) -> list[tuple[int, int, int]]:
        """(sequence, end, longest run) for the places of a state that do not go on with ``word``.

        The places of its own have the run at hand, those of its shorter runs (its links) at most that state's."""
        if (state, word) not in self._lost:
            found, seen, s = [], set(), state
            while s > 0:
                goes_on = self.ends[self.next[s][word]] if word in self.next[s] else ()
                found += [(n, end, self.length[s]) for n, end in self.ends[s] - seen if (n, end + 1) not in goes_on]
                seen |= self.ends[s]
                s = self.link[s]
            self._lost[state, word] = found
        return self._lost[state, word]

    def complete_runs(self, sequence: Sequence[int], least: Sequence[int]) -> Iterator[tuple[int, int, int, int]]:
        """(sequence, end there, end in the text, length) of the runs that go on neither to the left nor to the right.

        ``least`` has the shortest length that counts, for each sequence of the automaton."""
        state = length = 0
        for end, word in enumerate([*sequence, -1]):
            if state:
                for n, there, most in self.lost(state, word):
                    if min(most, length) >= least[n]:
                        yield n, there, end, min(most, length)
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1


def chains(anchors: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """(first word, end, words covered) of the best chains of anchors (end there, end in the text, length) that share none.

    A chain covers the words of its template that its anchors have, each once."""
    anchors = sorted(anchors, key=lambda a: (a[1] - a[2], a[0] - a[2], a))
    best, back = [], []
    for j, (there, end, length) in enumerate(anchors):
        cover, before = length, -1
        for i in range(j - 1, -1, -1):
            t, e, n = anchors[i]
            if e - n < end - length - GAP - size:
                break
            if e - n < end - length <= e + GAP and t - n < there - length <= t + GAP and e < end and t < there:
                if best[i] + min(length, end - e, there - t) > cover:
                    cover, before = best[i] + min(length, end - e, there - t), i
        best.append(cover)
        back.append(before)
    used, found = set(), []
    for j in sorted(range(len(anchors)), key=lambda j: (-best[j], j)):
        i, first, tail = j, None, 0
        while i >= 0 and i not in used:
            used.add(i)
            first = anchors[i][1] - anchors[i][2]
            i = back[i]
        if i >= 0:
            tail = best[i]  # what comes before belongs to a better chain
        if first is not None and best[j] > tail:
            found.append((first, anchors[j][1], best[j] - tail))
    return found


def _apart(notices: list[Notice]) -> list[Notice]:
    """Of the notices of a label that overlap, the longest, then the one with the best share, then the first."""
    kept: list[Notice] = []
    for one in sorted(notices, key=lambda x: (x[1] - x[2], -x[3], x[1], x[0])):
        if all(one[0] != x[0] or one[2] <= x[1] or x[2] <= one[1] for x in kept):
            kept.append(one)
    return sorted(kept, key=lambda x: (x[1], x[0]))


class Finder:
    """The templates, and the search in a text."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.ids: dict[bytes, int] = {}
        self.labels, sequences = [], []
        for label, text in [*phrases, *templates]:
            self.labels.append(label)
            sequences.append([self.ids.setdefault(w, len(self.ids)) for w in words(text.encode())])
        self.n_phrases, self.sizes = len(phrases), [len(s) for s in sequences]
        self.least = [n if i < self.n_phrases else min(n, LONG) for i, n in enumerate(self.sizes)]
        self.automaton = Automaton(sequences)
        v = len(self.ids) + 1
        self.pairs = np.zeros((v, v), bool)  # the last is any other word
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True
        self.alone = [s[0] for s in sequences if len(s) == 1]

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[Notice], float]:
        """Number of words, phrases (first word, phrase), notices (label, first word, end, share), best share."""
        own = words(text)
        ids = np.fromiter((self.ids.get(w, -1) for w in own), np.int32, len(own))
        # A run of two words and more lies where all pairs of neighbours are pairs of some template.
        linked = np.flatnonzero(self.pairs[ids[:-1], ids[1:]])
        breaks = np.flatnonzero(np.diff(linked) > 1)
        firsts, ends = linked[np.append(0, breaks + 1)] if len(linked) else linked, linked[np.append(breaks, -1)] + 2 if len(linked) else linked
        stretches = list(zip(firsts.tolist(), ends.tolist()))
        if self.alone:
            inside = np.zeros(len(own) + 1, bool)
            for a, b in stretches:
                inside[a:b] = True
            stretches += [(i, i + 1) for i in np.flatnonzero(np.isin(ids, self.alone) & ~inside[:-1]).tolist()]
        anchors: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        phrases = []
        for a, b in stretches:
            for n, there, end, length in self.automaton.complete_runs(ids[a:b].tolist(), self.least):
                if n < self.n_phrases:
                    phrases.append((a + end - length, n))
                else:
                    anchors[n].append((there, a + end, length))
        notices, score = [], 1.0 if phrases else 0.0
        for n, own_anchors in anchors.items():
            for first, end, covered in chains(own_anchors, self.sizes[n]):
                share = covered / self.sizes[n]
                score = max(score, share)
                if share >= COVER:
                    notices.append((self.labels[n], first, end, share))
        return len(own), sorted(phrases), _apart(notices), score


SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans string"
)


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row for each document: doc_id, the places of the phrases, the labels of both kinds, the best share and the spans.

    ``spans`` has label:first word:end of each span by its place, comma-joined; an empty
    string where there is none. Null and empty texts have no words and score 0. Repeated
    rows have a row each, an empty table none; other columns are not read. Equal phrases
    or templates with several labels count for each. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(phrases, templates)
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for text in batch.column(1):
                n, places, notices, score = finder.find(text.as_py())
                base = {finder.labels[p] for _, p in places}
                row = (
                    n,
                    len(places),
                    places[0][0] if places else None,
                    places[-1][0] if places else None,
                    ",".join(sorted(base)),
                    ",".join(sorted(base | {x[0] for x in notices})),
                    score,
                    ",".join(f"{label}:{first}:{end}" for label, first, end, _ in notices),
                )
                for column, value in zip(columns, row):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")]])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {SCHEMA}")
