"""Licence scans with a generalised suffix automaton of licence tokens.

All templates and phrases are put, word by word, into one suffix automaton. A
text streams through it and every word gets its matching statistic: the length
of the longest run of words ending there that occurs in any template, and the
automaton's state. Long matches that cannot be prolonged are chained per
template, in order on both sides and with bounded gaps; a chain that covers
enough of a template is a span and gives the template's label. A phrase stands
wherever the state's suffix path holds it.

Only runs of words whose neighbouring pairs all occur in some template are
streamed word by word; elsewhere the statistic is at most one word, so nothing
is lost. That test is one table look-up per word over the whole batch.

Null and empty texts have no words, no labels and score 0. Texts are scanned
whole, in chunks of bounded size. Rows are scanned one by one, so null or
repeated doc_ids and other columns make no difference.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, chunks, split_words, text_buffers, word_hashes

# Phrases and the labels they stand for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The notice of the GNU licences, and its variants.
GNU_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0}General Public License for more details."
GNU_VARIANTS = [
    ("gpl-2.0-or-later", "", "2"),
    ("gpl-3.0-or-later", "", "3"),
    ("lgpl-2.1-or-later", "Lesser ", "2.1"),
    ("lgpl-3.0-or-later", "Lesser ", "3"),
    ("agpl-3.0-or-later", "Affero ", "3"),
]

# Notices as their licences give them, and SPDX identifiers.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    *((label, GNU_NOTICE.format(name, version)) for label, name, version in GNU_VARIANTS),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("mit", "Released under the MIT License"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

# Words that tell the variants of a notice apart: those that a
# span must hold, and those that it must not.
TELLS = {
    "apache-2.0": ("2", ""),
    "gpl-2.0": ("2", "3 lesser library affero"),
    "gpl-3.0": ("3", "2 lesser library affero"),
    "gpl-2.0-or-later": ("2", "1 3 lesser library affero"),
    "gpl-3.0-or-later": ("3", "2 lesser library affero"),
    "lgpl-2.1-or-later": ("lesser 2 1", "3 affero"),
    "lgpl-3.0-or-later": ("lesser 3", "2 affero"),
    "agpl-3.0-or-later": ("affero 3", "2 lesser"),
    "cc-by-4.0": ("4", "sa nc nd sharealike noncommercial noderivatives"),
    "cc-by-sa-4.0": ("sa 4", "nc nd"),
    "cc-by-nc-4.0": ("nc 4", "sa nd"),
    "mpl-2.0": ("2", ""),
}

MIN_MATCH = 4
COVERAGE = 0.8
MAX_GAP = 8
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))


class Automaton:
    """A generalised suffix automaton over word numbers. ``places`` lists, per
    state, where its words end: (template, end)."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.templates = list(templates)
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        texts = [words_of(t) for _, t in templates] + [p for p, _ in self.phrases]
        self.lengths = [len(t) for t in texts]
        tells = {label: [t.split() for t in TELLS.get(label, ("", ""))] for label, _ in templates}
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for t in [*texts, *(t for two in tells.values() for t in two)] for w in t}))}
        self.tells = {label: tuple({self.vocabulary[w] for w in t} for t in two) for label, two in tells.items()}
        self.next, self.link, self.size = [{}], [-1], [0]
        ends: list[set] = [set()]
        for n, text in enumerate(texts):
            last = 0
            for at, word in enumerate(text):
                last = self._extend(last, self.vocabulary[word], ends)
                ends[last].add((n, at))
        for s in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        count = len(templates)
        self.places = [sorted(x for x in e if x[0] < count) for e in ends]
        self.found: list[tuple] = []  # per state: (length needed, phrase) of the phrases on its suffix path
        for s in range(len(self.size)):
            own = [(self.lengths[n], n - count) for n, at in ends[s] if n >= count and at == self.lengths[n] - 1 and self._holds(s, n)]
            self.found.append(tuple(own))
        for s in sorted(range(1, len(self.size)), key=lambda s: self.size[s]):
            if self.link[s] > 0:
                self.found[s] = tuple({*self.found[s], *self.found[self.link[s]]})
        v = len(self.vocabulary)
        self.pairs = np.zeros((v + 1, v + 1), bool)
        self.marks = np.zeros((v + 1, v + 1), bool)  # pairs that end a phrase
        for t in texts:
            for a, b in zip(t, t[1:]):
                self.pairs[self.vocabulary[a], self.vocabulary[b]] = True
        for p, _ in self.phrases:
            self.marks[self.vocabulary[p[-2]], self.vocabulary[p[-1]]] = True
        names = list(self.vocabulary)
        raw = np.frombuffer("\n".join(names).encode(), np.uint8)
        _, ws, we, _ = split_words(raw, np.array([0, len(raw)]))
        hashes = word_hashes(LOWER[raw], ws, we)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order

    def _holds(self, s: int, n: int) -> bool:
        """Whether the phrase n is among the state's words (not only their end)."""
        return self.size[self.link[s]] < self.lengths[n] <= self.size[s]

    def _extend(self, last: int, c: int, ends: list) -> int:
        nxt, link, size = self.next, self.link, self.size
        if c in nxt[last]:
            q = nxt[last][c]
            if size[q] == size[last] + 1:
                return q
            return self._clone(last, q, c, ends)
        cur = len(size)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        ends.append(set())
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if size[q] == size[p] + 1 else self._clone(p, q, c, ends)
        return cur

    def _clone(self, p: int, q: int, c: int, ends: list) -> int:
        nxt, link, size = self.next, self.link, self.size
        k = len(size)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        ends.append(set())
        link[q] = k
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def stream(self, words):
        """(state, length) after every word: its matching statistic."""
        nxt, link, size = self.next, self.link, self.size
        s = length = 0
        for c in words:
            to = nxt[s].get(c)
            while to is None and s:
                s = link[s]
                length = size[s]
                to = nxt[s].get(c)
            if to is None:
                length = 0
            else:
                s = to
                length += 1
            yield s, length

    def told(self, label: str, words) -> bool:
        """Whether the words of a span are those of this variant."""
        needs, bars = self.tells[label]
        return not (needs or bars) or (needs <= (held := set(words)) and not bars & held)

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; one past the last for words of no template."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], len(self.hashes))


def chain(matches: list[tuple[int, int, int]], max_gap: int, reach: int) -> list[tuple[int, int, int]]:
    """Chains (covered words, first, last text word) of the matches (text
    start, template start, length) of one template: each goes on from the best
    one before it that lies before it on both sides and within the gap;
    overlaps count once."""
    matches = sorted(set(matches))
    best: list[tuple[int, int]] = []  # covered, first word
    used = [False] * len(matches)
    for j, (x, y, n) in enumerate(matches):
        score, first, prev = n, x, -1
        for k in range(j - 1, -1, -1):
            a, b, m = matches[k]
            if x - a > reach + max_gap:
                break
            over = max(0, a + m - x, b + m - y)
            if a < x and b < y and over < n and x - (a + m) <= max_gap and y - (b + m) <= max_gap and best[k][0] + n - over > score:
                score, first, prev = best[k][0] + n - over, best[k][1], k
        best.append((score, first))
        if prev >= 0:
            used[prev] = True
    return [(best[j][0], best[j][1], matches[j][0] + matches[j][2] - 1) for j in range(len(matches)) if not used[j]]


def scan_text(words, auto: Automaton, base: int, hits: list, matches: dict, min_match: int) -> None:
    """Streams a run of words that begins at word ``base``."""
    before, state = 0, 0
    at = base
    for s, length in auto.stream(words):
        if before >= min_match and length != before + 1:
            _match(auto, state, before, at - 1, matches)
        for need, phrase in auto.found[s]:
            if need <= length:
                hits.append((at - need + 1, phrase))
        before, state, at = length, s, at + 1
    if before >= min_match:
        _match(auto, state, before, at - 1, matches)


def _match(auto, state, length, at, matches):
    for template, end in auto.places[state]:
        matches.setdefault(template, []).append((at - length + 1, end - length + 1, length))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, min_match: int = MIN_MATCH, coverage: float = COVERAGE, max_gap: int = MAX_GAP) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and spans (label, template, first, last, covered) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(templates, phrases))
    span = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches):
        auto = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                low, ws, we, first = split_words(*text_buffers(part.column(1)))
                number = auto.numbered(word_hashes(low, ws, we))
                text = np.repeat(np.arange(part.num_rows), np.diff(first))
                pair = np.zeros(len(number) + 1, bool)  # words k - 1 and k stand together in some template
                if len(number) > 1:
                    pair[1:-1] = auto.pairs[number[:-1], number[1:]] & (text[:-1] == text[1:])
                edge = np.diff(pair.astype(np.int8))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
                mark = np.zeros(len(number) + 1, np.int64)
                if len(number) > 1:
                    mark[2:] = np.cumsum(auto.marks[number[:-1], number[1:]] & pair[1:-1])
                use = (end - begin >= min_match) | (mark[end] > mark[begin + 1])
                found: dict[int, tuple[list, dict]] = {}
                for a, b in zip(begin[use].tolist(), end[use].tolist()):
                    t = int(text[a])
                    hits, matches = found.setdefault(t, ([], {}))
                    scan_text(number[a:b].tolist(), auto, a - int(first[t]), hits, matches, min_match)
                yield table(part, np.diff(first), [row(auto, number[first[i] : first[i + 1]], *found.get(i, ((), {}))) for i in range(part.num_rows)])

    def row(auto, words, hits, matches):
        spans, top = [], 1.0 if hits else 0.0
        for template, own in matches.items():
            size = auto.lengths[template]
            for covered, a, b in chain(own, max_gap, size):
                share = min(1.0, covered / size)
                top = max(top, share)
                if share >= coverage and auto.told(auto.templates[template][0], words[a : b + 1].tolist()):
                    spans.append({"label": auto.templates[template][0], "template": template, "first": a, "last": b, "covered": share})
        base = sorted({auto.phrases[p][1] for _, p in hits})
        at = [x for x, _ in hits]
        return len(hits), min(at, default=None), max(at, default=None), ",".join(base), ",".join(sorted({*base, *(s["label"] for s in spans)})), top, sorted(spans, key=lambda s: (s["first"], s["template"]))

    def table(part, words, rows):
        cols = [part.column(0), pa.array(words, pa.int64()), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds[2:]))]
        return pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, template: int, first: long, last: long, covered: double>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
