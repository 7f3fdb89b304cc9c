"""License scans with a generalised suffix automaton over the words of licence templates.

The automaton holds every run of words of every template and phrase. A text is streamed through it word
by word; at each word the state and length give the longest run of template words that ends there (the
matching statistics). Phrases that end at a place are read off the state. Runs of at least ``MIN_RUN``
words are located in the templates that hold no longer one, and chained: in one template, in order, with gaps of at most
``MAX_GAP`` words. A chain that covers ``MIN_COVER`` of its template is a span of that licence.

Defined results: null and empty text have no words, places or labels and score 0. Long texts are
streamed whole. Base places of all phrases count, overlapping ones too. Repeated rows repeat their
result; an empty table gives an empty table. Only the id and the results come back, so extra columns
cannot clash.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
MIN_RUN, MAX_GAP, MIN_COVER = 4, 12, 0.6

#: Base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Sentences and whole texts of public licences, as (label, text). A label may have several.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
]

FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label string, first_word int, last_word int, covered double>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER_TO_LOWER))


class Automaton:
    """All runs of words of the sequences; each state knows one place (sequence, end) per sequence it occurs in."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[dict[int, int]] = [{}]  # by state: the first end in each sequence
        for n, words in enumerate(sequences):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, w, ends)
                ends[last].setdefault(n, at)
        for v in sorted(range(1, len(self.link)), key=lambda v: -self.length[v]):
            if above := self.link[v]:
                for n, at in ends[v].items():
                    ends[above][n] = min(at, ends[above].get(n, at))
        self.ends = [sorted(x.items()) for x in ends]

    def _state(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append({})
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: str, ends: list) -> int:
        """The state for the runs of q that are one word longer than p's; q keeps the longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, ends)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: str, ends: list) -> int:
        if w in self.next[last]:
            return self._split(last, self.next[last][w], w, ends)
        new = self._state(self.length[last] + 1, ends)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        self.link[new] = 0 if p < 0 else self._split(p, self.next[p][w], w, ends)
        return new

    def statistics(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) for every place at which a run of template words ends."""
        next_, link, length_of = self.next, self.link, self.length
        start = next_[0]
        state = length = 0
        for at, w in enumerate(words):
            if not state and w not in start:
                continue
            while state and w not in next_[state]:
                state = link[state]
                length = length_of[state]
            if w in next_[state]:
                state = next_[state][w]
                length += 1
                yield at, state, length
            else:
                length = 0


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES):
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        self.templates = [(words_of(t), label) for label, t in templates]
        self.automaton = Automaton([p for p, _ in self.phrases] + [t for t, _ in self.templates])
        n, a = len(self.phrases), self.automaton
        #: By state: (words, label) of the phrases that are suffixes of its runs, those of its links included.
        self.phrase_at: list[list[tuple[int, str]]] = [[] for _ in a.link]
        for v in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            own = [(len(p), self.phrases[k][1]) for k, end in a.ends[v] if k < n and end == len(p := self.phrases[k][0]) - 1 and a.length[v] == len(p)]
            self.phrase_at[v] = own + self.phrase_at[a.link[v]]
        self.template_at = [[(k - n, end) for k, end in ends if k >= n] for ends in a.ends]
        self.held_by = [frozenset(k for k, _ in places) for places in self.template_at]

    def chains(self, runs: list[tuple[int, int, int, frozenset]]) -> list[tuple[str, int, int, float]]:
        """Spans from maximal runs (last word in the text, state, length, the templates that hold no longer one), in order of the text."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for at, state, length, longest_for in runs:
            for k, end in self.template_at[state]:
                if k in longest_for:
                    by.setdefault(k, []).append((at - length + 1, end - length + 1, length))
        out = []
        for k, found in by.items():
            words, label = self.templates[k]
            best: list[tuple[int, int, int, int, int]] = []  # covered, first, last, next word of the template, next of the text
            for first, there, length in found:
                covered, start = length, first
                for done, began, _, t, d in reversed(best):
                    if first - d > MAX_GAP:
                        break
                    if t <= there <= t + MAX_GAP and d <= first and done + length > covered:
                        covered, start = done + length, began
                best.append((covered, start, first + length - 1, there + length, first + length))
            top: list[tuple[int, int, int]] = []
            for covered, start, last, _, _ in best:
                if covered >= MIN_COVER * len(words):
                    if top and start <= top[-1][1]:
                        if covered > top[-1][2]:
                            top[-1] = (start, last, covered)
                    else:
                        top.append((start, last, covered))
            out += [(label, s, e, c / len(words)) for s, e, c in top]
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        places: list[int] = []
        base: set[str] = set()
        runs: list[tuple[int, int, int, frozenset]] = []
        before = (-2, 0, 0)
        min_run = min([MIN_RUN, *(len(t) for t, _ in self.templates)])

        def ended(longer: int | None) -> None:
            """The run before, for the templates that don't hold the longer one of this state too."""
            held = self.held_by[before[1]]
            if held and (longer is None or held != self.held_by[longer]):
                runs.append((*before, held if longer is None else held - self.held_by[longer]))

        for at, state, length in self.automaton.statistics(words):
            for size, label in self.phrase_at[state]:
                if length >= size:
                    places.append(at - size + 1)
                    base.add(label)
            if before[2] >= min_run:
                ended(state if at == before[0] + 1 and length == before[2] + 1 else None)
            before = (at, state, length)
        if before[2] >= min_run:
            ended(None)
        spans = self.chains(runs) if runs else []
        labels = base | {s[0] for s in spans}
        score = 1.0 if places else min(1.0, max((s[3] for s in spans), default=0.0))
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def scan_column(text: Column, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> Column:
    """A struct column with FIELDS. phrases: label by phrase; templates: (label, text)."""
    key = ("licenses", uuid.uuid4().hex)
    names = [c.split()[0] for c in FIELDS.split(", spans")[0].split(", ")] + ["spans"]

    @F.pandas_udf(FIELDS)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scan = held_by_worker(key, lambda: Scanner(phrases, templates)).scan
        for texts in batches:
            out = pd.DataFrame([scan(t) for t in texts], columns=names)
            for c in ("first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            out["spans"] = [[dict(zip(("label", "first_word", "last_word", "covered"), s, strict=True)) for s in x] for x in out["spans"]]
            yield out

    return scanned(text)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document: the id, FIELDS among them the spans."""
    return docs.select(F.col(id_col), scan_column(F.col(text_col), phrases, templates).alias("_scan")).select(id_col, "_scan.*")
