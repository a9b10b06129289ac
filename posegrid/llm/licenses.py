"""Operator 13: licence scan by template markup.

A template is the wording of a licence or of a notice. ``[[ ... ]]`` encloses wording that may be absent, ``{a | b}``
a place that holds one of several wordings, and ``{3..40}`` a place for so many words of anybody's. ``Automaton``
compiles a template to states over words: each state has its words and the states they lead to, free places lead on
by any word, and absent regions are skipped without a word. A text is accepted where all mandatory words stand one
after the other, with nothing between them but what the regions allow; the longest such place counts.

Words are runs of letters, digits and characters beyond ASCII, in lower case (A-Z only), so punctuation and layout
never matter. All automata run together over a text from each place where one of their opening words stands; they
stop at the first word that fits no state, so a text costs little more than cutting it into words. Besides, fixed
phrases are looked up with their places.

A text needs no other text: the scan is one map over the documents without a shuffle, in Arrow batches, and a task
holds one batch of texts.

Results for odd inputs: a null or empty text has no words, no places, empty labels and score 0; very long texts are
scanned whole; repeated rows give repeated results; of equal labels one is listed, and of places that start alike
the longest of each template counts; an empty table gives an empty table; columns of the input that are called like
a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from posegrid.llm.common import without

#: bytes of UTF-8: A-Z in lower case, blanks for what is no letter or digit of ASCII and not beyond it
AS_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

# Phrases that are places of a licence by themselves, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Wording of public licences and of their notices, with markup for what may vary.
_AS_IS = """provided {by the copyright holders and contributors | by the copyright holder and contributors |
 by the copyright holders | by the author | by the author and contributors | by the regents and contributors} as is
 and any express or implied warranties including but not limited to the implied warranties of merchantability and
 fitness for a particular purpose are disclaimed in no event shall {the copyright holder or contributors |
 the copyright owner or contributors | the copyright holders or contributors | the copyright holder | the author |
 the author or contributors | the regents or contributors} be liable for any direct indirect incidental special
 exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of
 use data or profits or business interruption however caused and on any theory of liability whether in contract strict
 liability or tort including negligence or otherwise arising in any way out of the use of this software even if
 advised of the possibility of such damage"""
_BSD_2 = """redistribution and use in source and binary forms with or without modification are permitted provided that
 the following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of
 conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright
 notice this list of conditions and the following disclaimer in the documentation and or other materials provided
 with the distribution"""
TEMPLATES = {
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and
 associated documentation files the software to deal in the software without restriction including without
 limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and
 to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright
 notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial
 portions of the software the software is provided as is without warranty of any kind express or implied including
 but not limited to the warranties of merchantability fitness for a particular purpose and {noninfringement |
 non infringement} in no event shall {the authors or copyright holders | the author or copyright holder | {2..30}} be
 liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out
 of or in connection with the software or the use or other dealings in the software""",
    "mit-notice": """{released | licensed | distributed | available | published} under [[the terms of]] the mit
 {license | licence}""",
    "isc-text": """permission to use copy modify and {or | and or} distribute this software for any purpose with or
 without fee is hereby granted provided that the above copyright notice and this permission notice appear in all
 copies [[the software is provided as is and {1..12} disclaims all warranties with regard to this software including
 all implied warranties of merchantability and fitness]]""",
    "bsd-2-text": f"{_BSD_2} this software is {_AS_IS}",
    "bsd-3-text": f"""{_BSD_2} [[3]] neither the name of {{1..30}} nor the names of {{its | their | 0..3}} contributors may
 be used to endorse or promote products derived from this software without specific prior written permission this
 software is {_AS_IS}""",
    "apache-2-notice": """licensed under the apache license version 2 0 [[the license you may not use this file except in
 compliance with the license you may obtain a copy of the license at {http | https} www apache org licenses license
 2 0 [[unless required by applicable law or agreed to in writing software distributed under the license is distributed
 on an as is basis without warranties or conditions of any kind either express or implied see the license for the
 specific language governing permissions and limitations under the license]]]]""",
    "gpl-2-notice": """{this work is | this program is | this file is | this library is} [[free software you
 can redistribute it and or modify it]] {licensed under | distributed under | released under | under} [[the terms of]] the
 gnu general public {license | licence} [[as published by the free software foundation]] [[either]] version 2 [[of the
 license]] [[or at your option any later version]]""",
    "gpl-3-notice": """{this work is | this program is | this file is | this library is} [[free software you can
 redistribute it and or modify it]] {licensed under | distributed under | released under | under} [[the terms of]] the gnu
 general public {license | licence} [[as published by the free software foundation]] [[either]] version 3 [[of the
 license]] [[or at your option any later version]]""",
    "cc-notice": """{licensed under | released under | distributed under | available under} [[the terms of]] [[a | the]]
 {cc | creative commons} {by | attribution} [[{nc | noncommercial | non commercial | sa | sharealike | share alike |
 nd | noderivatives | no derivatives}]] [[{sa | sharealike | share alike | nd | noderivatives | no derivatives}]] {1 0 |
 2 0 | 2 5 | 3 0 | 4 0} [[international | unported | generic]] [[license | licence]]""",
}


# ------------------------------------------------------------------ markup

MARK = re.compile(r"\[\[|\]\]|[{}|]|\d+\.\.\d+|[^\s\[\]{}|]+")


@dataclass
class Automaton:
    """States over words. ``by_word[s]`` and ``by_any[s]`` are where a state leads by a word, ``free[s]`` where without one."""

    by_word: list[dict[bytes, set[int]]] = field(default_factory=list)
    by_any: list[set[int]] = field(default_factory=list)
    free: list[set[int]] = field(default_factory=list)
    #: label of an accepting state
    accepts: dict[int, str] = field(default_factory=dict)

    def state(self) -> int:
        self.by_word.append({})
        self.by_any.append(set())
        self.free.append(set())
        return len(self.free) - 1

    def add(self, label: str, markup: str) -> int:
        """The first state of a template."""
        marks = MARK.findall(markup)
        begin = self.state()
        end, at = self._choices(begin, marks, 0, "")
        if at < len(marks):
            raise ValueError(f"{label}: {marks[at]!r} closes nothing")
        if end in self.closure({begin}):
            raise ValueError(f"{label}: no word is mandatory")
        if self.by_any_of(self.closure({begin})):
            raise ValueError(f"{label}: begins with a place for any word")
        self.accepts[end] = label
        return begin

    def _choices(self, begin: int, marks: list[str], at: int, close: str) -> tuple[int, int]:
        """Wordings separated by | up to ``close``: the state after them and the place of the next mark."""
        end = self.state()
        here = begin
        while at < len(marks) and marks[at] not in ("}", "]]"):
            mark = marks[at]
            at += 1
            if mark == "|":
                self.free[here].add(end)
                here = begin
            elif mark == "[[":
                after, at = self._choices(here, marks, at, "]]")
                self.free[here].add(after)
                here = after
            elif mark == "{":
                start = self.state()
                self.free[here].add(start)
                here, at = self._choices(start, marks, at, "}")
            elif ".." in mark:
                least, most = map(int, mark.split(".."))
                chain = [here] + [self.state() for _ in range(most)]
                after = self.state()
                for k in range(most + 1):
                    if k < most:
                        self.by_any[chain[k]].add(chain[k + 1])
                    if k >= least:
                        self.free[chain[k]].add(after)
                here = after
            else:
                after = self.state()
                self.by_word[here].setdefault(mark.lower().encode(), set()).add(after)
                here = after
        self.free[here].add(end)
        if close:
            if at == len(marks) or marks[at] != close:
                raise ValueError(f"{close} is missing")
            at += 1
        return end, at

    def closure(self, states: set[int]) -> frozenset[int]:
        found, open_ = set(states), list(states)
        while open_:
            for s in self.free[open_.pop()]:
                if s not in found:
                    found.add(s)
                    open_.append(s)
        return frozenset(found)

    def by_any_of(self, states: frozenset[int]) -> bool:
        return any(self.by_any[s] for s in states)


class Scanner:
    """All templates and phrases, run over texts. Sets of states become one state each when they are first met."""

    #: met sets of states are forgotten beyond this
    MOST = 50_000

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.automaton = Automaton()
        starts = {self.automaton.add(label, markup) for label, markup in templates.items()}
        self.vocabulary = {w for words in self.automaton.by_word for w in words}
        self.start = self.automaton.closure(starts)
        self.steps: dict[tuple[frozenset[int], bytes], tuple[frozenset[int], tuple[str, ...]]] = {}
        opening = sorted({w for s in self.start for w in self.automaton.by_word[s]})
        # words of the text stand between single blanks
        self.openings = re.compile(b" (?:" + b"|".join(map(re.escape, opening)) + b")(?= )") if opening else None
        self.phrases = [(f" {p} ".encode(), label, p.count(" ") + 1) for p, label in phrases.items()]

    def step(self, states: frozenset[int], word: bytes) -> tuple[frozenset[int], tuple[str, ...]]:
        """Where a set of states leads by a word, and the labels accepted there."""
        key = (states, word if word in self.vocabulary else b"")
        known = self.steps.get(key)
        if known is None:
            a = self.automaton
            after: set[int] = set()
            for s in states:
                after |= a.by_word[s].get(word, set()) | a.by_any[s]
            reached = a.closure(after)
            known = reached, tuple(sorted({a.accepts[s] for s in reached if s in a.accepts}))
            if len(self.steps) >= self.MOST:
                self.steps.clear()
            self.steps[key] = known
        return known

    def templates_in(self, spaced: bytes) -> list[tuple[str, int, int]]:
        """(label, first word, word after the last) of every accepted place in `` word word ... ``."""
        if self.openings is None:
            return []
        found = []
        word = at = 0
        for match in self.openings.finditer(spaced):
            word += spaced.count(b" ", at, match.start())
            at = match.start()
            longest: dict[str, int] = {}
            states, begin, n = self.start, at + 1, word
            while states and begin < len(spaced):
                end = spaced.index(b" ", begin)
                states, labels = self.step(states, spaced[begin:end])
                n += 1
                for label in labels:
                    longest[label] = n
                begin = end + 1
            found += [(label, word, n) for label, n in longest.items()]
        return found

    def phrases_in(self, spaced: bytes) -> list[tuple[str, int, int]]:
        found = []
        for phrase, label, size in self.phrases:
            at = spaced.find(phrase)
            while at >= 0:
                word = spaced.count(b" ", 0, at)
                found.append((label, word, word + size))
                at = spaced.find(phrase, at + 1)
        return found


def spaced_words(text: bytes | None) -> bytes:
    """The words of a text in UTF-8, each between single blanks; empty without words."""
    words = (text or b"").translate(AS_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b""


def covered(places: Sequence[tuple[str, int, int]]) -> int:
    """Words that stand in some place."""
    total = upto = 0
    for _, begin, end in sorted(places, key=lambda p: p[1:]):
        total += max(0, end - max(begin, upto))
        upto = max(upto, end)
    return total


RESULTS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "places", "score"]


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None) -> DataFrame:
    """``docs`` without the text, with the number of words, the places of the phrases (how many, first and last start),
    their labels, all labels, the accepted places of templates (``label, start, end``, words from 0, end exclusive)
    and the share of words that stand in any place."""
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    Scanner(templates, phrases)  # wrong markup is reported here
    kept = without(docs.withColumn("__text", docs[text]), *RESULTS, text)
    others = [c for c in kept.columns if c != "__text"]
    place = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            rows = []
            for value in batch.column("__text").cast(pa.binary()):
                spaced = spaced_words(value.as_py())
                base, more = scanner.phrases_in(spaced), scanner.templates_in(spaced)
                words = max(0, spaced.count(b" ") - 1)
                starts = [p[1] for p in base]
                labels = {p[0] for p in base}
                rows.append((words, len(base), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(labels)), ",".join(sorted(labels | {p[0] for p in more})),
                             [{"label": a, "start": b, "end": c} for a, b, c in sorted(more, key=lambda p: (p[1], p[0]))],
                             covered(base + more) / words if words else 0.0))
            columns = list(zip(*rows)) if rows else [()] * len(RESULTS)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(place), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(v, k) for v, k in zip(columns, kinds)], names=others + RESULTS)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "__text")
    schema += ", " * bool(others) + ("n_words long, n_base long, first_word long, last_word long, base_labels string, "
                                     "labels string, places array<struct<label: string, start: long, end: long>>, score double")
    return kept.mapInArrow(scanned, schema)
