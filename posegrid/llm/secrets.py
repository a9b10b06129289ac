"""Operator 4: secret scan.

Three fixed patterns find assigned secrets, access keys and long hexadecimal strings. Besides, every
candidate string (a long run of key characters) is scanned by a window that slides over the runs of one
character class; the window's Shannon entropy is kept by incremental counts, so a step costs the two
characters that leave and enter. Windows over the class's threshold are merged into spans unless the
allow-list knows the string. Whole texts are scanned; a text is one row and needs no other row, so the
scan is one map over the documents without a shuffle.

Results for odd inputs: a null or empty text has no spans; very long texts are scanned whole; of spans that begin
alike the kinds come in the order of ``KINDS``; repeated rows give repeated results; an empty table gives an empty table; a column of the input that is called like a result column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import without

# The patterns of the three base kinds and their least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: kinds in the order in which spans of one start are listed
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharClass:
    """Characters of one class, the window over their runs and the entropy (bits) from which it counts."""

    name: str
    chars: str
    window: int
    bits: float
    #: a window must hold a digit and a letter; words of prose do not
    mixed: bool = True


#: 32 random hex digits have 3.6 bits on average, 24 random base64 characters 4.2, prose words below 3.6
CLASSES = (
    CharClass("hex", r"0-9a-fA-F", 32, 3.0),
    CharClass("base64", r"A-Za-z0-9+/_\-", 24, 3.8),
)
#: strings that look random but are none: identifiers, alphabets, samples, numbers, words
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r".*(?:EXAMPLE|example|0123456789|abcdefghij|ABCDEFGHIJ).*",
    r"[0-9_\-+/=]+",
    r"[A-Za-z]+(?:[/_\-][A-Za-z]+)*",
)
#: a sample word that is a segment by itself, as in a path, says nothing about the other segments of its run
SEGMENT = r"(?<![A-Za-z0-9])(?:EXAMPLE|example|0123456789|abcdefghij|ABCDEFGHIJ)(?![A-Za-z0-9])"
#: what names a string as a digest when it stands right before it
DIGEST_NAME = r"(?:sha-?(?:1|224|256|384|512)|md5)[:=_-]\Z"
CANDIDATE = r"[A-Za-z0-9+/_=\-]{24,}"


def window_spans(run: str, window: int, bits: float, mixed: bool) -> Iterator[tuple[int, int]]:
    """Merged spans of all windows of ``run`` whose Shannon entropy is at least ``bits``.

    ``total`` is the sum of n*log2(n) over the character counts of the window; the entropy is
    log2(window) - total/window, so one step changes the terms of two characters only.
    """
    if len(run) < window:
        return
    term = [0.0] + [n * log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    digits = letters = 0
    total = 0.0
    begin = end = -1
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= window:
            gone = run[i - window]
            n = counts[gone]
            counts[gone] = n - 1
            total += term[n - 1] - term[n]
            digits -= gone.isdigit()
            letters -= gone.isalpha()
        if i + 1 < window or (mixed and not (digits and letters)) \
                or log2(window) - total / window < bits - 1e-9:
            continue
        at = i + 1 - window
        if at > end:
            if end >= 0:
                yield begin, end
            begin = at
        end = i + 1
    if end >= 0:
        yield begin, end


class Scanner:
    """Finds the spans of one text; holds compiled patterns only."""

    def __init__(self, classes: Sequence[CharClass], allow: Sequence[str], exact: frozenset[str],
                 candidate: str):
        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])
        self.candidate = re.compile(candidate)
        self.allow = re.compile("|".join(f"(?:{a})" for a in allow)) if allow else None
        self.segment = re.compile(SEGMENT)
        self.digest_name = re.compile(DIGEST_NAME, re.IGNORECASE)
        self.exact = exact
        self.classes = [(c, re.compile(f"[{c.chars}]{{{c.window},}}")) for c in classes]

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, place in KINDS, end) of the base kinds. A run shorter than a kind's least length fails
        as a whole, so the hex pattern may ask for that length at once; ``assign`` may not, because a match
        that fails still uses up its characters."""
        found = [(m.start(), 0, m.end()) for m in self.assign.finditer(text)
                 if m.end(2) - m.start(2) >= LEAST["assign"]]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text)
                      if m.end() - m.start() >= LEAST["access"]]
        return found + [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]

    def entropy(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans by entropy, less what base spans and wider spans of another class cover."""
        found: list[tuple[int, int, int]] = []
        for m in self.candidate.finditer(text):
            string, shift = m.group(), m.start()
            if string in self.exact or (self.allow and self.allow.fullmatch(self.segment.sub("", string))) \
                    or self.digest_name.search(text[max(0, shift - 8):shift]):
                continue
            spans = [(shift + r.start() + b, shift + r.start() + e)
                     for c, pattern in self.classes for r in pattern.finditer(string)
                     for b, e in window_spans(r.group(), c.window, c.bits, c.mixed)]
            taken = [(b, e) for b, _, e in base if b < m.end() and e > m.start()]
            for b, e in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
                rest = []
                for x, y in sorted(taken):
                    if b < x and b < e:
                        rest.append((b, min(x, e)))
                    b = max(b, y)
                if b < e:
                    rest.append((b, e))
                taken += rest
                found += [(x, 3, y) for x, y in rest]
        return found

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        base = self.base(text)
        return [f"{KINDS[k]}:{b}:{e}" for b, k, e in sorted(base + self.entropy(text, base))]


def spans(text: Column | str, classes: Sequence[CharClass] = CLASSES, allow: Sequence[str] = ALLOW,
          allow_strings: Sequence[str] = (), candidate: str = CANDIDATE) -> Column:
    """Array of ``kind:start:end`` of a text column, by start, then by the order of ``KINDS``.

    Positions are code points, the end exclusive. ``allow`` (patterns of whole candidate strings) and
    ``allow_strings`` suppress spans found by entropy, never those of the base patterns.
    """
    exact = frozenset(allow_strings)

    @F.pandas_udf("array<string>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(classes, allow, exact, candidate)
        for texts in batches:
            yield pd.Series([scanner(t) for t in texts], dtype=object)

    return scan(F.col(text) if isinstance(text, str) else text)


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", **options) -> DataFrame:
    """``docs`` with ``out``: array of struct(kind, start, end) of all secrets of the whole text."""
    kept = without(docs, out)
    part = lambda s, i: F.element_at(F.split(s, ":"), i)
    raw = kept.withColumn(out, spans(F.col(text), **options))
    return raw.withColumn(out, F.transform(F.col(out), lambda s: F.struct(
        part(s, 1).alias("kind"), part(s, 2).cast("int").alias("start"), part(s, 3).cast("int").alias("end"))))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mark``; overlapping spans become one mark."""
    def covered(found: Column, whole: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

        def step(state: Column, s: Column) -> Column:
            fresh = F.substring(whole, state["at"] + 1, s["start"] - state["at"])
            return F.when(s["end"] <= state["at"], state).otherwise(F.struct(
                s["end"].alias("at"),
                F.when(s["start"] >= state["at"], F.concat(state["done"], fresh, F.lit(mark)))
                .otherwise(state["done"]).alias("done")))

        return F.aggregate(found, start, step, lambda s: F.concat(
            s["done"], F.substring(whole, s["at"] + 1, F.length(whole))))

    found = find_secrets(docs, text, "__secrets", **options)
    whole = F.col(text)
    return found.withColumn(text, F.when(F.size("__secrets") > 0, covered(F.col("__secrets"), whole))
                            .otherwise(whole)).drop("__secrets").select(*docs.columns)
