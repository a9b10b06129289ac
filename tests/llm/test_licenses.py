import random
import re

import pytest
import regex

from posegrid.llm import licenses
from posegrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def as_regex(markup):
    """A regular expression over `` word word ``: an own reading of the markup."""
    out = ""
    for mark in re.findall(r"\[\[|\]\]|[{}|]|\d+\.\.\d+|[^\s\[\]{}|]+", markup):
        if mark in ("[[", "{"):
            out += "(?:"
        elif mark == "|":
            out += "|"
        elif mark in ("]]", "}"):
            out += ")" + "?" * (mark == "]]")
        elif ".." in mark:
            low, high = mark.split("..")
            out += f"(?: [^ ]+){{{low},{high}}}"
        else:
            out += f"(?: {regex.escape(mark.lower())}(?![^ ]))"
    return out


def by_hand(text, templates, phrases):
    words = words_of(text)
    base = [(label, i, i + len(p.split())) for p, label in phrases.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    more = []
    for label, markup in templates.items():
        whole = regex.compile(f"(?p)(?:{as_regex(markup)})(?= )")
        for i in range(len(words)):
            rest = "".join(f" {w}" for w in words[i:i + 700]) + " "
            found = whole.match(rest)
            if found:
                more.append((label, i, i + found.group().count(" ")))
    starts = [b for _, b, _ in base]
    labels = {p[0] for p in base}
    inside = {k for _, b, e in base + more for k in range(b, e)}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {p[0] for p in more})), sorted(more, key=lambda p: (p[1], p[0])),
            len(inside) / len(words) if words else 0.0)


def rows(frame):
    return [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"],
             [tuple(p) for p in r["places"]], r["score"]) for r in frame.orderBy("doc_id").collect()]


def one(markup, rng):
    """Some text that a template accepts."""
    marks = re.findall(r"\[\[|\]\]|[{}|]|\d+\.\.\d+|[^\s\[\]{}|]+", markup)

    def some(at, close):
        choices, now = [], []
        while at < len(marks) and marks[at] not in ("}", "]]"):
            mark, at = marks[at], at + 1
            if mark == "|":
                choices.append(now)
                now = []
            elif mark in ("[[", "{"):
                inner, at = some(at, "]]" if mark == "[[" else "}")
                now = now + (inner if mark == "{" or rng.random() < 0.5 else [])
            elif ".." in mark:
                low, high = map(int, mark.split(".."))
                now = now + [rng.choice(["Jane", "Doe", "ACME", "the", "is", "é"]) for _ in range(rng.randint(low, high))]
            else:
                now = now + [mark]
        return rng.choice(choices + [now]), at + (close is not None)

    return some(0, None)[0]


def test_templates_against_regular_expressions(spark):
    rng = random.Random(5)
    texts = []
    for markup in licenses.TEMPLATES.values():
        for _ in range(6):
            words = one(markup, rng)
            texts.append("Intro. " + ", ".join(w.upper() if rng.random() < 0.3 else w for w in words) + ";\n\nthe end")
            k = rng.randrange(len(words))
            texts.append(" ".join(words[:k] + words[k + 1:]))  # a word is missing
            texts.append(" ".join(words[:k] + ["zebra"] + words[k:]))  # a word too many
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert rows(licenses.scan(docs)) == [by_hand(t, licenses.TEMPLATES, licenses.PHRASES) for t in texts]
    accepted = [r for i, r in enumerate(rows(licenses.scan(docs))) if i % 3 == 0]
    for k, label in enumerate(licenses.TEMPLATES):
        assert all(label in r[5].split(",") for r in accepted[6 * k:6 * k + 6])


def test_random_markup(spark):
    rng = random.Random(8)
    templates = {"t1": "a {b | c [[d]] | 0..2} e", "t2": "b [[c | d e]] {1..3} a", "t3": "c [[{a | b} [[c]]]] [[d]]",
                 "t4": "a a", "t5": "e {0..3} e [[e]]"}
    phrases = {"a b": "p1", "b": "p2", "c c": "p2"}
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert rows(licenses.scan(docs, templates=templates, phrases=phrases)) == [by_hand(t, templates, phrases) for t in texts]


@pytest.mark.parametrize("markup", ["", "[[a]]", "a ]]", "{a | b", "{1..3} a", "[[a", "{0..2} [[b]]"])
def test_wrong_markup(spark, odd, markup):
    with pytest.raises(ValueError):
        licenses.scan(odd, templates={"t": markup})


def test_odd_rows(spark, odd, nothing):
    out = licenses.scan(odd.drop("ids"))
    assert [c for c in out.columns if c not in licenses.RESULTS] == [c for c in odd.columns if c not in ("text", "score", "ids")]
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["labels"], r["score"]) for r in out.collect()))
    assert got == sorted((r["doc_id"] or 0, len(words_of(r["text"])), "", 0.0) for r in odd.collect())
    assert licenses.scan(nothing).count() == 0
    tail = "word " * 300_000 + "Released under the MIT License."
    late = licenses.scan(spark.createDataFrame([(1, tail), (1, tail)], "doc_id long, text string")).collect()
    assert [(r["first_word"], r["labels"], r["n_words"]) for r in late] == [(300_001, "mit,mit-notice", 300_005)] * 2
    only = licenses.scan(spark.createDataFrame([("cc by nc",)], "text string")).first()
    assert only["score"] == 1.0 and only["labels"] == "cc-by-nc"


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in QUERIES["op13_license_scan"](spark, sf_dir).collect()}
    assert len(got) == docs.count()
    named = 0
    for r in docs.collect():
        words = words_of(r["text"])
        text = " " + " ".join(words) + " "
        base = sorted(text.count(" ", 0, m.start()) for p in licenses.PHRASES for m in re.finditer(f"(?= {p} )", text))
        row = got[r["doc_id"]]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (
            len(words), len(base), base[0] if base else None, base[-1] if base else None)
        named += bool(row["labels"])
    assert named > 10
