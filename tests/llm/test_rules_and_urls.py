import re
from math import comb

import pytest
from pyspark.sql import functions as F

from posegrid.llm import risk_rules, urls
from posegrid.llm.queries import URL_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(words) < 5000 else None
    if often is None:
        seen, often = set(), set()
        for w in windows:
            (often if w in seen else seen).add(w)
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered))


def test_measures_of_odd_texts(odd, nothing):
    got = risk_rules.measures(odd).collect()
    want = sorted((r["doc_id"] or 0, *counts(r["text"])) for r in odd.collect())
    assert sorted((r["doc_id"] or 0, r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                   r["n_repeat_words"]) for r in got) == want
    assert risk_rules.measures(nothing).count() == 0


def test_repeated_windows_by_brute_force(spark):
    import random
    random.seed(4)
    texts = [" ".join(random.choice("ab c*".split() + ["d\n", "\t"]) for _ in range(random.randint(0, 40)))
             for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in risk_rules.measures(docs).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == \
            counts(texts[r["doc_id"]])


@pytest.mark.parametrize("n,share,level", [(0, 0.05, 0.1), (10, 0.1, 0.01), (400, 0.02, 0.01), (3000, 0.01, 0.002)])
def test_exact_binomial_bound(spark, n, share, level):
    tail, most = 0.0, -1
    for k in range(int(n * share) + 1):
        tail += comb(n, k) * share**k * (1 - share) ** (n - k)
        if tail <= level:
            most = k
    got = spark.range(1).select(risk_rules.most_rejected(F.lit(n).cast("long"), share, F.lit(level)).alias("k"))
    assert got.first()["k"] == most


def test_thresholds_keep_the_risk_and_catch_the_bad(spark):
    clean = "alpha beta gamma delta {} epsilon zeta eta theta {} iota kappa lambda mu {} nu xi omicron pi {} rho"
    rows, marks = [], []
    for i in range(2400):
        body = " ".join(clean.format(i, i + 1, i + 2, i + 3) + f" {i * 7} {j}" for j in range(4))
        bad = i % 6 == 0
        rows.append((i, body.replace(" ", "*** ") if bad else body, "en" if i % 3 else "de"))
        marks.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in risk_rules.judge(docs, labels, risk=0.2).collect()}
    assert all(got[i]["kept"] == bool(q) for i, q in marks if not got[i]["base_failed"])
    # too few labels prove nothing: the method keeps all
    few = risk_rules.judge(docs, labels.where("doc_id < 40"), risk=0.2)
    assert few.where("not base_failed and not kept").count() == 0


def test_rules_on_odd_rows(odd, nothing, labels):
    got = risk_rules.judge(odd, labels)
    assert got.count() == odd.count()
    assert got.where("doc_id in (2, 3, 4) and not (base_failed and not kept)").count() == 0
    assert risk_rules.judge(nothing, labels).count() == 0
    assert risk_rules.judge(odd, labels.where("false")).count() == odd.count()


def judged(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = max(((len(h), len(p), h + p, v) for h, p, v in URL_RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return (host, path, best and best[2], best[3] if best else "allow")


def test_urls_by_brute_force(spark):
    found = [None, "", "x", "://", "http://", "http://ORG/", "http://example.org", "https://A.Example.ORG/es/1?x#y",
             "http://example.org/en/17", "http://example.org/en/27", "http://notexample.org/es/", "http://org/es/",
             "http://b.com/de/", "http://b.com/fr/x", "http://b.com/d", "http://com?/de/", "http://com#/de/",
             "ftp://u:p@h.com:80/de/q", "http://a..org/", "http://.org/", "http://é.COM/de/", "http://x.org/" + "p" * 9000,
             "http://" + "a." * 3000 + "org/es/", "http://a.com/de/http://b.org/"]
    pages = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(found * 2)],
                                  "page_id long, url string, verdict string, Host string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = urls.judge(pages, rules).collect()
    assert len(got) == len(found) * 2
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(found[r["page_id"] % len(found)])
    assert urls.judge(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_longer_rules_and_contradictions(spark):
    rules = spark.createDataFrame([("a.b.com", "/", "allow"), ("b.com", "/long/path/", "block"), ("b.com", "/x", "allow"),
                                   ("b.com", "/x", "block"), (None, "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b.com/long/path/1"), (2, "http://c.b.com/long/path/"),
                                   (3, "http://b.com/xy")], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got == {1: ("a.b.com/", "allow"), 2: ("b.com/long/path/", "block"), 3: ("b.com/x", "block")}
