from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from posegrid.llm import line_templates as LT


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def kept(spark, texts, **options):
    got = LT.drop_templates(rows(spark, texts), **options).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])]


def body(i, n=8):
    return [f"{chr(97 + (i * 7 + j) % 26)}{'xyz'[j % 3] * (1 + (i + j) % 5)}q{'uvw'[i % 3] * (i // 3 + 1)} some own words of line {'k' * j}" for j in range(n)]


def test_a_recurring_line_goes_everywhere(spark):
    texts = ["\n".join([*body(i), "All rights reserved by the owner", "", " x "]) for i in range(6)]
    got = kept(spark, texts)
    assert got == ["\n".join([*body(i), "", " x "]) if False else "\n".join([*body(i), ""]) for i in range(6)]


def test_variable_fields_are_generalised(spark):
    names = ["ann", "bob", "cid", "dan", "eve", "fay"]
    texts = ["\n".join([*body(i), f"this page was printed by {names[i]} on {i + 3} may 20{i}0 at noon"]) for i in range(6)]
    assert kept(spark, texts) == ["\n".join(body(i)) for i in range(6)]
    # a line of the same leaf that shares too little with the template stays
    other = "this page was quite unlike those we saw here until now today"
    texts[0] += "\n" + other
    assert len(other.split()) == len(texts[1].split("\n")[-1].split())
    assert kept(spark, texts)[0].endswith(other)


def test_copies_are_no_evidence(spark):
    same = "\n".join(body(1, 12))
    near = [same.replace("line kkk", f"row {'z' * i} kkk") for i in range(1, 8)]
    assert kept(spark, [same] * 9) == [same] * 9
    assert kept(spark, [same, *near]) == [same, *near]


def test_too_few_texts(spark):
    texts = ["\n".join([*body(i), "a line in three texts only"]) for i in range(3)]
    assert kept(spark, texts) == texts
    assert kept(spark, texts, min_texts=3) == ["\n".join(body(i)) for i in range(3)]


def by_hand(texts, min_texts=LT.MIN_TEXTS):
    """The same rules in plain Python, for texts without digits whose votes have no ties."""
    where = defaultdict(set)
    for k, t in enumerate(dict.fromkeys(texts)):
        for x in t.split("\n"):
            if x.split():
                where[tuple(x.split())].add(k)
    leaves = defaultdict(list)
    for x in where:
        leaves[len(x), x[:3]].append(x)

    def fields(x):
        rest = len(x) - 3
        return [x[3 + j * rest // 8:3 + (j + 1) * rest // 8] for j in range(8)] if rest > 0 else []

    template = {}
    for leaf, xs in leaves.items():
        if len(xs) > 1 and len(leaf[1]) == 3 and leaf[0] > 3:
            usual = [Counter({f: 0 for f in ()}) for _ in range(8)]
            for x in xs:
                for j, f in enumerate(fields(x)):
                    usual[j][f] += len(where[x])
            for x in xs:
                fs = [(j, f) for j, f in enumerate(fields(x)) if f]
                if sum(usual[j].most_common(1)[0][0] == f for j, f in fs) >= 0.5 * len(fs):
                    template[x] = leaf
    total = Counter()
    for x in where:
        total[template.setdefault(x, x)] += len(where[x])
    first = {x for x in where if total[template[x]] >= min_texts}
    texts = list(dict.fromkeys(texts))
    copies = set()
    for k, t in enumerate(texts):
        own = {x for x in t.split("\n") if x.split()}
        hit = [x for x in own if tuple(x.split()) in first]
        if sum(map(len, hit)) > LT.COPY_SHARE * len(t) or len(hit) > LT.COPY_SHARE * len(own):
            copies.add(k)
    again = Counter()
    for x in first:
        again[template[x]] += len(where[x] - copies)
    gone = {x for x in first if again[template[x]] >= min_texts}
    return {t: "\n".join(x for x in t.split("\n") if tuple(x.split()) not in gone) for t in texts}


def test_against_plain_python(spark):
    import random
    random.seed(11)
    boiler = [f"subscribe to our {a} letter and read {b} every day of the {c}" for a, b, c in
              [("daily", "news", "week"), ("daily", "news", "year"), ("weekly", "news", "week"), ("daily", "notes", "week")]]
    texts = []
    for i in range(120):
        lines = body(i, random.randint(2, 9))
        for b in random.sample(boiler, random.choice([0, 0, 1, 2])):
            lines.insert(random.randint(0, len(lines)), b)
        if i % 4 == 0:
            lines.append("share this")
        texts.append("\n".join(lines))
    texts += texts[:30]
    want = by_hand(texts)
    assert kept(spark, texts) == [want[t] for t in texts]
    assert any(want[t] != t for t in texts)


def test_odd_rows(odd, nothing):
    got = LT.drop_templates(odd)
    assert got.count() == odd.count()
    assert set(odd.columns) - {"n_dropped"} <= set(got.columns)
    assert got.schema["n_dropped"].dataType.typeName() == "long"
    assert got.where("n_dropped > 0").count() == 0
    same = got.select("doc_id", F.xxhash64("text")).exceptAll(odd.select("doc_id", F.xxhash64("text")))
    assert same.count() == 0
    assert LT.drop_templates(nothing).count() == 0


def test_only_boilerplate_leaves_an_empty_text(spark):
    texts = ["\n".join([*body(i), "follow us on all our pages"]) for i in range(6)] + ["follow us on all our pages"]
    assert kept(spark, texts)[-1] == ""


@pytest.mark.parametrize("line,want", [("a 12 b", ["a", "<*>", "b"]), ("  x\t y1,z ", ["x", "<*>"])])
def test_tokens(spark, line, want):
    assert spark.range(1).select(LT.tokens_of(F.lit(line)).alias("t")).first()["t"] == want
