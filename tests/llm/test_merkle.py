import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from posegrid.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, number string, tree string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        begin = i // 3 * 3
        out.append(("".join(level[begin:i]), "".join(level[i + 1:begin + 3])))
        i //= 3
    return out


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in groups[g]]) for g in order]
    top = tree([t[-1][0] for t in trees])
    root = top[-1][0]
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = siblings(trees[k], i) + siblings(top, k)
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                changed[4] = r[4].replace("\n", "")
            folded = leaf_of(changed)
            for a, b in path:
                folded = sha(a + folded + b)
            out.append((r[0], leaf_of(r), trees[k][-1][0], root, sha("".join(a + b for a, b in path)), folded,
                        folded == root))
    return sorted(out, key=repr)


def verified(docs):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle.verify(docs, COLUMNS, {"text": text}).collect()), key=repr)


def rows(spec):
    return [(i, t, "en", s, len(t or ""), "x", "x", "x") for i, t, s in spec]


CASES = {
    "one row": [(1, "a\nb", "s")],
    "one row, unchanged text": [(1, "ab", "s")],
    "one group of 28": [(i, f"t{i}\n", "s") for i in range(28)],
    "groups of 1 to 10, null first": [(100 * g + i, "x\ny" * i, None if g == 3 else f"é{g}") for g in range(1, 11)
                                      for i in range(g)],
    "many groups of one": [(i, None if i % 5 == 0 else "a\n" * (i % 3), f"g{i}") for i in range(100)],
    "odd rows": [(None, "a\n", "s"), (None, "b\n", "s"), (7, None, "s"), (7, "", "s"), (7, "", "s"), (8, "\n", None),
                 (9, "🙂\n é" * 50_000, "s"), (-4, "-", ""), (10**15, "\r\n\n", "s")],
}


@pytest.mark.parametrize("case", CASES)
def test_equal_to_a_tree_by_hand(spark, case):
    docs = spark.createDataFrame(rows(CASES[case]), SCHEMA)
    assert verified(docs) == by_hand([tuple(r[c] for c in COLUMNS) for r in docs.collect()])


def test_group_over_many_chunks(spark):
    docs = spark.range(0, 4000, numPartitions=7).select(
        (F.col("id") * 37 % 4001).alias("doc_id"), F.concat(F.lit("line\n"), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.lit(6).cast("long").alias("n_chars"))
    assert verified(docs) == by_hand([tuple(r[c] for c in COLUMNS) for r in docs.collect()])


def test_empty_table(spark, nothing):
    out = merkle.verify(nothing, COLUMNS, {})
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert out.count() == 0


def test_unchanged_table_is_verified_and_one_changed_value_is_found(spark, odd):
    assert merkle.verify(odd, COLUMNS, {}).where("NOT verified").count() == 0
    changed = F.when(F.col("doc_id") == 3, F.lit("zz")).otherwise(F.col("lang"))
    assert [r["doc_id"] for r in merkle.verify(odd, COLUMNS, {"lang": changed}).where("NOT verified").collect()] == [3]
