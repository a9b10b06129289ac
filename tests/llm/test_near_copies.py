import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from posegrid.llm import itq, simhash
from posegrid.llm.components import components


def groups(pairs, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    pairs = [(random.randint(-40, 400), random.randint(-40, 400)) for _ in range(180)]
    pairs += [(1000 + i, 1001 + i) for i in range(150)] + [(5, 5)]
    random.shuffle(pairs)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups([p for p in pairs if p[0] != p[1]], {x for p in pairs if p[0] != p[1] for x in p})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_by_definition(spark):
    texts = ["one two THREE four", "one", "", None, " \n", "É é E e É é", "a b c " * 400, "x  y\tz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.cluster(docs).collect()}
    for i, text in enumerate(texts):
        words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i] == f"{want:016x}"


@pytest.mark.parametrize("per_shard,split_from,brute", [(16, 2, 4096), (64, 1000, 4096), (100_000, 8, 32)])
def test_links_of_codes_by_brute_force(spark, monkeypatch, per_shard, split_from, brute):
    monkeypatch.setattr(simhash, "PER_SHARD", per_shard)
    monkeypatch.setattr(simhash, "SPLIT_FROM", split_from)
    monkeypatch.setattr(simhash, "BRUTE", brute)
    rng = np.random.default_rng(1)
    codes = [int(x) for x in rng.integers(0, 2**64, 500, dtype=np.uint64)]
    for b in codes[:120]:
        for _ in range(2):
            x = b
            for k in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(k)
            codes.append(x)
    codes += [codes[3] ^ (1 << a) ^ (1 << b) for a in range(16) for b in range(16)]  # one dense group
    codes = np.unique(np.array(codes, np.uint64))
    pairs = [(i, j) for i in range(len(codes)) for j in np.nonzero(np.bitwise_count(codes[i] ^ codes) <= 3)[0] if i < j]
    want = groups(pairs, range(len(codes)))
    keys = codes.view(np.int64).tolist()
    frame = spark.createDataFrame([(k, [k], None) for k in keys], "key long, codes array<long>, signs binary")
    edges = simhash.forest_edges(frame).collect()
    assert len(edges) < 60 * len(codes)
    got = groups([(keys.index(r["a"]), keys.index(r["b"])) for r in edges], range(len(codes)))
    assert got == want


def test_every_pair_meets_in_a_tree():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**32, 4000, dtype=np.uint32)
    codes[2000:] = codes[:2000] ^ (np.uint32(1) << rng.integers(0, 32, 2000).astype(np.uint32))
    tree = simhash.build_tree(codes[:500], 40, 1)
    at, leaf, home = simhash.route(codes, tree, 1)
    assert tree.leaves > 10 and home.sum() == len(codes) == len(set(at[home]))
    living, seen = dict(zip(at[home], leaf[home])), defaultdict(set)
    for i, x in zip(at, leaf):
        seen[i].add(x)
    assert all(living[i] in seen[i + 2000] or living[i + 2000] in seen[i] for i in range(2000))


def test_documents_by_brute_force(spark, odd, nothing):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(60):
        words = random.choices(vocabulary, k=random.randint(1, 400))
        texts.append(" ".join(words))
        for _ in range(i % 3):
            words[random.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(9999 + i, t) for i, t in enumerate(texts[:20])]
    got = simhash.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in got}
    ids = sorted(prints)
    pairs = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {r["doc_id"]: r["component_id"] for r in got} == groups(pairs, ids)
    found = simhash.cluster(odd)
    assert found.count() == odd.count()
    # all texts without words are one class
    empty = found.where("fingerprint = '0000000000000000'").select("component_id").distinct().collect()
    assert [r[0] for r in empty] == [2]
    assert simhash.cluster(nothing).count() == 0


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_near_copies(spark, odd, nothing):
    random.seed(6)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows, want = [], []
    for i in range(40):
        words = random.choices(vocabulary, k=random.randint(80, 500))
        rows.append((i * 10, " ".join(words)))
        for k in range(1, 4):
            copy = list(words)
            for _ in range(max(1, len(words) // 90)):  # similarity about 0.9
                copy[random.randrange(len(copy))] = "other"
            rows.append((i * 10 + k, " ".join(copy)))
        unlike = list(words)
        for _ in range(len(words) // 12):  # similarity about 0.5
            unlike[random.randrange(len(unlike))] = "another"
        rows.append((i * 10 + 7, " ".join(unlike)))
        rows.append((i * 10 + 8, " ".join(words)))
    rows += rows[:3]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, component_id string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    stay = sorted(r["doc_id"] for r in got.collect())
    texts = dict(rows)
    ids = sorted(texts)
    sets = {i: shingles(t) for i, t in texts.items()}
    pairs = [(a, b) for a in ids for b in ids if a < b and a // 10 == b // 10
             and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    roots = groups(pairs, ids)
    assert stay == sorted(set(roots.values()))
    kept = simhash.keep_one(odd)
    # one row with id 1, one without words (2), one of the long texts (5); null ids by themselves
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect()) == [-1, 1, 2, 5, 7, 8, 9]
    assert simhash.keep_one(nothing).count() == 0


# ------------------------------------------------------------------ embeddings

def by_brute_force(vectors, labels, ids, threshold=0.93):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b]
    root = groups(pairs, range(len(ids)))
    return near.sum(1), [ids[root[i]] for i in range(len(ids))]


def test_embeddings_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = []
    for b in rng.standard_normal((250, 32)):
        b /= np.linalg.norm(b)
        vectors.append(b)
        for cosine in rng.uniform(0.93, 0.995, 2):
            r = rng.standard_normal(32)
            r -= (r @ b) * b
            vectors.append(cosine * b + np.sqrt(1 - cosine**2) * r / np.linalg.norm(r))
    vectors += [vectors[0]] * 300  # one very common vector, a scaled one and a dense group
    vectors += [vectors[1] * 3.0] + [vectors[5] + 0.01 * x for x in rng.standard_normal((200, 32))]
    vectors = np.array(vectors)
    labels, ids = np.arange(len(vectors)) % 1 + 4, [int(i) for i in np.arange(len(vectors)) * 2]
    n_links, component = by_brute_force(vectors, labels, ids)
    for block in (itq.BLOCK, 40):
        monkeypatch.setattr(itq, "BLOCK", block)
        rows = spark.createDataFrame([(i, v.tolist(), int(x), "c") for i, v, x in zip(ids, vectors, labels)],
                                     "vec_id long, embedding array<double>, label int, component_id string")
        got = sorted(itq.cluster(rows).collect(), key=lambda r: r["vec_id"])
        links = np.array([r["n_links"] for r in got])
        assert (links <= n_links).all() and links.sum() >= 0.97 * n_links.sum()
        assert np.mean([r["component_id"] == c for r, c in zip(got, component)]) > 0.95
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, None], 1), (11, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.001], 1), (1, [1.0, 0.0], 1), (12, [1e300, 1e300], 3), (13, [1e-300, 1e-300], 3), (14, [-0.0, 5.0], 3)]
    got = itq.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in got))
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 14)]
    assert found == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (-1, 3, 1, False), (12, 1, 12, True),
                            (13, 1, 12, False)] + alone)
    assert itq.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_rotation_is_orthogonal():
    x = np.random.default_rng(0).standard_normal((500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = itq.learn_rotation(x, 16, 1)
    assert np.allclose(r.T @ r, np.eye(16), atol=1e-8)

    def loss(turn):
        v = x @ turn
        return ((np.where(v >= 0, 1, -1) / 4 - v) ** 2).sum()

    assert loss(r) < loss(itq.learn_rotation(x, 16, 1, iterations=0))


def test_table_plan():
    for vectors in (100, 10_000, 10**7):
        width, each, rotations = itq.plan_tables(vectors, 64, 0.93)
        agree = (1 - np.arccos(0.93) / np.pi) ** width
        assert width * each <= 64 and (1 - agree) ** (each * rotations) <= itq.MISS


def classes_by_brute_force(texts):
    sets = [shingles(t) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)
             if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    return groups(pairs, range(len(texts)))


def test_dense_groups_of_near_copies_by_brute_force(spark):
    random.seed(8)
    vocabulary = [f"v{i}" for i in range(4000)]
    texts = []
    for length, copies in ((200, 300), (192, 300), (150, 150)):
        words = random.choices(vocabulary, k=length)
        for _ in range(copies):
            copy = list(words)
            for i in random.sample(range(length), 3):
                copy[i] = random.choice(vocabulary)
            texts.append(" ".join(copy))
    got = simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert got.select("component_id").distinct().count() == len(set(classes_by_brute_force(texts).values()))
    assert {r[0] for r in got.select("component_id").collect()} == set(classes_by_brute_force(texts).values())


def test_cut_and_extended_copies_by_brute_force(spark):
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(4000)]
    texts = []
    for i in range(120):
        words = random.choices(vocabulary, k=random.choice([50, 100, 200, 800]))
        n, share = len(words), random.uniform(0.79, 0.91)
        more = random.choices(vocabulary, k=n)
        texts += [" ".join(words), " ".join(words[:int(share * n)] if i % 2 else words + more[:int((1 / share - 1) * n)])]
    want = classes_by_brute_force(texts)
    assert len(texts) * 0.52 < len(set(want.values())) < len(texts) * 0.95
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r[0] for r in simhash.near_copies(rows).select("component_id").collect()} == set(want.values())


def test_texts_of_shared_passages_by_brute_force(spark):
    random.seed(10)
    vocabulary = [f"v{i}" for i in range(3000)]
    passages = [" ".join(random.choices(vocabulary, k=random.choice([6, 30, 60]))) for _ in range(12)]
    texts = ["one", "one ", "one two", "a b c d e f", "a b c d e  f", "a b c d e f g", "a b c d e f g h i", "b c d e f g h i", "", " "]
    for i in range(300):
        own = " ".join(random.choices(vocabulary, k=random.choice([0, 5, 10, 40, 80])))
        texts.append(" ".join([*random.sample(passages, random.choice([1, 2, 3, 4])), own]))
    texts = list(dict.fromkeys(texts))
    want = classes_by_brute_force(texts)
    assert 1 < len(texts) - len(set(want.values()))
    got = simhash.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r[0] for r in got.select("component_id").collect()} == set(want.values())
    assert got.select("component_id").distinct().count() == len(set(want.values()))


def test_near_copies_go_through_fingerprints(spark, monkeypatch):
    """The trees' links of fingerprints are among the pairs that the exact similarity decides."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(12):
        own = rng.choice(words, 400).tolist()
        texts.append(" ".join(own))
        for _ in range(3):
            other = list(own)
            other[int(rng.integers(400))] = "other"
            texts.append(" ".join(other))
    texts += ["", "a b c"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, t string")
    codes = [simhash.majority_bits(simhash.shingle_hashes(simhash.words_of(t), 3)) for t in texts]
    links = {(r.a, r.b) for r in simhash.fingerprint_links(rows).collect()}
    assert links and all(a > b and (codes[a] ^ codes[b]).bit_count() <= simhash.MAX_BITS for a, b in links)
    up = list(range(len(texts)))
    for _ in up:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    assert all(up[i] == up[j] for i in range(len(texts)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= simhash.MAX_BITS)
    asked, trees = [], simhash.forest_edges
    monkeypatch.setattr(simhash, "forest_edges", lambda *a, **k: asked.append(1) or trees(*a, **k))
    assert simhash.keep_one(rows.select(F.col("key").alias("doc_id"), F.col("t").alias("text"))).count() == 14
    assert asked


def test_similarity_of_sets(spark):
    cases = [("", ""), ("a", ""), ("a b c d e f", "a b c d e f g"), ("x y", "x y"), ("a b c d e f", "f e d c b a")]
    df = spark.createDataFrame(cases, "a string, b string")
    got = [r[0] for r in df.select(simhash.set_similarity(simhash.shingles_of(F.col("a"), 5),
                                                          simhash.shingles_of(F.col("b"), 5))).collect()]
    assert got == [1.0, 0.0, 2 / 3, 1.0, 0.0]


def test_crowded_shingles_form_few_pairs(spark):
    """300 texts share five shingles of the 20 that begin each; two and two share the other 15."""
    rows = [(s if s < 5 else 1000 * (k // 2) + s, k, s, 100, k) for k in range(300) for s in range(20)]
    rooted = spark.createDataFrame(rows, "shingle long, key long, at int, size int, root long")
    ranked = simhash.ranked(rooted)
    # not 5 * 300 * 299 / 2
    assert simhash.meeting(ranked, 0.8).count() <= 150 * 15
    assert sorted(map(tuple, simhash._across(ranked, 0.8).collect())) == [(2 * i + 1, 2 * i) for i in range(150)]


def test_pairs_of_texts_with_a_common_passage(spark):
    """Every pair at 0.8 or more is linked, with sizes on both sides of the bound and beginnings that all share."""
    r = random.Random(12)
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for g in range(25):
        own = [f"g{g}w{i}" for i in range(r.randint(10, 120))]
        for _ in range(6):
            at, cut = r.randint(0, len(own)), r.randint(0, len(own) // 4)
            body = own[:len(own) - cut]
            if r.random() < 0.5:
                body = body[:at] + [f"x{r.random()}"] + body[at:]
            texts.append(" ".join(passage + body if r.random() < 0.7 else body + passage))
    sets = [set(simhash.shingle_set(t, 5).tolist()) for t in texts]
    up = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    up[i] = up[j] = min(up[i], up[j])
        if all(up[i] == up[j] for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
            break
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {x["doc_id"] for x in simhash.keep_one(docs).collect()}
    assert kept == set(up) and 25 < len(kept) < len(texts)
