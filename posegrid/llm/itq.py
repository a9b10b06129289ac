"""Operator 5: near duplicates among embeddings by iterative quantisation.

Vectors are scaled to length one. A rotation is learnt from a bounded sample (``SAMPLE`` smallest hashes of
distinct vectors): principal directions, then iterations that turn them so that the signs of the rotated
vectors lose least (the orthogonal Procrustes step), which balances the bits. Several such rotations from
different random starts give several codes of 64 bits or the vectors' dimension, whichever is less.

Retrieval is by multi-index tables: each code is cut into substrings, and each substring of each rotation is
a table, whose key is the label, the table and the substring's bits. The number of bits follows the number of
vectors (about ``BUCKET`` of them share a key if codes are even), the number of tables follows from the bits
and the chance that two vectors at the threshold agree in one bit, so that all but ``MISS`` of such
pairs meet in some table; nearer pairs meet more often. In a table's bucket the original vectors travel
along and are compared exactly: a link needs a cosine of at least the threshold, in double precision.

Equal vectors of one label are one class before all this, so a vector that a third of all rows share is one
row. A pair that meets in several tables counts in the first of them. A bucket gives one row per linked class
(how many vectors it links to there, and a spanning star), never its pairs; a crowded bucket is split into
blocks, each block of its rows meeting every other once.

Results for odd inputs: a vector that is null, empty or zero, or holds a null, a NaN or an infinity, or whose
label is null, links with nothing (n_links 0, its own component, kept) and so does one whose length differs
from the first usable one's; rows that share an id are vectors of their own; a null id is nobody's component
while another id is there; an empty table gives an empty table; only the columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import cut, written
from posegrid.llm.components import components

THRESHOLD = 0.93
SAMPLE = 20_000
ITERATIONS = 30
BUCKET = 64
MISS = 0.02
#: rows of a bucket that one task compares with each other; larger ones are split into blocks of this size
BLOCK = 4096


# ------------------------------------------------------------------ codes

def learn_rotation(x: np.ndarray, bits: int, seed: int, iterations: int = ITERATIONS) -> np.ndarray:
    """dimension x bits: project by it, then take signs. ``x``: rows of length one."""
    rng = np.random.default_rng(seed)
    _, directions = np.linalg.eigh(x.T @ x)  # ascending
    main = directions[:, ::-1][:, :bits]
    v = x @ main
    turn, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(iterations):
        left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    return main @ turn


def plan_tables(vectors: int, bits: int, threshold: float, bucket: int = BUCKET, miss: float = MISS,
                near: float | None = None) -> tuple[int, int, int]:
    """(bits of a substring, substrings of a code, rotations)."""
    width = int(min(bits, 24, max(6, round(math.log2(max(2, vectors / bucket))))))
    agree = (1 - math.acos(threshold) / math.pi if near is None else near) ** width
    tables = max(1, math.ceil(math.log(miss) / math.log(1 - min(agree, 0.999))))
    each = bits // width
    return width, each, max(1, math.ceil(tables / each))


def table_keys(x: np.ndarray, rotations: list[np.ndarray], width: int, each: int) -> np.ndarray:
    """rows x tables: the bits of every substring of every code."""
    weights = 1 << np.arange(width, dtype=np.int64)
    keys = []
    for r in rotations:
        signs = (x @ r) >= 0
        keys += [signs[:, k * width:(k + 1) * width] @ weights for k in range(each)]
    return np.stack(keys, axis=1) if keys else np.empty((len(x), 0), np.int64)


# ------------------------------------------------------------------ comparison in a bucket

def compare(x: np.ndarray, keys: np.ndarray, table: int, left: np.ndarray, right: np.ndarray, same: bool,
            threshold: float, size: np.ndarray, degree: np.ndarray, up: np.ndarray) -> None:
    """Links between rows ``left`` and ``right`` that meet in no earlier table, added to ``degree`` (vectors
    linked to) and joined in ``up``."""
    for i in range(0, len(left), 512):
        a = left[i:i + 512]
        near = x[a] @ x[right].T >= threshold
        if same:
            near &= np.arange(i, i + len(a))[:, None] < np.arange(len(right))[None, :]
        p, q = np.nonzero(near)
        p, q = a[p], right[q]
        if table:
            new = ~(keys[p, :table] == keys[q, :table]).any(axis=1)
            p, q = p[new], q[new]
        np.add.at(degree, p, size[q])
        np.add.at(degree, q, size[p])
        # rounds of joining smaller roots; each settles most links at once
        while len(p):
            while (up != up[up]).any():
                up[:] = up[up]
            s, t = up[p], up[q]
            apart = s != t
            p, q, s, t = p[apart], q[apart], s[apart], t[apart]
            np.minimum.at(up, np.maximum(s, t), np.minimum(s, t))


def links(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, bucket: int = BUCKET,
          miss: float = MISS) -> tuple[DataFrame, DataFrame]:
    """Of distinct vectors (key long, label, x binary of float64 of length one, size): (key, n_links) with one
    row per bucket that has links, and (a, b) with the edges of stars that span the linked ones."""
    count = vectors.count()
    rows = vectors.orderBy(F.xxhash64("x"), "key").limit(sample).select("x").collect()
    length = len(rows[0]["x"]) // 8 if rows else 1
    train = np.array([np.frombuffer(r["x"]) for r in rows if len(r["x"]) == 8 * length]).reshape(-1, length)
    bits = min(64, length)
    width, each, rounds = plan_tables(count, bits, threshold, bucket, miss)
    rotations = [learn_rotation(train, bits, seed) for seed in range(rounds)]
    tables = each * rounds

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["x"].to_pylist()
            fits = np.array([len(r) == 8 * length for r in raw], bool)
            if not fits.any():
                continue
            part = batch.filter(pa.array(fits))
            x = np.frombuffer(b"".join(r for r in raw if len(r) == 8 * length)).reshape(-1, length)
            keys = table_keys(x, rotations, width, each).astype("<i4")
            packed = pa.array([k.tobytes() for k in keys], pa.binary())
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [part["label"], pa.array(np.full(len(x), t), pa.int32()), pa.array(keys[:, t].astype(np.int64)),
                     part["key"], part["size"], part["x"], packed],
                    names=["label", "tab", "code", "key", "size", "x", "keys"])

    dealt = vectors.select("key", "label", "size", "x").mapInArrow(
        deal, "label string, tab int, code long, key long, size long, x binary, keys binary")
    bucket_of = ["label", "tab", "code"]
    crowded = (dealt.groupBy(*bucket_of).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
               .select(*bucket_of, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    # block i meets block j in the group (i, j), i <= j
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    met = (dealt.join(crowded, bucket_of, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))

    def meet(group: pa.Table) -> pa.Table:
        n = group.num_rows
        x = np.frombuffer(b"".join(group["x"].to_pylist())).reshape(n, -1)
        keys = np.frombuffer(b"".join(group["keys"].to_pylist()), "<i4").reshape(n, -1)
        size, key = group["size"].to_numpy(), group["key"].to_numpy()
        mine = group["own"].to_numpy()
        degree, up = np.zeros(n, np.int64), np.arange(n)
        i, j, table = group["i"][0].as_py(), group["j"][0].as_py(), group["tab"][0].as_py()
        left = np.nonzero(mine == i)[0]
        right = left if i == j else np.nonzero(mine == j)[0]
        compare(x, keys, table, left, right, i == j, threshold, size, degree, up)
        while (up != up[up]).any():
            up = up[up]
        found = degree > 0
        return pa.table({"key": pa.array(key[found], pa.int64()), "n_links": pa.array(degree[found], pa.int64()),
                         "root": pa.array(key[up[found]], pa.int64())})

    found = written(met.groupBy(*bucket_of, "i", "j").applyInArrow(meet, "key long, n_links long, root long"))
    return (found.select("key", "n_links"),
            found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))


# ------------------------------------------------------------------ all vectors

def unit_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``x``: the vector scaled to length one, as bytes of float64; null if it is unusable."""
    @F.arrow_udf("binary")
    def scaled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for row in batch:
                values = row.as_py()
                if not values or None in values:
                    out.append(None)
                    continue
                x = np.array(values, np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or not top:
                    out.append(None)
                    continue
                x = x / top  # no overflow or underflow in the squares
                out.append((x / math.sqrt(x @ x) + 0.0).tobytes())  # no negative zeros
            yield pa.array(out, pa.binary())

    return vectors.withColumn("x", scaled(F.col(vector).cast("array<double>")))


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
            **options) -> DataFrame:
    """vec_id, n_links, component_id and kept (whether the vector names its component)."""
    rows = written(unit_vectors(vectors.select(F.col(id_col).alias("vec_id"), F.col(label).cast("string").alias("label"),
                                               F.col(vector).alias("v")), "v").drop("v"))
    usable = F.col("x").isNotNull() & F.col("label").isNotNull()
    # classes of equal vectors; the key is a hash of label and vector
    keyed = rows.withColumn("key", F.when(usable, F.xxhash64("label", "x")))
    classes = cut(keyed.where(usable).groupBy("key", "label", "x").agg(
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("first")))
    degrees, edges = links(classes.select("key", "label", "x", "size"), **options)
    rooted = (classes.select("key", "size", "first")
              .join(degrees.groupBy("key").agg(F.sum("n_links").alias("n")), "key", "left")
              .join(components(edges).withColumnRenamed("node", "key"), "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select(
        "key", "component_id", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    # rows without a usable vector meet nothing; they need no join, so they don't gather in one task
    own = F.col("component_id").eqNullSafe(F.col("vec_id"))
    linked = keyed.where(usable).join(found, "key").select("vec_id", "n_links", "component_id", own.alias("kept"))
    alone = keyed.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone)
