"""Block-wise results equal plain windows, whatever the block width, with one hot key."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from posegrid.scale import attach, bracket, line, order_stats, ordered, smallest_sum, state_scan


@pytest.fixture(scope="module")
def rows(spark):
    k = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11)
    return spark.range(600).select(k.alias("k"), (F.col("id") * 7 % 1201).alias("o"),
                                   F.when(F.col("id") % 4 == 0, F.col("id") * 1.5).alias("v"),
                                   (F.col("id") % 13).alias("w")).cache()


@pytest.mark.parametrize("width", [1, 17, 5000])
def test_ordered_equals_plain_windows(rows, width):
    got = ordered(rows, line("k", "o", width), position="p", size="n", prev={"pw": "w"},
                  following={"nw": "w"}, running={"r": "w"}, total={"t": "w"}, seen={"s": "v"},
                  ahead={"a": "v"}).orderBy("k", "o").collect()
    w = Window.partitionBy("k").orderBy("o")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    rest = w.rowsBetween(0, Window.unboundedFollowing)
    g = Window.partitionBy("k")
    want = rows.select("*", (F.row_number().over(w) - 1).cast("bigint").alias("p"),
                       F.count("*").over(g).alias("n"), F.lag("w").over(w).alias("pw"),
                       F.lead("w").over(w).alias("nw"), F.sum("w").over(past).alias("r"),
                       F.sum("w").over(g).alias("t"), F.last("v", True).over(past).alias("s"),
                       F.first("v", True).over(rest).alias("a")).orderBy("k", "o").collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want]


@pytest.mark.parametrize("width", [1, 17])
def test_rows_with_null_keys_or_order_stay(spark, width):
    df = spark.createDataFrame([(1, 5, 10), (1, None, 20), (None, 3, 30), (None, 40, 50), (1, 90, 40), (2, None, 60)],
                               "k int, o long, w int")
    got = ordered(df, line("k", "o", width), position="p", size="n", prev={"pw": "w"}, following={"nw": "w"},
                  running={"r": "w"}, seen={"s": "w"}).collect()
    w = Window.partitionBy("k").orderBy("o")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", (F.row_number().over(w) - 1).cast("bigint").alias("p"),
                     F.count("*").over(Window.partitionBy("k")).alias("n"), F.lag("w").over(w).alias("pw"),
                     F.lead("w").over(w).alias("nw"), F.sum("w").over(past).alias("r"),
                     F.last("w", True).over(past).alias("s")).collect()
    assert sorted(map(repr, (r.asDict() for r in got))) == sorted(map(repr, (r.asDict() for r in want)))


def test_bracket_equals_brute_force(spark, rows):
    knots = rows.filter("o % 5 = 0").select("k", F.col("o").alias("t"), "w")
    targets = rows.select("k", F.col("o").alias("t"))
    got = bracket(targets, knots, ["k"], "t", ["w"], 50).collect()
    at = {}
    for r in knots.collect():
        at.setdefault(r.k, []).append((r.t, r.w))
    assert len(got) == rows.count()
    for r in got:
        before = max((p for p in at.get(r.k, []) if p[0] <= r.t), default=(None, None))
        after = min((p for p in at.get(r.k, []) if p[0] > r.t), default=(None, None))
        assert (r.prev_t, r.prev_w) == before and (r.next_t, r.next_w) == after


def test_attach_keeps_every_row(rows):
    stats = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("w").alias("t"))
    got = attach(rows, stats, "k")
    assert got.count() == rows.count()
    assert got.agg(F.sum("t")).first()[0] == sum(
        r.n * r.t for r in stats.collect())


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 0.7, 1.0])
def test_order_stats_equal_numpy(rows, q):
    near = {r.k: r.a for r in order_stats(rows, "k", "v", {"a": q}).collect()}
    lin = {r.k: r.a for r in order_stats(rows, "k", "v", {"a": q}, mode="linear").collect()}
    data = rows.filter("v IS NOT NULL").toPandas().groupby("k")["v"]
    for k, v in data:
        s = np.sort(v.to_numpy())
        assert near[k] == s[int(np.rint(q * (len(s) - 1)))]
        assert lin[k] == pytest.approx(np.quantile(s, q))


def test_order_stats_with_ties_and_signs(spark):
    df = spark.createDataFrame([(1, v) for v in [-2.0, -2.0, -2.0, 0.0, 0.0, 5.0, 5.0]],
                               "k int, v double")
    r = order_stats(df, "k", "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).first()
    assert (r.lo, r.mid, r.hi, r.n) == (-2.0, 0.0, 5.0, 7)


def test_smallest_sum(rows):
    df = rows.withColumn("kk", F.lit(5)).withColumn("x", F.col("w") + 0.25)
    got = {r.k: r.s for r in smallest_sum(df, ["k"], "x", "kk", "s").collect()}
    for k, v in df.toPandas().groupby("k")["x"]:
        assert got[k] == pytest.approx(np.sort(v.to_numpy())[:5].sum())


def test_state_scan_equals_sequential(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), "id", F.lit(2).alias("start"), *[
        F.pmod(F.col("id") * m + c, F.lit(4)).cast("int").alias(f"s{i}")
        for i, (m, c) in enumerate([(1, 0), (3, 1), (5, 2), (7, 3)])])
    got = {r.id: r.state for r in state_scan(df, ["k"], "id", ["s0", "s1", "s2", "s3"], "start",
                                              "state", width=9).collect()}
    state = 2
    for r in df.orderBy("id").collect():
        state = r[f"s{state}"]
        assert got[r.id] == state


def test_name_blocks_keep_the_order_and_split_long_prefixes(spark):
    from posegrid.scale import name_blocks
    names = [f"GX01_IMG_{i:06d}.jpg" for i in range(0, 9000, 7)] + ["GX01_IMG_"]
    df = spark.createDataFrame([("a", n) for n in names] + [("b", "x"), ("b", ""), (None, "zzzz")], "k string, f string")
    got = name_blocks(df, ["k"], "f", 5).collect()
    assert len(got) == len(names) + 3
    own = sorted((r.f, r._block) for r in got if r.k == "a")
    assert [b for _, b in own] == sorted(b for _, b in own) and len({b for _, b in own}) > 80
