"""Operator 11: Merkle manifest of a dataset, and the check of changed rows against it by a recursive query.

Each row is a leaf. The leaves of a group (a source), in the order of their keys, are the lowest level of the
group's tree; every three neighbours have one parent, the digest of their digests, up to one node, the group's
subroot. The subroots, in the order of the groups, are the leaves of the top tree, whose last node is the root.

The built levels are stored as rows that name their parent, three levels (``HEIGHT``) to a row: ``level, place`` (the
node), ``below`` (for each of the levels the digests under the node, 32 bytes each; empty where the tree ends lower),
``parent_level, parent_place, slot`` (the row above, and where the node stands in its lowest level). ``climb`` is one
recursive query over these rows: it starts at every leaf with the digest to be tested, and each step goes to the
row above, appends the siblings found there as a row, and folds the carried digest with them, level by level.
The leaf's proof is the siblings of all its steps.

Scale: leaves are numbered by a range partitioning, never by a window over a group. Three levels are one aggregation
of at most 27 rows per group. High nodes lie above many leaves, so every row is repeated for each ``CHUNK`` leaves
below it and climbing leaves meet the copy of their chunk: no join key ever has more rows than a chunk, and all
copies together are fewer than the leaves. Steps leave rows of their own, so a row doesn't grow with the height of the
tree. Levels are tables in the shared folder; the recursion's steps are Spark shuffles, rebuilt if an executor
is lost. What reaches the driver is the root and the size of the largest group.

Results for odd inputs: a null value counts as ``-`` in its leaf, unlike an empty text (``0:``); null groups and
null keys come first and are leaves like others; rows with equal keys are ordered by their digests, so equal rows
have equal leaves and proofs of their own places; a group of one row has its leaf as subroot and a single
group's subroot is the root, with the digest of the empty string as proof where nothing stands beside it; an empty table
has an empty result; very long texts are digested whole; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import written

FAN = 3  # children of a node
HEIGHT = 3  # levels of a stored row
BLOCK = FAN ** HEIGHT
CHUNK = FAN ** 5  # leaves that share their copies of the rows above
TOP = 64  # the levels of the top tree are counted from here
STEP = 33  # bits of monotonically_increasing_id for the row in its partition


def digest(*values: Column) -> Column:
    """SHA-256 in lowercase hex of the values, each as ``-`` if null, else its length in bytes, ``:``, itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")),
                        F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, order: list[str], number: str) -> DataFrame:
    """``rows`` as a table with their place in the whole order, from 0: a range partitioning, then the counts of
    the partitions before."""
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = written(sorted_rows.select("*", F.monotonically_increasing_id().alias("__at")))
    part = F.shiftright("__at", STEP)
    # one row for each partition that Spark wrote
    counts = kept.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    upto = counts.select("__part", F.sum("__n").over(_before("__part")).alias("__upto"))
    return (kept.withColumn("__part", part).join(F.broadcast(upto), "__part")
            .select(*rows.columns, (F.coalesce("__upto", F.lit(0)) + F.col("__at").bitwiseAND((1 << STEP) - 1)).alias(number)))


def _before(column: str):
    from pyspark.sql import Window
    return Window.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Manifest:
    #: ``leaves`` as given, with number, digest, and where the leaf stands (tree, pos, parent_level, parent_place, slot)
    leaves: DataFrame
    #: inner nodes, a row each
    nodes: DataFrame
    #: tree, subroot
    subroots: DataFrame
    #: digest of the whole, or None of an empty table
    root: str | None


def _upper(nodes: str, count: Column) -> Column:
    """Digests of the runs of ``nodes`` (an array of hex digests), or null if the tree has only ``count`` = 1 there."""
    run = lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, FAN), ""), 256)
    return F.when(count > 1, F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN)), run))


def _levels(nodes: DataFrame, base: int, most: int) -> list[DataFrame]:
    """The rows above ``nodes`` (tree, rank, n, pos, first, last, digest), a table for each step, lowest first.

    ``n`` is the number of a tree's nodes on the level, ``most`` the largest of them."""
    steps = []
    size = BLOCK
    while most > 1:
        here = F.col("pos") - F.col("pos") % BLOCK
        rows = nodes.where("n > 1").groupBy("tree", (here / BLOCK).cast("long").alias("pos")).agg(
            F.max("rank").alias("rank"), F.max("n").alias("n0"), F.min("first").alias("first"),
            F.max("last").alias("last"), F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("runs"))
        rows = rows.withColumn("d0", F.transform("runs", lambda r: F.lower(F.hex(r["digest"]))))
        for k in range(HEIGHT):
            rows = rows.withColumn(f"n{k + 1}", F.ceil(F.col(f"n{k}") / FAN)).withColumn(
                f"d{k + 1}", _upper(f"d{k}", F.col(f"n{k}")))
        joined = lambda k: F.unhex(F.coalesce(F.array_join(F.when(F.col(f"n{k}") > 1, F.col(f"d{k}")), ""), F.lit("")))
        highest = F.coalesce(*[F.col(f"d{k}") for k in range(HEIGHT, 0, -1)])
        nodes = written(rows.select(
            "tree", "rank", F.col(f"n{HEIGHT}").alias("n"), "pos", "first", "last", F.unhex(highest[0]).alias("digest"),
            F.struct(*[joined(k).alias(f"b{k}") for k in range(HEIGHT)]).alias("below"),
            F.lit(base + len(steps) + 1).alias("level"), (F.col("tree") + F.col("pos") * F.lit(size)).alias("place")))
        steps.append(nodes)
        most = -(-most // BLOCK)
        size *= BLOCK
    return steps


def _linked(nodes: DataFrame, level: int, groups: int) -> DataFrame:
    """``nodes`` of a level with the row above and their place in its lowest level; none above the root."""
    inside = F.col("n") > 1
    rank = F.col("rank") if groups > 1 and level < TOP else F.lit(None).cast("long")
    size = BLOCK ** (level % TOP + 1)
    return nodes.withColumns({
        "parent_level": F.when(inside, level + 1).when(rank.isNotNull(), TOP + 1),
        "parent_place": F.when(inside, F.col("tree") + (F.col("pos") - F.col("pos") % BLOCK) / BLOCK * F.lit(size))
                         .otherwise(rank - rank % BLOCK).cast("long"),
        "slot": F.when(inside, F.col("pos") % BLOCK).otherwise(rank % BLOCK).cast("int")})


def build(rows: DataFrame, group: str, key: str, leaf: str) -> Manifest:
    """Manifest of ``rows``, a table with the digest of each row (32 bytes) in column ``leaf``; the order is ``group``,
    ``key``, ``leaf``."""
    kept = numbered(rows, [group, key, leaf], "number")
    sizes = kept.groupBy(F.col(group).alias("__group")).agg(F.min("number").alias("tree"), F.count(F.lit(1)).alias("n"))
    trees = written(numbered(sizes, ["tree"], "rank"))
    groups, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = written(_linked(
        kept.join(trees, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
        .withColumn("pos", F.col("number") - F.col("tree")), 0, groups))
    ground = leaves.select("tree", "rank", "n", "pos", F.col("number").alias("first"), F.col("number").alias("last"),
                           F.col(leaf).alias("digest"))
    low = _levels(ground, 0, most)
    ends = reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", "rank", "first", "last", "digest")
                                          for x in [ground, *low]])
    subroots = written(ends)
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(None).cast("long").alias("rank"),
                           F.lit(groups).alias("n"), F.col("rank").alias("pos"), "first", "last", "digest")
    high = _levels(tops, TOP, groups)
    last = (high[-1] if high else subroots).select(F.lower(F.hex("digest")).alias("root")).first()
    linked = [_linked(x, base + i + 1, groups) for base, levels in ((0, low), (TOP, high)) for i, x in enumerate(levels)]
    columns = ["level", "place", "below", "parent_level", "parent_place", "slot", "first", "last"]
    empty = rows.sparkSession.createDataFrame([], "level int, place long, below struct<b0 binary, b1 binary, b2 binary>, "
                                                  "parent_level int, parent_place long, slot int, first long, last long")
    nodes = reduce(DataFrame.unionByName, [x.select(*columns) for x in linked], empty)
    return Manifest(leaves, nodes, subroots.select("tree", F.lower(F.hex("digest")).alias("subroot")),
                    last and last["root"])


def _run(k: int) -> tuple[str, str, str]:
    """SQL of level k of a row, as seen from slot ``c.slot`` of the lowest: the run, the bytes before the own digest, and
    the bytes up to its end."""
    run = f"substring(n.below.b{k}, c.slot DIV {FAN ** (k + 1)} * {32 * FAN} + 1, {32 * FAN})"
    own = f"c.slot DIV {FAN ** k} % {FAN}"
    return run, f"({own}) * 32", f"({own}) * 32 + 32"


def _folded() -> str:
    folded = "c.folded"
    for k in range(HEIGHT):
        run, begin, _ = _run(k)
        digest_sql = f"unhex(sha2(lower(hex(overlay({run} PLACING {folded} FROM {begin} + 1 FOR 32))), 256))"
        folded = digest_sql if k == 0 else f"if(length(n.below.b{k}) = 0, {folded}, {digest_sql})"
    return folded


def _siblings() -> str:
    return "concat(" + ", ".join(f"substring({run}, 1, {begin}), substring({run}, {end} + 1)"
                                 for run, begin, end in map(_run, range(HEIGHT))) + ")"


#: a step appends the siblings that the row above holds beside the climbing leaf, and folds the leaf's digest with them
CLIMB = f"""
WITH RECURSIVE climb(number, level, place, slot, folded, siblings, step) AS (
  SELECT number, parent_level, parent_place, slot, tested, CAST(NULL AS BINARY), 0 FROM {{leaves}}
  UNION ALL
  SELECT c.number, n.parent_level, n.parent_place, n.slot, {_folded()}, {_siblings()}, c.step + 1
  FROM climb c JOIN {{nodes}} n
  ON n.chunk = c.number DIV {CHUNK} AND n.level = c.level AND n.place = c.place)
SELECT number, IF(level IS NULL, folded, NULL) AS folded, siblings, step FROM climb LIMIT ALL"""


def climb(manifest: Manifest, tested: str) -> DataFrame:
    """``number, folded_root, proof_sha256`` of every leaf, from the digests in column ``tested`` of the leaves and the
    stored siblings."""
    leaves = manifest.leaves.select("number", "parent_level", "parent_place", "slot", F.col(tested).alias("tested"))
    chunk = lambda c: F.floor(F.col(c) / CHUNK)
    nodes = manifest.nodes.withColumn("chunk", F.explode(F.sequence(chunk("first"), chunk("last")))).drop("first", "last")
    steps = leaves.sparkSession.sql(CLIMB, leaves=leaves, nodes=nodes)
    appended = F.sort_array(F.collect_list(F.when(F.col("step") > 0, F.struct("step", "siblings"))))
    done = steps.groupBy("number").agg(F.max("folded").alias("folded"), appended.alias("appended"))
    proof = F.array_join(F.transform("appended", lambda s: F.lower(F.hex(s["siblings"]))), "")
    return done.select("number", F.lower(F.hex("folded")).alias("folded_root"), F.sha2(proof, 256).alias("proof_sha256"))


def verify(docs: DataFrame, columns: list[str], changed: dict[str, Column], group: str = "source",
           key: str = "doc_id") -> DataFrame:
    """Every row's key, leaf, subroot, root and proof as ``docs`` is, and ``folded_root`` and ``verified`` for the row
    with ``changed`` columns: the climb from its new digest by the old siblings reaches the old root, or not."""
    leaf = digest(*[F.col(f"`{c}`") for c in columns])
    tested = digest(*[changed.get(c, F.col(f"`{c}`")) for c in columns])
    rows = written(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("grp"),
                               F.unhex(leaf).alias("leaf"), F.unhex(tested).alias("tested")))
    manifest = build(rows, "grp", "key", "leaf")
    found = (manifest.leaves.select("number", "key", "leaf", "tree").join(climb(manifest, "tested"), "number")
             .join(manifest.subroots, "tree"))
    root = F.lit(manifest.root).cast("string")
    return found.select(F.col("key").alias(key), F.lower(F.hex("leaf")).alias("leaf"), "subroot", root.alias("root"),
                        "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
