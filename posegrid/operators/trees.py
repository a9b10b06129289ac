"""Rooted trees given by parent links, by pointer doubling.

A table of nodes (``route_id``, ``parent_id``, null at a root; columns of ``scope`` keep several trees apart) gets its
depths, subtree sizes, subtree intervals and products along the paths from the root in as many rounds as the
depth has binary digits: each node points to the ancestor 1, 2, 4, ... steps up, and a round joins it with
that ancestor's row. Rows never hold lists of ancestors, so a chain of n nodes costs n rows a round.

``enter`` numbers the nodes of a tree depth first from 0, and the nodes at and below one are those with ``enter``
from its own up to ``enter + size``. What lies below some nodes follows from these intervals by a running sum.
Nodes on a cycle, or below a parent that is missing, hang under no root and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.scale import attach, checkpointed, line, ordered

#: with the column of the path above and the own one, the column of both
Joined = Callable[[Column, Column], Column]


def _moved(state: DataFrame, scope: Sequence[str], above: Sequence[str]) -> DataFrame:
    """Nodes that are not at their root yet with ``_next`` and ``_above_*`` of the node they point to."""
    up = state.select(*scope, F.col("route_id").alias("_up"), F.col("_up").alias("_next"),
                      *[F.col(c).alias(f"_above_{c}") for c in above])
    return attach(state.where("_up IS NOT NULL"), up, [*scope, "_up"])


def along_paths(nodes: DataFrame, scope: Sequence[str], joined: Mapping[str, Joined]) -> DataFrame:
    """``*scope, route_id`` and each column of ``joined`` put together along the path from the root to the node.

    ``nodes``: ``*scope, route_id, parent_id`` and these columns, each node's own part. The parts need not commute.
    """
    carried = list(joined)
    state = checkpointed(nodes.select(*scope, "route_id", F.col("parent_id").alias("_up"), *carried))
    waiting = None
    while True:
        now = state.where("_up IS NOT NULL").count()
        # every depth below the deepest has nodes, so only cycles stay as many as they were
        if now in (0, waiting):
            return state.where("_up IS NULL").drop("_up")
        waiting = now
        done = state.where("_up IS NULL")
        state = checkpointed(done.unionByName(_moved(state, scope, carried).select(
            *scope, "route_id", F.col("_next").alias("_up"),
            *[joined[c](F.col(f"_above_{c}"), F.col(c)).alias(c) for c in carried])))


def subtree_sizes(nodes: DataFrame, scope: Sequence[str]) -> DataFrame:
    """``*scope, route_id, size``: how many nodes are at or below each node of trees without cycles.

    After k rounds a node has counted those less than 2^k steps below; each pointer then hands its count on."""
    state = checkpointed(nodes.select(*scope, "route_id", F.col("parent_id").alias("_up"),
                                      F.lit(1).cast("bigint").alias("size")))
    while not state.where("_up IS NOT NULL").isEmpty():
        given = state.where("_up IS NOT NULL").groupBy(*scope, F.col("_up").alias("route_id")).agg(
            F.sum("size").alias("_given"))
        pointers = state.where("_up IS NULL").unionByName(_moved(state, scope, []).select(
            *scope, "route_id", F.col("_next").alias("_up"), "size"))
        state = checkpointed(attach(pointers, given, [*scope, "route_id"], "left").select(
            *scope, "route_id", "_up", (F.col("size") + F.coalesce("_given", F.lit(0))).alias("size")))
    return state.drop("_up")


def number_tree(nodes: DataFrame, rank: str | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """``nodes`` with ``root, depth, enter, size``. Children of a node follow each other by ``rank``, a whole number
    that tells them apart, or by a hash of their id."""
    scope = list(scope)
    new = ["root", "depth", "enter", "size"]
    kept = nodes.drop(*[c for c in new if c not in scope])
    links = kept.withColumns({"_root": F.col("route_id"), "_depth": F.col("parent_id").isNotNull().cast("int")})
    paths = along_paths(links, scope, {"_root": lambda above, own: above, "_depth": lambda above, own: above + own})
    rooted = checkpointed(kept.join(paths, [*scope, "route_id"]))
    sized = rooted.join(subtree_sizes(rooted, scope), [*scope, "route_id"])
    if rank:
        siblings = line([*scope, "parent_id"], rank)
    else:
        sized = sized.withColumn("_hash", F.xxhash64("route_id"))
        siblings = line([*scope, "parent_id"], ("_hash", "route_id"), float(1 << 52))
    before = ordered(sized.where("parent_id IS NOT NULL"), siblings, running={"_upto": "size"})
    steps = before.select(*sized.columns, (1 + F.col("_upto") - F.col("size")).alias("enter")).unionByName(
        sized.where("parent_id IS NULL").withColumn("enter", F.lit(0).cast("bigint")))
    entered = along_paths(steps, scope, {"enter": lambda above, own: above + own})
    # a root's own id names its tree unless the scope does
    root = [] if "root" in scope else [F.col("_root").alias("root")]
    return sized.join(entered, [*scope, "route_id"]).select(
        *[c for c in nodes.columns if c not in new or c in scope], *root, F.col("_depth").alias("depth"), "enter", "size")


def below(tree: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of a numbered ``tree`` at or below the nodes of ``starts`` (``root, route_id``).

    Starts open and close their intervals on the line of ``enter``; a node is below one if more were opened than
    closed. Starts below each other, or named twice, make no difference."""
    spans = tree.join(starts.select("root", "route_id").distinct(), ["root", "route_id"], "left_semi")
    marks = spans.select("root", F.explode(F.array(
        F.struct(F.col("enter").alias("_at"), F.lit(1).alias("_open")),
        F.struct((F.col("enter") + F.col("size")).alias("_at"), F.lit(-1).alias("_open")))).alias("_m"))
    marks = marks.select("root", "_m.*").groupBy("root", "_at").agg(F.sum("_open").alias("_open"))
    both = tree.withColumns({"_at": F.col("enter"), "_open": F.lit(0).cast("bigint"), "_kind": F.lit(1)}).unionByName(
        marks.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    summed = ordered(both, line("root", ("_at", "_kind")), running={"_covers": "_open"})
    return summed.where("_kind = 1 AND _covers > 0").select(*tree.columns)
