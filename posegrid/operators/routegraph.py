"""Route graphs, breadth-first trees and transform cascades.

Routes meet at nodes. The graph is kept as its incidence table (one row per route and node), from
which degrees, neighbours and trees follow without listing every pair of routes at a busy node.
Subtrees are intervals of a depth-first numbering, and cascades are products along the paths (``trees``).
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.functions.names import slice_label
from posegrid.operators import trees
from posegrid.operators.poses import move_poses
from posegrid.scale import attach, checkpointed


def node_slices(markers: DataFrame, slice_seconds: float | Column) -> DataFrame:
    """Slice in which each route crosses each node: ``route_id, node_id, slice``.

    ``markers``: ``route_id, pos, name, begin_ms``. A node marked twice keeps its last entry.
    """
    width = slice_seconds if isinstance(slice_seconds, Column) else F.lit(float(slice_seconds))
    begin = markers.filter(F.col("name").startswith("start_end")).groupBy("route_id").agg(
        F.max_by(F.col("begin_ms").cast("bigint"), "pos").alias("_begin"),
        F.count(F.lit(1)).alias("n"))
    nodes = markers.filter(F.col("name").startswith("node")).withColumn(
        "node_id", F.split("name", "_").getItem(1))
    at = (F.col("begin_ms") - F.col("_begin")) / width / 1000.0
    rows = attach(nodes, begin, "route_id").withColumn(
        "slice", F.when(at >= 0, F.floor(at)).otherwise(F.ceil(at)).cast("int"))
    return rows.groupBy("route_id", "node_id").agg(F.max_by("slice", "pos").alias("slice"))


def incidence(crossings: DataFrame) -> DataFrame:
    """Crossings with the number of routes at each node."""
    degree = crossings.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_routes"))
    return attach(crossings, degree, "node_id")


def out_degree(crossings: DataFrame) -> DataFrame:
    """Outgoing edges per route, one per shared node and other route."""
    return incidence(crossings).groupBy("route_id").agg(
        F.sum(F.col("n_routes") - 1).alias("out_degree"))


def edge_totals(crossings: DataFrame) -> DataFrame:
    """Directed edges per node, counting each ordered pair of routes that cross there."""
    return crossings.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("n_routes"),
        (F.count(F.lit(1)) * (F.count(F.lit(1)) - 1)).alias("n_edges"))


def root_routes(crossings: DataFrame) -> DataFrame:
    """All routes with the largest out-degree."""
    deg = out_degree(crossings)
    top = deg.agg(F.max("out_degree").alias("_top"))
    return deg.join(F.broadcast(top), F.col("out_degree") == F.col("_top")).drop("_top")


def edges_from(crossings: DataFrame, sources: DataFrame) -> DataFrame:
    """Edges leaving the given routes: ``route_id, other_id, node_id, slice, other_slice``."""
    out = crossings.join(sources.select("route_id").distinct(), "route_id", "left_semi")
    other = crossings.select("node_id", F.col("route_id").alias("other_id"),
                             F.col("slice").alias("other_slice"))
    return out.join(other, "node_id").filter(F.col("route_id") != F.col("other_id"))


def bfs_tree(crossings: DataFrame, roots: DataFrame) -> DataFrame:
    """Breadth-first tree from each root with deterministic parents.

    A route's parent is the earliest route of the level before it in queue order; children queue
    in route order. Queue order is carried as ``path``, the array of route ranks from the root, whose
    order equals queue order within a level. Each round joins frontier to nodes and nodes to routes
    and reduces on both sides, so a busy node costs one row per route. Rounds go on until a level is
    empty. What a level reaches lies in its own level, the one before or the next.

    ``crossings`` carries ``route_rank`` (order of the routes). ``roots``: ``root, route_id``.
    """
    rank = F.col("route_rank").cast("bigint")
    ranks = crossings.groupBy("route_id").agg(F.min("route_rank").alias("route_rank"))
    tree = checkpointed(
        roots.join(ranks, "route_id").select(
            "root", "route_id", F.lit(None).cast("string").alias("parent_id"),
            rank.alias("route_rank"), F.lit(0).alias("depth"), F.array(rank).alias("path")))
    frontier = tree
    inc = crossings.select("route_id", "node_id", "route_rank")
    inc = checkpointed(inc)
    last = frontier.select("root", "route_id")
    for depth in count(1):
        out = frontier.select("root", "route_id", "path")
        at_node = attach(inc, out, "route_id").groupBy("root", "node_id").agg(
            F.min("path").alias("_parent"))
        reached = attach(inc, at_node, "node_id") \
            .groupBy("root", "route_id").agg(F.min("_parent").alias("_parent"),
                                             F.min("route_rank").alias("route_rank"))
        known = last.union(frontier.select("root", "route_id"))
        fresh = reached.join(known, ["root", "route_id"], "left_anti")
        parents = frontier.select("root", F.col("path").alias("_parent"),
                                  F.col("route_id").alias("parent_id"))
        last = frontier.select("root", "route_id")
        frontier = checkpointed(fresh.join(parents, ["root", "_parent"]).select(
            "root", "route_id", "parent_id", rank.alias("route_rank"), F.lit(depth).alias("depth"),
            F.array_append("_parent", rank).alias("path")))
        if frontier.isEmpty():
            break
        tree = tree.unionByName(frontier)
    return tree


def tree_slices(tree: DataFrame, crossings: DataFrame) -> DataFrame:
    """Tree with the slices in which parent and child cross their first shared node (string
    order)."""
    own = tree.filter("parent_id IS NOT NULL").select("root", "route_id", "parent_id").join(
        crossings.select("route_id", "node_id", F.col("slice").alias("own_slice")), "route_id")
    both = own.join(crossings.select(F.col("route_id").alias("parent_id"), "node_id",
                                     F.col("slice").alias("parent_slice")),
                    ["parent_id", "node_id"])
    first = both.groupBy("root", "route_id").agg(F.min(F.struct(
        "node_id", "parent_slice", "own_slice")).alias("_f")).select(
        "root", "route_id", F.col("_f.node_id").alias("node_id"),
        F.col("_f.parent_slice").alias("parent_slice"), F.col("_f.own_slice").alias("own_slice"))
    return tree.join(first, ["root", "route_id"], "left")


def route_tree(crossings: DataFrame, roots: DataFrame) -> DataFrame:
    return tree_slices(bfs_tree(crossings, roots), crossings)


def number_routes(tree: DataFrame) -> DataFrame:
    """A tree with ``enter`` and ``size``; children queue by ``route_rank`` where the tree has it. Trees that were
    numbered before stay as they are."""
    if {"enter", "size"} <= set(tree.columns):
        return tree
    return trees.number_tree(tree, "route_rank" if "route_rank" in tree.columns else None, ["root"])


def descendants(tree: DataFrame, starts: DataFrame) -> DataFrame:
    """All routes at or below the given routes: those whose number lies in a start's interval."""
    return trees.below(number_routes(tree), starts).select("root", "route_id")


def surviving(tree: DataFrame, failed: DataFrame) -> DataFrame:
    """Routes left after every failed edge has dropped its whole subtree."""
    return tree.join(descendants(tree, failed), ["root", "route_id"], "left_anti")


def tree_from_parents(parents: DataFrame) -> DataFrame:
    """Root, depth and subtree interval of a ``route_id, parent_id`` table (with ``route_rank``, the order of children).

    Each route has one parent. Routes on a cycle, or below a parent that is missing, hang under no root and are
    left out.
    """
    return trees.number_tree(parents, "route_rank" if "route_rank" in parents.columns else None)


# ------------------------------------------------------------------ tree document and cascade

def tree_lines(tree: DataFrame) -> DataFrame:
    """Text lines of the nested tree document, one route per block, in depth-first order.

    Indentation carries the nesting, so the document is written by a distributed sort on the routes' numbers
    instead of nesting children inside one row. Columns ``root, ord, value``.
    """
    pad = F.repeat(F.lit("  "), F.col("depth") * 2)
    rows = number_routes(tree)
    dash = F.when(F.col("depth") > 0, F.concat(F.expr("substr(repeat('  ', depth * 2), 3)"),
                                               F.lit("- "))).otherwise(F.lit(""))
    label = lambda c: F.coalesce(F.concat(F.lit("'"), slice_label(c), F.lit("'")),
                                 F.lit("null"))
    lines = F.array(
        F.concat(dash, "route_id", F.lit(":")),
        F.concat(pad, F.lit("  parent_to_own_slice: ["), label("parent_slice"), F.lit(", "),
                 label("own_slice"), F.lit("]")),
        # a route without children is its whole subtree
        F.concat(pad, F.lit("  child_node:"), F.when(F.col("size") == 1, F.lit(" null")).otherwise(F.lit(""))))
    return rows.select("root", "enter", F.posexplode(lines).alias("_no", "value")).select(
        "root", (F.col("enter") * 3 + F.col("_no")).alias("ord"), "value")


def cascade(tree: DataFrame, edges: DataFrame, root_matrix: DataFrame) -> DataFrame:
    """Transform of every route into its root's frame: the product of the matrices on its path.

    ``edges``: ``root, route_id, matrix`` moving a child into its parent; ``root_matrix``: ``root, matrix``. Routes
    below one without a matrix are left out.
    """
    tops = tree.filter("depth = 0").join(root_matrix, "root").select("root", "route_id", "parent_id", "matrix")
    steps = tree.filter("depth > 0").join(edges.select("root", "route_id", "matrix"), ["root", "route_id"]).select(
        "root", "route_id", "parent_id", "matrix")
    return trees.along_paths(tops.unionByName(steps), ["root"],
                             {"matrix": lambda above, own: L.matmul(above, own, 4)})


def rebase(main: DataFrame, local: DataFrame, own: DataFrame, keys: list[str]) -> DataFrame:
    """``T_main * T_local * T_own^-1`` per key."""
    j = main.select(*keys, F.col("matrix").alias("_m")).join(
        local.select(*keys, F.col("matrix").alias("_l")), keys).join(
        own.select(*keys, F.col("matrix").alias("_o")), keys)
    step, inverse = L.rebase_transform("_m", "_l", "_o")
    return j.withColumns({"_ml": step, "_inv": inverse}).select(
        *keys, L.matmul("_ml", "_inv", 4).alias("matrix"))


def apply_cascade(poses: DataFrame, matrices: DataFrame) -> DataFrame:
    """Move every slice of a route by the route's matrix."""
    return move_poses(attach(poses, matrices.select("route_id", "matrix"), "route_id")) \
        .drop("matrix")


def concatenated(log: DataFrame) -> DataFrame:
    """Ordered product of each scene's transform log, the latest on the left.

    ``log``: ``scene_id, seq, matrix``. Neighbouring matrices are multiplied pairwise until one is
    left, so a long log needs only a logarithmic number of rounds.
    """
    keys = ["scene_id"]
    cur = log.select(*keys, F.col("seq").cast("bigint").alias("seq"), "matrix")
    # dense numbering first, then halve
    from posegrid.scale import line, ordered
    cur = checkpointed(ordered(cur, line(keys, "seq"), position="_i")
                       .select(*keys, F.col("_i").alias("seq"), "matrix"))
    while not cur.filter("seq > 0").isEmpty():
        even = cur.filter("seq % 2 = 0").withColumn("_pair", F.col("seq") / 2)
        odd = cur.filter("seq % 2 = 1").select(*keys, ((F.col("seq") - 1) / 2).alias("_pair"),
                                               F.col("matrix").alias("_later"))
        cur = checkpointed(even.join(odd, [*keys, "_pair"], "left").select(
            *keys, F.col("_pair").cast("bigint").alias("seq"),
            F.when(F.col("_later").isNull(), F.col("matrix"))
            .otherwise(L.matmul_loop("_later", "matrix")).alias("matrix")))
    return cur.drop("seq")


def append_transform(log: DataFrame, added: DataFrame) -> DataFrame:
    """Append one matrix per scene (``scene_id, matrix, ts, note``) to a transform log."""
    last = log.groupBy("scene_id").agg(F.max("seq").alias("_last"))
    new = added.join(last, "scene_id", "left").select(
        "scene_id", (F.coalesce("_last", F.lit(-1)) + 1).alias("seq"), "matrix", "ts", "note")
    return log.unionByName(new)
