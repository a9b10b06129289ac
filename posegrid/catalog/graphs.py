"""Queries on route graphs, trees, cascades and validity rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from posegrid.catalog import views as V
from posegrid.catalog.register import query
from posegrid.functions import linalg as L
from posegrid.operators import frames as FR
from posegrid.operators import quality as Q
from posegrid.operators import routegraph as RG

W = V.with_views


# ------------------------------------------------------------------ graph

@query("w17_node_slices", W(V.MARKERS, body="""
 SELECT n.route_id, n.node_id, CAST(max_by(trunc((n.begin_ms - s.begin_ms) / 43200 / 1000.0), n.pos) AS INTEGER) AS slice
 FROM nodes n JOIN spans s USING (route_id) GROUP BY 1, 2"""))
def node_slices(spark, d):
    return RG.node_slices(V.markers(spark, d), 43200)


@query("j13_g01_incidence", W(V.CROSSINGS, body="""
 SELECT route_id, node_id, slice, count(*) OVER (PARTITION BY node_id) AS n_routes FROM crossings"""))
def incidence(spark, d):
    return RG.incidence(V.crossings(spark, d)).select("route_id", "node_id", "slice", "n_routes")


@query("j13_edge_totals", W(V.CROSSINGS, body="""
 SELECT a.node_id, any_value(n) AS n_routes, count(*) FILTER (WHERE a.route_id <> b.route_id) AS n_edges
 FROM crossings a JOIN crossings b USING (node_id)
 JOIN (SELECT node_id, count(*) AS n FROM crossings GROUP BY 1) USING (node_id) GROUP BY 1"""))
def edge_totals(spark, d):
    return RG.edge_totals(V.crossings(spark, d))


@query("a16_out_degree", W(V.CROSSINGS, body="""
 SELECT a.route_id, count(*) FILTER (WHERE b.route_id <> a.route_id) AS out_degree
 FROM crossings a JOIN crossings b USING (node_id) GROUP BY 1"""))
def out_degree(spark, d):
    return RG.out_degree(V.crossings(spark, d))


ROOTS = """deg AS (SELECT a.route_id, a.route_rank, count(*) AS deg FROM crossings a JOIN crossings b
   ON a.node_id = b.node_id AND a.route_id <> b.route_id GROUP BY 1, 2),
 root AS (SELECT route_id, route_rank FROM deg WHERE deg = (SELECT max(deg) FROM deg) ORDER BY route_rank LIMIT 1)"""


def _root(spark, d):
    c = V.crossings(spark, d)
    ranks = c.groupBy("route_id").agg(F.min("route_rank").alias("route_rank"))
    first = RG.root_routes(c).join(ranks, "route_id").groupBy(F.lit(1).alias("one")).agg(
        F.min_by("route_id", "route_rank").alias("root"))
    return first.select("root", F.col("root").alias("route_id"))


@query("a16_root_routes", W(V.CROSSINGS, ROOTS, body="""
 SELECT route_id, deg AS out_degree FROM deg WHERE deg = (SELECT max(deg) FROM deg)"""))
def root_routes(spark, d):
    return RG.root_routes(V.crossings(spark, d)).select("route_id", "out_degree")


@query("j13_edges_from_root", W(V.CROSSINGS, ROOTS, body="""
 SELECT a.route_id, b.route_id AS other_id, a.node_id, a.slice, b.slice AS other_slice
 FROM crossings a JOIN root USING (route_id) JOIN crossings b ON a.node_id = b.node_id AND a.route_id <> b.route_id"""))
def edges_from_root(spark, d):
    return RG.edges_from(V.crossings(spark, d), _root(spark, d)).select(
        "route_id", "other_id", "node_id", "slice", "other_slice")


LEVELS = """l0 AS (SELECT route_id, NULL::VARCHAR AS parent_id, 0 AS depth, [CAST(route_rank AS BIGINT)] AS path FROM root),
 l1 AS (SELECT c.route_id, arg_min(p.route_id, p.path) AS parent_id, 1 AS depth,
     list_append(min(p.path), CAST(any_value(c.route_rank) AS BIGINT)) AS path
   FROM l0 p JOIN crossings q ON q.route_id = p.route_id JOIN crossings c ON c.node_id = q.node_id
   WHERE c.route_id NOT IN (SELECT route_id FROM l0) GROUP BY 1),
 l2 AS (SELECT c.route_id, arg_min(p.route_id, p.path) AS parent_id, 2 AS depth,
     list_append(min(p.path), CAST(any_value(c.route_rank) AS BIGINT)) AS path
   FROM l1 p JOIN crossings q ON q.route_id = p.route_id JOIN crossings c ON c.node_id = q.node_id
   WHERE c.route_id NOT IN (SELECT route_id FROM l0 UNION ALL SELECT route_id FROM l1) GROUP BY 1),
 l3 AS (SELECT c.route_id, arg_min(p.route_id, p.path) AS parent_id, 3 AS depth,
     list_append(min(p.path), CAST(any_value(c.route_rank) AS BIGINT)) AS path
   FROM l2 p JOIN crossings q ON q.route_id = p.route_id JOIN crossings c ON c.node_id = q.node_id
   WHERE c.route_id NOT IN (SELECT route_id FROM l0 UNION ALL SELECT route_id FROM l1 UNION ALL SELECT route_id FROM l2)
   GROUP BY 1),
 tree AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)"""


@query("g02_g03_route_tree", W(V.CROSSINGS, ROOTS, LEVELS, """
 shared AS (SELECT t.route_id, o.node_id, o.slice AS own_slice, p.slice AS parent_slice,
   row_number() OVER (PARTITION BY t.route_id ORDER BY o.node_id) AS k
   FROM tree t JOIN crossings o ON o.route_id = t.route_id
   JOIN crossings p ON p.route_id = t.parent_id AND p.node_id = o.node_id)""", body="""
 SELECT t.route_id, t.parent_id, t.depth, array_to_string(t.path, '/') AS path, s.node_id, s.parent_slice, s.own_slice
 FROM tree t LEFT JOIN shared s ON s.route_id = t.route_id AND s.k = 1"""))
def route_tree(spark, d):
    c = V.crossings(spark, d)
    return RG.route_tree(c, _root(spark, d)).select(
        "route_id", "parent_id", "depth", F.array_join(F.col("path").cast("array<string>"), "/").alias("path"),
        "node_id", "parent_slice", "own_slice")


# ------------------------------------------------------------------ subtrees (ternary heap of routes)

def _heap(spark, d):
    u = V.table(spark, d, "events").select("user_id").distinct()
    parent = F.when(F.col("user_id") > 0, F.floor((F.col("user_id") - 1) / 3).cast("string"))
    return RG.tree_from_parents(u.select(F.col("user_id").cast("string").alias("route_id"),
                                         parent.alias("parent_id"), F.col("user_id").alias("route_rank")))


HEAP = """users AS (SELECT DISTINCT user_id AS u FROM events),
 down AS (SELECT u AS top, u FROM users UNION ALL
   SELECT d.top, c.u FROM down d JOIN users c ON c.u > 0 AND (c.u - 1) // 3 = d.u)"""


def _failed(tree):
    return tree.filter(F.col("route_id").cast("bigint") % 17 == 5).select("root", "route_id")


@query("g04_descendants", W(HEAP, recursive=True, body="""
 SELECT DISTINCT CAST(u AS VARCHAR) AS route_id FROM down WHERE top % 17 = 5
  AND u IN (SELECT u FROM down WHERE top = 0)"""))
def descendants(spark, d):
    t = _heap(spark, d)
    return RG.descendants(t, _failed(t)).select("route_id")


@query("g05_surviving_routes", W(HEAP, recursive=True, body="""
 SELECT CAST(u AS VARCHAR) AS route_id FROM down WHERE top = 0
  AND u NOT IN (SELECT u FROM down WHERE top % 17 = 5)"""))
def surviving(spark, d):
    t = _heap(spark, d)
    return RG.surviving(t, _failed(t)).select("route_id")


WALK = """walk AS (SELECT u, 0 AS depth, [u] AS path FROM users WHERE u = 0 UNION ALL
   SELECT c.u, depth + 1, list_append(path, c.u) FROM walk d JOIN users c ON c.u > 0 AND (c.u - 1) // 3 = d.u)"""


@query("g04_tree_intervals", W(HEAP, WALK, recursive=True, body="""
 SELECT CAST(u AS VARCHAR) AS route_id, '0' AS root, depth, row_number() OVER (ORDER BY path) - 1 AS enter, n AS size
 FROM walk JOIN (SELECT top AS u, count(*) AS n FROM down GROUP BY 1) USING (u)"""))
def tree_intervals(spark, d):
    return _heap(spark, d).select("route_id", "root", "depth", "enter", "size")


@query("k10_tree_lines", W(HEAP, WALK, """
 numbered AS (SELECT *, row_number() OVER (ORDER BY path) - 1 AS enter, repeat('    ', depth) AS pad, chr(39) AS q,
   EXISTS (SELECT 1 FROM users c WHERE c.u > 0 AND (c.u - 1) // 3 = walk.u) AS inner_node FROM walk)""", recursive=True, body="""
 SELECT '0' AS root, enter * 3 AS ord, CASE WHEN depth > 0 THEN substr(pad, 3) || '- ' ELSE '' END || u || ':' AS value FROM numbered
 UNION ALL SELECT '0', enter * 3 + 1, pad || '  parent_to_own_slice: [' || CASE WHEN u = 0 THEN 'null'
   ELSE q || printf('%03d', u % 7) || q END || ', ' || q || printf('%03d', u % 11) || q || ']' FROM numbered
 UNION ALL SELECT '0', enter * 3 + 2, pad || '  child_node:' || CASE WHEN inner_node THEN '' ELSE ' null' END FROM numbered"""))
def tree_lines(spark, d):
    u = F.col("route_id").cast("int")
    t = _heap(spark, d).withColumns({"parent_slice": F.when(u > 0, u % 7), "own_slice": u % 11})
    return RG.tree_lines(t)


#: turn by ``k`` degrees about (0.6, 0, 0.8), scaled by 1 + k % 3 / 10, as cells of SQL row by row; then the offset
_S, _C = "sin(radians(k % 360))", "cos(radians(k % 360))"
_TURN = [f"1 - (1 - {_C}) * 0.64", f"-0.8 * {_S}", f"(1 - {_C}) * 0.48", f"0.8 * {_S}", _C, f"-0.6 * {_S}",
         f"(1 - {_C}) * 0.48", f"0.6 * {_S}", f"1 - (1 - {_C}) * 0.36"]
_STEP = [*[c for i in range(3) for c in (*[f"(1 + k % 3 / 10.0) * ({t})" for t in _TURN[3 * i:3 * i + 3]],
                                         ("CAST(k % 5 AS DOUBLE)", "0.0", "1.0")[i])], "0.0", "0.0", "0.0", "1.0"]
CELLS = [f"{i}{j}" for i in range(4) for j in range(4)]


def _step(k):
    return L.compose(1 + k % 3 / 10.0, (k % 360).cast("double"), L.vec(0.6, 0, 0.8), L.vec(k % 5, 0, 1))


STEP = "steps AS (SELECT u, " + ", ".join(f"{e} AS e{c}" for c, e in zip(CELLS, _STEP)) + \
    " FROM (SELECT u, u AS k FROM users))"
CASCADE = "turned AS (SELECT 0::BIGINT AS u, " + ", ".join(
    f"{float(c[0] == c[1])}::DOUBLE AS m{c}" for c in CELLS) + " UNION ALL SELECT s.u, " + ", ".join(
    " + ".join(f"m{c[0]}{k} * e{k}{c[1]}" for k in range(4)) for c in CELLS) + \
    " FROM turned t JOIN steps s ON s.u > 0 AND (s.u - 1) // 3 = t.u)"


@query("g06_cascade", W(HEAP, STEP, CASCADE, recursive=True, body="SELECT CAST(u AS VARCHAR) AS route_id, " + V.sql_round(
    5, **{f"m{c}": f"m{c}" for c in CELLS}) + " FROM turned"))
def cascade(spark, d):
    t = _heap(spark, d)
    edge = t.filter("depth > 0").select("root", "route_id", _step(F.col("route_rank")).alias("matrix"))
    start = t.filter("depth = 0").select("root", L.to_mat4(1.0, L.identity3(), L.vec(0, 0, 0)).alias("matrix"))
    out = RG.cascade(t, edge, start)
    return V.rounded(out.select("route_id", *[L.entry("matrix", int(c[0]), int(c[1]), 4).alias(f"m{c}") for c in CELLS]),
                     5, *[f"m{c}" for c in CELLS])


@query("g06_apply_cascade", W(V.POSES, "steps AS (SELECT k, " + ", ".join(
    f"{e} AS e{c}" for c, e in zip(CELLS[:12], _STEP)) + " FROM (SELECT DISTINCT route_id AS k FROM poses))", body=f"""
 SELECT route_id, pose_key, {V.sql_round(6, **{a: f"e{i}0 * x + e{i}1 * y + e{i}2 * z + e{i}3" for i, a in enumerate("xyz")},
   **{f"r{i}{j}": f"e{j}{i} / (1 + k % 3 / 10.0)" for i in range(3) for j in range(3)})}
 FROM poses JOIN steps ON k = route_id"""))
def apply_cascade(spark, d):
    p = V.poses(spark, d)
    matrices = p.select("route_id").distinct().withColumn("matrix", _step(F.col("route_id")))
    held = p.select("route_id", "pose_key", L.vec("x", "y", "z").alias("center"), L.identity3().alias("rotation"))
    out = RG.apply_cascade(held, matrices)
    cells = [f"r{i}{j}" for i in range(3) for j in range(3)]
    return V.rounded(out.select("route_id", "pose_key", *[F.col("center")[a].alias(a) for a in L.AXES], *[
        L.entry("rotation", i, j).alias(f"r{i}{j}") for i in range(3) for j in range(3)]), 6, *L.AXES, *cells)


@query("a10_concatenated", W(V.POSES, body=f"""
 SELECT route_id AS scene_id, {V.sql_round(4, scale="exp(sum(ln(1 + seq % 3 / 100.0)))")} FROM poses GROUP BY 1"""))
def concatenated(spark, d):
    p = V.poses(spark, d)
    log = p.select(F.col("route_id").alias("scene_id"), F.col("pose_key").alias("seq"), L.compose(
        1 + F.col("seq") % 3 / 100.0, (F.col("seq") % 360).cast("double"), L.vec(0, 0, 1),
        L.vec("y", 0, 1)).alias("matrix"))
    out = RG.concatenated(log)
    return V.rounded(out.select("scene_id", L.mat4_scale("matrix").alias("scale")), 4, "scale")


@query("p35_rebase", W(V.POSES, body=f"""
 SELECT route_id, pose_key, {V.sql_round(6, scale="2.0 * 1.5 / (1 + pose_key % 4)", off_x="x * 2 - 3.0 * y / (1 + pose_key % 4)")}
 FROM poses"""))
def rebase(spark, d):
    p = V.poses(spark, d)
    s = 1 + F.col("pose_key") % 4
    keys = ["route_id", "pose_key"]
    one = lambda scale, off: p.select(*keys, L.to_mat4(scale, L.identity3(), off).alias("matrix"))
    out = RG.rebase(one(2.0, L.vec(0, 0, 0)), one(1.5, L.vec("x", 0, 0)), one(s, L.vec("y", 0, 0)), keys)
    return V.rounded(out.select(*keys, L.mat4_scale("matrix").alias("scale"),
                                L.mat4_offset("matrix")["x"].alias("off_x")), 6, "scale", "off_x")


# ------------------------------------------------------------------ joins by route and set operations

@query("j21_route_anchor_marker", W(V.MARKERS, body="""
 SELECT s.route_id, s.begin_ms, s.end_ms, f.n_fixes, n.n_nodes FROM spans s
 JOIN (SELECT user_id AS route_id, count(*) AS n_fixes FROM events WHERE event_type = 'view' GROUP BY 1) f USING (route_id)
 JOIN (SELECT route_id, count(*) AS n_nodes FROM nodes GROUP BY 1) n USING (route_id)"""))
def route_anchor_marker(spark, d):
    m = V.markers(spark, d)
    span = m.filter("name = 'start_end'").select("route_id", "begin_ms", "end_ms")
    nodes = m.filter("name <> 'start_end'").groupBy("route_id").agg(F.count(F.lit(1)).alias("n_nodes"))
    fixes = V.fixes(spark, d).groupBy("route_id").agg(F.count(F.lit(1)).alias("n_fixes"))
    return span.join(fixes, "route_id").join(nodes, "route_id")


@query("u02_node_intersection", W(V.CROSSINGS, body="""
 SELECT DISTINCT node_id FROM crossings WHERE CAST(route_id AS BIGINT) % 2 = 0
 INTERSECT SELECT node_id FROM crossings WHERE CAST(route_id AS BIGINT) % 5 = 1"""))
def node_intersection(spark, d):
    c = V.crossings(spark, d)
    r = F.col("route_id").cast("bigint")
    return Q.set_intersection(c.filter(r % 2 == 0).select("node_id").distinct(), c.filter(r % 5 == 1), "node_id")


@query("u03_k11_completion_status", """
 SELECT CAST(user_id AS VARCHAR) AS node, CASE WHEN e > 0 THEN 'failed' ELSE 'complete' END AS status,
   CASE WHEN e > 0 THEN 'error' END AS reason FROM (
   SELECT user_id, count(*) FILTER (WHERE event_type = 'error' AND value > 60) AS e FROM events GROUP BY 1)""")
def completion_status(spark, d):
    e = V.table(spark, d, "events").withColumn("node", F.col("user_id").cast("string"))
    failed = e.filter("event_type = 'error' AND value > 60").select("node").distinct() \
        .withColumn("reason", F.lit("error"))
    return Q.completion_status(e.select("node").distinct(), failed)


@query("u03_node_difference", """
 SELECT DISTINCT user_id FROM events EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 60""")
def node_difference(spark, d):
    e = V.table(spark, d, "events")
    return Q.set_difference(e.select("user_id").distinct(), e.filter("event_type = 'error' AND value > 60"), "user_id")


@query("o01_u01_frames_in_time_order", W(V.POSES, body="""
 SELECT route_id, seq, row_number() OVER (PARTITION BY route_id ORDER BY ms, seq) - 1 AS nth FROM (
   SELECT route_id, seq, ms FROM poses UNION ALL SELECT user_id, event_id, epoch_us(ts) // 1000 FROM events
   WHERE event_type = 'view')"""))
def frames_in_time_order(spark, d):
    a = V.poses(spark, d).select("route_id", "seq", "ms")
    both = a.unionByName(V.fixes(spark, d).select("route_id", "seq", "ms"))
    from posegrid.scale import line, ordered
    out = ordered(both, line("route_id", ("ms", "seq"), float(1 << 30)), position="nth")
    return out.select("route_id", "seq", "nth")


# ------------------------------------------------------------------ rules

@query("f17_marker_span", W(V.MARKERS, body="""
 SELECT n.route_id, bool_and(n.begin_ms BETWEEN s.begin_ms AND s.end_ms) AS is_valid
 FROM nodes n JOIN spans s USING (route_id) GROUP BY 1"""))
def marker_span(spark, d):
    return Q.marker_span(V.markers(spark, d))


REQUIRED = """required AS (SELECT DISTINCT p_brand AS tag, p_type AS label, 4 + p_brand[-1:]::INTEGER % 3 AS expected FROM part),
 found AS (SELECT p_brand AS tag, p_type AS label, count(*) AS found FROM part GROUP BY 1, 2)"""


@query("f18_count_mismatches", W(REQUIRED, body="""
 SELECT tag, label, expected, coalesce(found, 0) AS found FROM required LEFT JOIN found USING (tag, label)
 WHERE coalesce(found, 0) <> expected"""))
def count_mismatches(spark, d):
    p = V.table(spark, d, "part").select(F.col("p_brand").alias("tag"), F.col("p_type").alias("label"), "p_size")
    need = p.select("tag", "label").distinct().withColumn(
        "expected", 4 + F.substring("tag", -1, 1).cast("int") % 3)
    return Q.count_mismatches(need, p)


@query("f19_validation_rules", W(V.SHOTS, V.CAPTURES, body="""
 SELECT 'video' AS label, min(CAST(capture_id AS VARCHAR)) AS first_failing, count(*) AS n_failing FROM captures
 WHERE ss > "to" OR ss < 0 OR "to" > length
 UNION ALL SELECT 'image', min(filename), count(*) FROM shots WHERE view_key % 100 = 7"""))
def validation_rules(spark, d):
    tables = {"video": V.captures(spark, d), "image": V.shots(spark, d)}
    return Q.run_rules(tables, {
        "video": lambda t: FR.window_violations(t).select(F.col("capture_id").cast("string").alias("path")),
        "image": lambda t: t.filter("view_key % 100 = 7").select(F.col("filename").alias("path"))})


LISTING = """listing AS (SELECT c_nationkey AS repository, c_name AS path,
   CASE WHEN c_custkey % 60 = 3 THEN ['marker', 'video'] ELSE ['video'] END AS labels FROM customer)"""


def _listing(spark, d):
    return V.table(spark, d, "customer").select(
        F.col("c_nationkey").alias("repository"), F.col("c_name").alias("path"),
        F.when(F.col("c_custkey") % 60 == 3, F.array(F.lit("marker"), F.lit("video")))
        .otherwise(F.array(F.lit("video"))).alias("labels"))


@query("f27_not_exactly_one", W(LISTING, body="""
 SELECT r.repository, coalesce(n, 0) AS n_files FROM (SELECT DISTINCT repository FROM listing) r LEFT JOIN (
   SELECT repository, count(*) AS n FROM listing WHERE list_contains(labels, 'marker') GROUP BY 1) USING (repository)
 WHERE coalesce(n, 0) <> 1"""))
def not_exactly_one(spark, d):
    ls = _listing(spark, d)
    return Q.not_exactly_one(ls, "marker", ls.select("repository").distinct())


@query("f28_pick_by_pattern", W(LISTING, body="""
 SELECT repository, arg_min(path, (k, path)) AS path FROM (
   SELECT *, CASE WHEN regexp_matches(path, '77$') THEN 0 WHEN regexp_matches(path, '[05]1$') THEN 1 END AS k FROM listing)
 WHERE k IS NOT NULL GROUP BY 1"""))
def pick_by_pattern(spark, d):
    return Q.pick_by_pattern(_listing(spark, d), ["77$", "[05]1$"])


@query("j21_labelled_file", W(LISTING, body="""
 SELECT repository, min(path) AS path FROM listing WHERE list_contains(labels, 'marker') GROUP BY 1 HAVING count(*) = 1"""))
def labelled_file(spark, d):
    return Q.labelled_file(_listing(spark, d), "marker")
