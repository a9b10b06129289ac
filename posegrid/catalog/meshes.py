"""Queries on vertices, faces and segments."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from posegrid.catalog import views as V
from posegrid.catalog.register import query
from posegrid.functions import linalg as L
from posegrid.operators import mesh as ME

W = V.with_views
R = V.sql_round
XYZ = L.AXES


@query("p21_p22_vertex_attributes", W(V.MESH, body=f"""
 SELECT vid, red > green AND red > blue AS is_flat, -1.0::DOUBLE AS theta, {R(6, phi="atan2(ny, nx)")} FROM vertices"""))
def vertex_attributes(spark, d):
    out = ME.curvature_features(V.vertices(spark, d)).select("vid", "is_flat", "theta", "phi")
    return V.rounded(out, 6, "phi")


@query("p38_p11_transform_mesh", W(V.MESH, body=f"""
 SELECT vid, {R(6, x="-(2 * z + 1)", y="-(2 * y - 1)", z="-2 * x + 3")} FROM vertices"""))
def transform_mesh(spark, d):
    v = V.vertices(spark, d)
    t = v.select("mesh_id").distinct().withColumn("matrix", L.compose(2.0, 90.0, L.vec(0, 1, 0), L.vec(1, -1, 3)))
    out = ME.mirror_xy(ME.transform_vertices(v, t)).select("vid", *XYZ)
    return V.rounded(out, 6, *XYZ)


@query("f14_drop_sparse_vertices", W(V.MESH, """
 lim AS (SELECT mesh_id, quantile_cont(density, 0.2) * 0.9 AS cut FROM vertices GROUP BY 1),
 kept AS (SELECT mesh_id, vid FROM vertices JOIN lim USING (mesh_id) WHERE density >= cut)""", body="""
 SELECT 'vertex' AS kind, vid AS id FROM kept UNION ALL
 SELECT 'face', fid FROM faces f WHERE v1 IN (SELECT vid FROM kept) AND v2 IN (SELECT vid FROM kept)
   AND v3 IN (SELECT vid FROM kept)"""))
def drop_sparse_vertices(spark, d):
    v, f = ME.drop_sparse_vertices(V.vertices(spark, d), V.faces(spark, d), 0.2, 0.9)
    return v.select(F.lit("vertex").alias("kind"), F.col("vid").alias("id")).unionByName(
        f.select(F.lit("face").alias("kind"), F.col("fid").alias("id")))


BOXES = """boxes AS (SELECT mesh_id, fid, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1
   FROM cv GROUP BY 1, 2)"""


@query("f15_cut_floor", W(V.MESH, BOXES, body="""
 SELECT b.mesh_id, b.fid FROM boxes b JOIN (
   SELECT mesh_id, min(y) + 0.3 * (max(y) - min(y)) AS cut FROM vertices GROUP BY 1) USING (mesh_id) WHERE y0 >= cut"""))
def cut_floor(spark, d):
    return ME.cut_floor(V.faces(spark, d), V.vertices(spark, d), 0.3).select("mesh_id", "fid")


@query("f16_faces_in_box", W(V.MESH, BOXES, body="""
 SELECT mesh_id, fid FROM boxes WHERE x0 > -0.2 AND x1 < 0.25 AND y0 > -0.2 AND y1 < 0.25 AND z0 > -0.2 AND z1 < 0.25"""))
def faces_in_box(spark, d):
    v = V.vertices(spark, d)
    box = v.select("mesh_id").distinct().withColumns({
        **{f"min_{a}": F.lit(-0.2) for a in XYZ}, **{f"max_{a}": F.lit(0.25) for a in XYZ}})
    return ME.faces_in_box(V.faces(spark, d), v, box).select("mesh_id", "fid")


@query("j16_face_normals", W(V.MESH, V.NORMALS, body=f"""
 SELECT mesh_id, fid, {R(6, nx="fnx", ny="fny", nz="fnz")} FROM normals"""))
def face_normals(spark, d):
    n = ME.face_normals(V.faces(spark, d), V.vertices(spark, d))
    out = n.select("mesh_id", "fid", *[F.col("normal")[a].alias(f"n{a}") for a in XYZ])
    return V.rounded(out, 6, "nx", "ny", "nz")


@query("j17_neighbour_counts", W(V.MESH, body="""
 SELECT a.mesh_id, a.fid, count(*) FILTER (WHERE b.fid <> a.fid) AS n_neighbours FROM edges a JOIN edges b USING (mesh_id, ea, eb)
 GROUP BY 1, 2"""))
def neighbour_counts(spark, d):
    return ME.neighbour_counts(V.faces(spark, d))


@query("j17_neighbours_of_first_faces", W(V.MESH, body="""
 SELECT a.mesh_id, a.fid, b.fid AS nbr, a.ea, a.eb FROM edges a JOIN edges b USING (mesh_id, ea, eb)
 JOIN (SELECT mesh_id, min(fid) AS fid FROM edges GROUP BY 1) w ON w.mesh_id = a.mesh_id AND w.fid = a.fid
 WHERE b.fid <> a.fid"""))
def neighbours_of_first_faces(spark, d):
    faces = V.faces(spark, d)
    return ME.neighbours_of(faces, faces.groupBy("mesh_id").agg(F.min("fid").alias("fid")))


@query("j17_face_links", W(V.MESH, body="""
 SELECT DISTINCT mesh_id, fid AS u, v FROM edges JOIN (SELECT mesh_id, ea, eb, min(fid) AS v FROM edges GROUP BY ALL)
 USING (mesh_id, ea, eb) WHERE fid > v"""))
def face_links(spark, d):
    return ME.face_links(V.faces(spark, d))


@query("j18_vertex_flat_faces", W(V.MESH, """
 flat AS (SELECT mesh_id, fid FROM cv GROUP BY 1, 2 HAVING bool_and(red >= green AND red >= 60))""", body="""
 SELECT mesh_id, vid, min(fid) AS fid FROM corners JOIN flat USING (mesh_id, fid) GROUP BY 1, 2"""))
def vertex_flat_faces(spark, d):
    v = V.vertices(spark, d)
    painted = v.withColumns({"green": F.when((F.col("red") >= F.col("green")) & (F.col("red") >= 60), 0)
                             .otherwise(255), "blue": F.lit(0), "red": F.lit(100)})
    return ME.vertex_flat_faces(painted, V.faces(spark, d))


@query("a11_bounding_box", W(V.MESH, body=f"""
 SELECT mesh_id, count(DISTINCT fid) AS size, {R(6, min_x="min(x) - (max(x) - min(x)) * 0.1 / 2",
   max_x="max(x) + (max(x) - min(x)) * 0.1 / 2", min_z="min(z) - (max(z) - min(z)) * 0.1 / 2")} FROM cv GROUP BY 1"""))
def bounding_box(spark, d):
    out = ME.bounding_box(V.faces(spark, d), V.vertices(spark, d), 0.1).select(
        "mesh_id", "size", "min_x", "max_x", "min_z")
    return V.rounded(out, 6, "min_x", "max_x", "min_z")


@query("a12_mean_aligned_normal", W(V.MESH, V.NORMALS, """
 lim AS (SELECT mesh_id, avg(fny) AS m, stddev_pop(fny) AS s FROM normals GROUP BY 1),
 sums AS (SELECT mesh_id, sum(fnx) AS sx, sum(fny) AS sy, sum(fnz) AS sz FROM normals JOIN lim USING (mesh_id)
   WHERE abs(fny - m) < 1.5 * s GROUP BY 1)""", body=f"""
 SELECT mesh_id, {R(6, nx="sx / sqrt(sx*sx+sy*sy+sz*sz)", ny="sy / sqrt(sx*sx+sy*sy+sz*sz)",
   axis_dot="sy / sqrt(sx*sx+sy*sy+sz*sz)")} FROM sums"""))
def mean_aligned_normal(spark, d):
    n = ME.face_normals(V.faces(spark, d), V.vertices(spark, d))
    out = ME.mean_aligned_normal(n, 1.5)
    out = out.select("mesh_id", F.col("mean_normal.x").alias("nx"), F.col("mean_normal.y").alias("ny"), "axis_dot")
    return V.rounded(out, 6, "nx", "ny", "axis_dot")


@query("a13_extents", W(V.MESH, body=f"""
 SELECT mesh_id, count(*) AS n, {R(6, dx="max(x) - min(x)", dy="max(y) - min(y)", dz="max(z) - min(z)", min_y="min(y)",
   diagonal="sqrt((max(x)-min(x))**2 + (max(y)-min(y))**2 + (max(z)-min(z))**2)")} FROM vertices GROUP BY 1"""))
def extents(spark, d):
    out = ME.extents(V.vertices(spark, d))
    return V.rounded(out, 6, "dx", "dy", "dz", "min_y", "diagonal")


SEGMENTS = """seg AS (SELECT f.mesh_id, f.fid, v.label AS segment FROM faces f JOIN vertices v ON v.vid = f.v1),
 summ AS (SELECT mesh_id, segment, count(DISTINCT fid) AS size, min(x) AS min_x, max(y) AS max_y
   FROM cv JOIN seg USING (mesh_id, fid) GROUP BY 1, 2 HAVING count(DISTINCT fid) > 4),
 seeds AS (SELECT mesh_id, segment, min(fid) AS fid FROM seg GROUP BY 1, 2)"""


def _summary(spark, d):
    f, v = V.faces(spark, d), V.vertices(spark, d)
    seg = f.join(v.select("mesh_id", F.col("vid").alias("v1"), F.col("label").alias("segment")),
                 ["mesh_id", "v1"]).select("mesh_id", "fid", "segment")
    seeds = seg.groupBy("mesh_id", "segment").agg(F.min("fid").alias("fid"))
    normals = ME.face_normals(f, v).select("mesh_id", "fid", "normal")
    seeds = seeds.join(normals, ["mesh_id", "fid"]).select("mesh_id", "segment", "normal")
    return ME.segment_summary(f, v, seg, seeds, 0.0, 4)


@query("a14_f23_f24_segment_summary", W(V.MESH, V.NORMALS, SEGMENTS, body=f"""
 SELECT mesh_id, segment, size, CASE WHEN size > 10 THEN 'big' WHEN size > 7 THEN 'medium' ELSE 'small' END AS class,
   {R(6, min_x="min_x", max_y="max_y", seed_ny="fny")}
 FROM summ JOIN seeds USING (mesh_id, segment) JOIN normals USING (mesh_id, fid)"""))
def segment_summary(spark, d):
    s = _summary(spark, d)
    out = s.select("mesh_id", "segment", "size", ME.size_class("size", 7, 10).alias("class"), "min_x", "max_y",
                   F.col("normal_seed.y").alias("seed_ny"))
    return V.rounded(out, 6, "min_x", "max_y", "seed_ny")


@query("f22_aligned_segments", W(V.MESH, V.NORMALS, SEGMENTS, body="""
 SELECT mesh_id, segment FROM summ JOIN seeds USING (mesh_id, segment) JOIN normals USING (mesh_id, fid)
 WHERE -fny > 0.2"""))
def aligned_segments(spark, d):
    return ME.aligned_segments(_summary(spark, d), 0.2).select("mesh_id", "segment")


# strips are broken after every 16th vertex: two thirds of a break leave one shared vertex only
@query("g11_face_components", W(V.MESH, body="""
 SELECT mesh_id, fid, min(fid) OVER (PARTITION BY mesh_id, fid // 16) AS component FROM faces"""))
def face_components(spark, d):
    return ME.face_components(V.faces(spark, d))


@query("g11_drop_small_components", W(V.MESH, body="""
 SELECT mesh_id, fid FROM (SELECT *, count(*) OVER (PARTITION BY mesh_id, fid // 16) AS n FROM faces) WHERE n >= 15"""))
def drop_small_components(spark, d):
    return ME.drop_small_components(V.faces(spark, d), 15).select("mesh_id", "fid")


#: two seeds on each strip of 15 faces, whose numbers don't rise along the mesh
SEEDS = f"""seeds AS (SELECT mesh_id, fid, row_number() OVER (PARTITION BY mesh_id ORDER BY fid * 37 % {V.MESH_SPAN}, fid) - 1 AS seed_no
   FROM faces WHERE fid % 8 = 3),
 units AS (SELECT * FROM unit_corners JOIN normals USING (mesh_id, fid)),
 may AS (SELECT s.mesh_id, s.seed_no, u.fid FROM seeds s JOIN normals n USING (mesh_id, fid) JOIN units u ON u.mesh_id = s.mesh_id
   GROUP BY s.mesh_id, s.seed_no, u.fid, s.fid HAVING min(u.ux * n.fnx + u.uy * n.fny + u.uz * n.fnz) > -0.6 OR u.fid = s.fid),
 next_to AS (SELECT DISTINCT a.mesh_id, a.fid, b.fid AS nbr FROM edges a JOIN edges b USING (mesh_id, ea, eb) WHERE a.fid <> b.fid)"""


def _turns(n):
    """One growth after the other; each looks at all faces that the earlier ones took."""
    taken = "SELECT 0 AS mesh_id, 0::BIGINT AS fid, 0::BIGINT AS seed_no WHERE false"
    ctes = []
    for k in range(n):
        ctes.append(f"""t{k} AS ({taken}),
 g{k} AS (SELECT mesh_id, fid FROM seeds WHERE seed_no = {k} AND (mesh_id, fid) NOT IN (SELECT (mesh_id, fid) FROM t{k})
   UNION SELECT m.mesh_id, m.fid FROM g{k} g JOIN next_to x USING (mesh_id, fid) JOIN may m ON m.mesh_id = x.mesh_id
   AND m.fid = x.nbr AND m.seed_no = {k} WHERE (m.mesh_id, m.fid) NOT IN (SELECT (mesh_id, fid) FROM t{k}))""")
        taken = f"SELECT * FROM t{k} UNION ALL SELECT mesh_id, fid, {k} FROM g{k}"
    return ctes, taken


@query("g12_grow_segments", W(V.MESH, V.NORMALS, SEEDS, *_turns(16)[0], recursive=True, body=f"""
 SELECT mesh_id, fid, seed_no AS segment FROM ({_turns(16)[1]})"""))
def grow_segments(spark, d):
    f, v = V.faces(spark, d), V.vertices(spark, d)
    w = Window.partitionBy("mesh_id").orderBy(F.col("fid") * 37 % V.MESH_SPAN, "fid")
    seeds = f.filter("fid % 8 = 3").select("mesh_id", "fid", (F.row_number().over(w) - 1).alias("seed_no"))
    return ME.grow_segments(f, v, seeds, -0.6)


@query("a24_j20_cluster_seeds")
def cluster_seeds(spark, d):
    labelled, centres = ME.cluster_flat_vertices(V.vertices(spark, d), 4)
    return ME.cluster_seed_vertices(labelled, centres)


# every ray of a mesh against each of its triangles
@query("j19_ray_hits", W(V.MESH, """
 tri AS (SELECT f.mesh_id, f.fid, a.x AS ax, a.y AS ay, a.z AS az, b.x - a.x AS e1x, b.y - a.y AS e1y, b.z - a.z AS e1z,
   c.x - a.x AS e2x, c.y - a.y AS e2y, c.z - a.z AS e2z FROM faces f JOIN vertices a ON a.vid = f.v1 JOIN vertices b ON b.vid = f.v2
   JOIN vertices c ON c.vid = f.v3),
 dir AS (SELECT 0.02 / sqrt(1.0005) AS dx, 1 / sqrt(1.0005) AS dy, 0.01 / sqrt(1.0005) AS dz),
 meet AS (SELECT v.mesh_id, v.vid AS ray_id, *, v.x * 0.5 - ax AS sx, v.y - 5 - ay AS sy, v.z * 0.5 - az AS sz,
   dy * e2z - dz * e2y AS hx, dz * e2x - dx * e2z AS hy, dx * e2y - dy * e2x AS hz
   FROM vertices v JOIN tri t ON t.mesh_id = v.mesh_id, dir),
 crossed AS (SELECT *, e1x * hx + e1y * hy + e1z * hz AS det, sx * hx + sy * hy + sz * hz AS bu,
   sy * e1z - sz * e1y AS qx, sz * e1x - sx * e1z AS qy, sx * e1y - sy * e1x AS qz FROM meet),
 hits AS (SELECT mesh_id, ray_id, bu / det AS bu, (dx * qx + dy * qy + dz * qz) / det AS bv,
   (e2x * qx + e2y * qy + e2z * qz) / det AS t FROM crossed WHERE abs(det) > 1e-15)""", body="""
 SELECT mesh_id, ray_id, round(min(t), 6) + 0.0 AS t FROM hits WHERE bu >= -1e-9 AND bv >= -1e-9 AND bu + bv <= 1 + 1e-9 AND t >= 0
 GROUP BY 1, 2"""))
def ray_hits(spark, d):
    v = V.vertices(spark, d)
    rays = v.select("mesh_id", F.col("vid").alias("ray_id"),
                    L.vec(F.col("x") * 0.5, F.col("y") - 5, F.col("z") * 0.5).alias("origin"))
    down = v.select("mesh_id").distinct().withColumn("direction", L.vec(0.02, 1, 0.01))
    out = ME.ray_hits(rays, V.faces(spark, d), v, down)
    return V.rounded(out.select("mesh_id", "ray_id", "t"), 6, "t")


#: the floor's plane is y = 0.3 x + 0.1 z; its normal goes to the y axis by the smallest turn
_N = "sqrt(1.1)"
_LEVEL = {"m00": f"1 - 0.09 / (1.1 + {_N})", "m01": f"0.3 / {_N}", "m02": f"-0.03 / (1.1 + {_N})", "m10": f"-0.3 / {_N}",
          "m11": f"1 / {_N}", "m12": f"-0.1 / {_N}", "m20": f"-0.03 / (1.1 + {_N})", "m21": f"0.1 / {_N}",
          "m22": f"1 - 0.01 / (1.1 + {_N})", "m33": "1.0::DOUBLE"}


@query("a22_level_rotation", W(V.MESH, body=f"""
 SELECT DISTINCT mesh_id, {R(6, **_LEVEL)} FROM faces GROUP BY mesh_id HAVING count(*) > 2"""))
def level_rotation(spark, d):
    v = V.vertices(spark, d).withColumn("y", 0.3 * F.col("x") + 0.1 * F.col("z"))
    f = V.faces(spark, d)
    floors = f.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 2")
    out = ME.level_rotation(f.join(floors, "mesh_id", "left_semi"), v)
    return V.rounded(out.select("mesh_id", *[L.entry("matrix", int(c[1]), int(c[2]), 4).alias(c) for c in _LEVEL]), 6, *_LEVEL)
