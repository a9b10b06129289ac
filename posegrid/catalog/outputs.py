"""Queries on document lines, coloured points and remaining projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from posegrid.catalog import paths
from posegrid.catalog import views as V
from posegrid.catalog.register import query
from posegrid.functions import linalg as L
from posegrid.operators import poses as P
from posegrid.scale import order_stats, smallest_sum
from posegrid.sources import ply, sinks

W = V.with_views
R = V.sql_round


@query("p08_p20_p36_object_pose", W(V.POSES, paths.COMPOSE, body=f"""
 SELECT route_id, pose_key, {R(6, px="y", py="3.0", pz="-2.0", r01="m01 / sc", r12="m12 / sc", r20="m20 / sc",
   e00="x", e02="y", e11="1.0")} FROM comp"""))
def object_pose(spark, d):
    out = P.object_pose(paths._composed(spark, d)).withColumn("_e", L.embed_rotation(
        F.array("x", "y", "z", "x"), "y"))
    p = F.col("position")
    out = out.select("route_id", "pose_key", p["x"].alias("px"), p["y"].alias("py"), p["z"].alias("pz"),
                     L.entry("rotation", 0, 1).alias("r01"), L.entry("rotation", 1, 2).alias("r12"),
                     L.entry("rotation", 2, 0).alias("r20"), L.entry("_e", 0, 0).alias("e00"),
                     L.entry("_e", 0, 2).alias("e02"), L.entry("_e", 1, 1).alias("e11"))
    return V.rounded(out, 6, *out.columns[2:])


@query("k04_k05_coloured_points", W(V.SHOTS, body=f"""
 SELECT CAST(scene_id AS VARCHAR) AS mesh_id, row_number() OVER (PARTITION BY scene_id ORDER BY pose_key) - 1 AS vid,
   {R(6, x="x", y="y", z="z")} FROM shot_poses"""))
def coloured_points(spark, d):
    out = sinks.scene_pose_points(V.shot_poses(spark, d)).select("mesh_id", "vid", "x", "y", "z")
    return V.rounded(out, 6, "x", "y", "z")


@query("k01_scene_lines", W(V.SHOTS, """
 lines AS (SELECT scene_id, pose_key AS k, 5 AS section FROM shot_poses
   UNION ALL SELECT scene_id, view_key, 1 FROM shots
   UNION ALL SELECT scene_id, 0, unnest([0, 2, 4, 6, 8]) FROM (SELECT DISTINCT scene_id FROM shots))""", body="""
 SELECT CAST(scene_id AS VARCHAR) AS doc_id, CAST(section AS INTEGER) AS section, count(*) AS n_lines, max(k) AS last_ord
 FROM lines GROUP BY ALL"""))
def scene_lines(spark, d):
    text = F.col("scene_id").cast("string")
    v = V.shots(spark, d).withColumns({"scene_id": text, "width": F.lit(8), "height": F.lit(4),
                                       "id_intrinsic": F.lit(0)})
    p = V.shot_poses(spark, d).withColumns({"scene_id": text, "rotation": L.identity3()})
    head = v.select("scene_id").distinct().withColumns({"sfm_data_version": F.lit("0.3"),
                                                        "root_path": F.lit("/img")})
    return sinks.scene_lines(head, v, p).groupBy("doc_id", "section").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("ord").alias("last_ord"))


@query("k03_geojson_lines", W(V.FIXES, body="""
 SELECT CAST(route_id AS VARCHAR) AS doc_id, count(*) + 2 AS n_lines, max(seq) AS last_ord FROM fixes GROUP BY 1"""))
def geojson_lines(spark, d):
    e = V.fixes(spark, d).select(F.col("route_id").cast("string").alias("route_id"), "seq",
                                 F.array("lon", "lat", "elev").alias("entry"))
    return sinks.geojson_lines(e).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                                        F.max("ord").alias("last_ord"))


@query("k07_ply_lines", W(V.MESH, body="""
 SELECT CAST(mesh_id AS VARCHAR) AS doc_id, section, count(*) AS n_lines FROM (
   SELECT mesh_id, 1 AS section FROM vertices UNION ALL SELECT mesh_id, 2 FROM faces
   UNION ALL SELECT DISTINCT mesh_id, 0 FROM vertices) GROUP BY ALL"""))
def ply_lines(spark, d):
    text = F.col("mesh_id").cast("string")
    return ply.ply_lines(V.vertices(spark, d).withColumn("mesh_id", text),
                         V.faces(spark, d).withColumn("mesh_id", text)).groupBy("doc_id", "section").agg(
        F.count(F.lit(1)).alias("n_lines"))


@query("o05_smallest_sum", W(V.POSES, body=f"""
 SELECT route_id, {R(6, total="sum(x)")} FROM (
   SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY x) AS k FROM poses) WHERE k <= 5 GROUP BY 1"""))
def smallest(spark, d):
    p = V.poses(spark, d).withColumn("k", F.lit(5))
    return V.rounded(smallest_sum(p, ["route_id"], "x", "k", "total"), 6, "total")


@query("a21_nearest_rank", W(V.POSES, """
 rk AS (SELECT route_id, x, row_number() OVER (PARTITION BY route_id ORDER BY x) - 1 AS r,
   count(*) OVER (PARTITION BY route_id) AS n FROM poses)""", body=f"""
 SELECT route_id, n, {R(6, p30="max(x) FILTER (WHERE r = round_even(0.3 * (n - 1), 0))",
   p70="max(x) FILTER (WHERE r = round_even(0.7 * (n - 1), 0))")} FROM rk GROUP BY 1, 2"""))
def nearest_rank(spark, d):
    return V.rounded(order_stats(V.poses(spark, d), "route_id", "x", {"p30": 0.3, "p70": 0.7}), 6, "p30", "p70")


@query("u04_u06_distinct_images", W(V.SHOTS, body="""
 SELECT DISTINCT scene_id, id_view FROM (
   SELECT scene_id, id_view, row_number() OVER (PARTITION BY scene_id ORDER BY view_key) AS p,
     count(*) OVER (PARTITION BY scene_id) AS n FROM shots) WHERE n > 1"""))
def distinct_images(spark, d):
    from posegrid.operators.pairs import window_pairs
    w = window_pairs(V.shots(spark, d), 2)
    both = w.select("scene_id", F.col("view_a").alias("id_view")).unionByName(
        w.select("scene_id", F.col("view_b").alias("id_view")))
    return both.distinct()


@query("g13_level_by_floor")
def level_by_floor(spark, d):
    from posegrid.plans.alignment import level_by_floor
    painted = V.vertices(spark, d).withColumn("red", F.lit(255))
    out = level_by_floor(painted, V.faces(spark, d), clusters=2, normal_threshold=0.0,
                         floor_threshold=-0.5)
    return V.rounded(out.select("mesh_id", L.entry("matrix", 1, 1, 4).alias("up")), 6, "up")

