"""Adapter views: the given tables read as poses, fixes, frames, meshes and captures.

Every view exists twice, as a DataFrame and as a SQL common table expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.operators.frames import rekey
from posegrid.scale import line, ordered

#: block width of microsecond time lines, about three days
US_BLOCK = 1 << 38


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _us() -> Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


# ------------------------------------------------------------------ poses and fixes

def poses(spark: SparkSession, d: str, rotation: bool = False) -> DataFrame:
    """``route_id, pose_key, seq, ms, x, y, z`` (and ``rotation``) from click and error events."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("click", "error")).select(
        F.col("user_id").alias("route_id"), F.col("event_id").alias("seq"), _us().alias("us"),
        F.col("value").alias("x"), (F.col("event_id") % 97 / 10.0).alias("y"),
        (F.col("event_id") % 89 / 7.0).alias("z"))
    keyed = ordered(e, line("route_id", ("us", "seq"), US_BLOCK), position="pose_key") \
        .withColumn("ms", F.floor(F.col("us") / 1000)).drop("us")
    return keyed.withColumn("rotation", pose_rotation()) if rotation else keyed


def pose_rotation() -> Column:
    yaw, pitch = F.radians(F.col("seq") % 360), F.radians(F.col("seq") % 23)
    cy, sy, cp, sp = F.cos(yaw), F.sin(yaw), F.cos(pitch), F.sin(pitch)
    return L.mat(cy, 0, sy, sp * sy, cp, -sp * cy, -cp * sy, sp, cp * cy)


POSES = """poses AS (
  SELECT user_id AS route_id, event_id AS seq, epoch_us(ts) // 1000 AS ms, value AS x,
    CAST(event_id % 97 AS DOUBLE) / 10 AS y, CAST(event_id % 89 AS DOUBLE) / 7 AS z,
    radians(event_id % 360) AS yaw, radians(event_id % 23) AS pitch,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pose_key
  FROM events WHERE event_type IN ('click', 'error'))"""

ROTATED = """rotated AS (
  SELECT *, cos(yaw) AS r00, 0.0 AS r01, sin(yaw) AS r02,
    sin(pitch) * sin(yaw) AS r10, cos(pitch) AS r11, -sin(pitch) * cos(yaw) AS r12,
    -cos(pitch) * sin(yaw) AS r20, sin(pitch) AS r21, cos(pitch) * cos(yaw) AS r22
  FROM poses)"""


def fixes(spark: SparkSession, d: str) -> DataFrame:
    """``route_id, seq, ms, lon, lat, elev, height`` from view events."""
    return table(spark, d, "events").filter("event_type = 'view'").select(
        F.col("user_id").alias("route_id"), F.col("event_id").alias("seq"),
        F.floor(_us() / 1000).alias("ms"), (120 + F.col("event_id") % 1000 / 1e4).alias("lon"),
        (23 + F.col("event_id") % 777 / 1e4).alias("lat"), F.col("value").alias("elev"),
        (1.5 + F.col("event_id") % 7 / 10.0).alias("height"))


FIXES = """fixes AS (
  SELECT user_id AS route_id, event_id AS seq, epoch_us(ts) // 1000 AS ms,
    120 + CAST(event_id % 1000 AS DOUBLE) / 1e4 AS lon,
    23 + CAST(event_id % 777 AS DOUBLE) / 1e4 AS lat, value AS elev,
    1.5 + CAST(event_id % 7 AS DOUBLE) / 10 AS height
  FROM events WHERE event_type = 'view')"""


def known_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pose points with a known similarity applied plus a small deterministic wobble."""
    p = poses(spark, d)
    yaw, scale = F.radians(F.col("route_id") % 180 + 5.0), 1.5 + F.col("route_id") % 7 / 10.0
    wob = F.col("seq") % 5 / 1000.0
    return p.select(
        "route_id", "pose_key", F.col("x").alias("fx"), F.col("y").alias("fy"),
        F.col("z").alias("fz"),
        (scale * (F.cos(yaw) * F.col("x") - F.sin(yaw) * F.col("z")) + 11 + wob).alias("tx"),
        (scale * F.col("y") - 3 + wob).alias("ty"),
        (scale * (F.sin(yaw) * F.col("x") + F.cos(yaw) * F.col("z")) + 7 - wob).alias("tz"))


KNOWN = """known AS (
  SELECT route_id, pose_key, x AS fx, y AS fy, z AS fz,
    (1.5 + CAST(route_id % 7 AS DOUBLE) / 10) * (cos(radians(route_id % 180 + 5.0)) * x
      - sin(radians(route_id % 180 + 5.0)) * z) + 11 + CAST(seq % 5 AS DOUBLE) / 1000 AS tx,
    (1.5 + CAST(route_id % 7 AS DOUBLE) / 10) * y - 3 + CAST(seq % 5 AS DOUBLE) / 1000 AS ty,
    (1.5 + CAST(route_id % 7 AS DOUBLE) / 10) * (sin(radians(route_id % 180 + 5.0)) * x
      + cos(radians(route_id % 180 + 5.0)) * z) + 7 - CAST(seq % 5 AS DOUBLE) / 1000 AS tz
  FROM poses)"""


# ------------------------------------------------------------------ nodes

def crossings(spark: SparkSession, d: str) -> DataFrame:
    """``route_id, node_id, slice, route_rank``: last crossing of each node by each route."""
    e = table(spark, d, "events").filter("event_type = 'signup'").select(
        F.col("user_id").alias("route_rank"), F.col("user_id").cast("string").alias("route_id"),
        F.get_json_object("props", "$.k").alias("node_id"), F.col("event_id").alias("pos"),
        (F.floor(_us() / 1000) - 1704067200000).alias("begin_ms"))
    return e.groupBy("route_rank", "route_id", "node_id").agg(
        F.max_by(F.floor(F.col("begin_ms") / 86400000), "pos").cast("int").alias("slice"))


CROSSINGS = """crossings AS (
  SELECT user_id AS route_rank, CAST(user_id AS VARCHAR) AS route_id,
    json_extract_string(props, '$.k') AS node_id,
    CAST(max_by((epoch_us(ts) // 1000 - 1704067200000) // 86400000, event_id) AS INTEGER) AS slice
  FROM events WHERE event_type = 'signup' GROUP BY ALL)"""


def markers(spark: SparkSession, d: str) -> DataFrame:
    """Marker rows: a ``start_end`` row per route and a ``node`` row per signup event."""
    e = table(spark, d, "events").withColumn("begin_ms", F.floor(_us() / 1000))
    span = e.filter("event_type = 'purchase'").groupBy(F.col("user_id").alias("route_id")).agg(
        F.lit("start_end").alias("name"), F.lit(-1).cast("bigint").alias("pos"),
        F.min("begin_ms").alias("begin_ms"), F.max("begin_ms").alias("end_ms"))
    nodes = e.filter("event_type = 'signup'").select(
        F.col("user_id").alias("route_id"),
        F.concat(F.lit("node_"), F.get_json_object("props", "$.k")).alias("name"),
        F.col("event_id").alias("pos"), "begin_ms", F.lit(None).cast("bigint").alias("end_ms"))
    return span.unionByName(nodes)


MARKERS = """spans AS (
  SELECT user_id AS route_id, min(epoch_us(ts) // 1000) AS begin_ms,
    max(epoch_us(ts) // 1000) AS end_ms
  FROM events WHERE event_type = 'purchase' GROUP BY 1),
nodes AS (
  SELECT user_id AS route_id, json_extract_string(props, '$.k') AS node_id, event_id AS pos,
    epoch_us(ts) // 1000 AS begin_ms
  FROM events WHERE event_type = 'signup')"""


# ------------------------------------------------------------------ images

def shots(spark: SparkSession, d: str) -> DataFrame:
    """Views with file names, three cameras per frame; some have no pose."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        (F.col("o_custkey") % 40).alias("scene_id"), k.alias("view_key"),
        F.format_string("%07d_%d.jpg", (k / 3).cast("bigint"), k % 3).alias("filename"),
        (k / 3).cast("bigint").alias("frame_idx"), (k % 3).cast("int").alias("cam_id"),
        k.alias("id_view"), k.alias("pos"), k.alias("id_pose"))


def shot_poses(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, d, "orders").filter(k % 5 != 0).select(
        (F.col("o_custkey") % 40).alias("scene_id"), k.alias("pose_key"),
        L.vec(F.col("o_totalprice") / 1000, k % 83 / 10.0, k % 71 / 10.0).alias("center"))


SHOTS = """shots AS (
  SELECT o_custkey % 40 AS scene_id, o_orderkey AS view_key,
    printf('%07d_%d.jpg', o_orderkey // 3, o_orderkey % 3) AS filename,
    o_orderkey // 3 AS frame_idx, CAST(o_orderkey % 3 AS INTEGER) AS cam_id,
    o_orderkey AS id_view
  FROM orders),
shot_poses AS (
  SELECT o_custkey % 40 AS scene_id, o_orderkey AS pose_key, o_totalprice / 1000 AS x,
    CAST(o_orderkey % 83 AS DOUBLE) / 10 AS y, CAST(o_orderkey % 71 AS DOUBLE) / 10 AS z
  FROM orders WHERE o_orderkey % 5 <> 0)"""


def rig(spark: SparkSession, d: str) -> DataFrame:
    """Rig listing: ``scene_id, pos, id_view, frame_no, lens, center``; up to seven lenses per
    frame, some without a centre."""
    g = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_quantity").alias("q"), F.min("l_discount").alias("dc"),
        F.min("l_extendedprice").alias("ep"), F.min("l_tax").alias("tax"))
    pos = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return g.select((F.col("l_orderkey") % 20).alias("scene_id"), pos.alias("pos"),
                    pos.alias("id_view"), F.col("l_orderkey").alias("frame_no"),
                    (F.col("l_linenumber") - 1).alias("lens"),
                    F.when(F.col("tax") < 0.07, L.vec("q", F.col("dc") * 10, F.col("ep") / 1000))
                    .alias("center"))


RIG = """rig AS (
  SELECT l_orderkey % 20 AS scene_id, l_orderkey * 8 + l_linenumber AS pos,
    l_orderkey * 8 + l_linenumber AS id_view, l_orderkey AS frame_no, l_linenumber - 1 AS lens,
    min(l_tax) < 0.07 AS has, min(l_quantity) AS x, min(l_discount) * 10 AS y,
    min(l_extendedprice) / 1000 AS z
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
rigp AS (
  SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY pos) - 1 AS p,
    count(*) OVER (PARTITION BY scene_id) AS n FROM rig)"""


# ------------------------------------------------------------------ captures

def captures(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    ss = (k % 4).cast("double") - F.when(k % 50 == 0, 2.0).otherwise(0.0)
    return table(spark, d, "customer").select(
        k.alias("capture_id"), (2 + k % 9).cast("double").alias("fps"), ss.alias("ss"),
        ((k % 4) + (k % 11)).cast("double").alias("to"), (3 + k % 13).cast("double").alias("length"),
        (F.abs(F.col("c_acctbal")) + 100).alias("focal_length"), F.lit(7).alias("camera_model"),
        F.when(F.col("c_mktsegment") == "BUILDING", "stationary").otherwise("moving")
        .alias("movement_type"), F.abs(F.col("c_acctbal")).alias("duration_ms"))


CAPTURES = """captures AS (
  SELECT c_custkey AS capture_id, CAST(2 + c_custkey % 9 AS DOUBLE) AS fps,
    CAST(c_custkey % 4 AS DOUBLE) - CASE WHEN c_custkey % 50 = 0 THEN 2.0 ELSE 0.0 END AS ss,
    CAST(c_custkey % 4 + c_custkey % 11 AS DOUBLE) AS "to",
    CAST(3 + c_custkey % 13 AS DOUBLE) AS length, abs(c_acctbal) + 100 AS focal_length,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'stationary' ELSE 'moving' END AS movement_type,
    abs(c_acctbal) AS duration_ms
  FROM customer)"""


def key_frames(spark: SparkSession, d: str) -> DataFrame:
    """Dense key-frame list: ``scene_id, frame_idx, fps, ss, to`` with one row per distinct frame."""
    return shots(spark, d).select("scene_id", "frame_idx").distinct().withColumns({
        "fps": F.lit(2.0), "ss": F.lit(4.0), "to": F.lit(1e7)})


KEY_FRAMES = """key_frames AS (
  SELECT scene_id, frame_idx, row_number() OVER (PARTITION BY scene_id ORDER BY frame_idx) - 1 AS p,
    count(*) OVER (PARTITION BY scene_id) AS n
  FROM (SELECT DISTINCT scene_id, frame_idx FROM shots))"""


# ------------------------------------------------------------------ meshes

MESH_SPAN = 128


def vertices(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    v = F.col("vec_id")
    return table(spark, d, "embeddings").select(
        F.floor(v / MESH_SPAN).alias("mesh_id"), v.alias("vid"),
        *[e[i].cast("double").alias(c) for i, c in enumerate(["x", "y", "z", "nx", "ny", "nz"])],
        (v % 7 * 30).cast("int").alias("red"), (v % 5 * 40).cast("int").alias("green"),
        (v % 3 * 60).cast("int").alias("blue"),
        e[6].cast("double").alias("density"), F.col("label"))


def faces(spark: SparkSession, d: str) -> DataFrame:
    """Strips of triangles over consecutive vertices of a mesh; every 16th is missing."""
    v = vertices(spark, d).select("mesh_id", "vid")
    f = v.filter("vid % 16 <> 15").select("mesh_id", F.col("vid").alias("fid"), F.col("vid").alias("v1"),
                                          (F.col("vid") + 1).alias("v2"), (F.col("vid") + 2).alias("v3"))
    return f.join(v.withColumnRenamed("vid", "v3"), ["mesh_id", "v3"], "left_semi")


MESH = f"""vertices AS (
  SELECT vec_id // {MESH_SPAN} AS mesh_id, vec_id AS vid, CAST(embedding[1] AS DOUBLE) AS x,
    CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z,
    CAST(embedding[4] AS DOUBLE) AS nx, CAST(embedding[5] AS DOUBLE) AS ny,
    CAST(embedding[6] AS DOUBLE) AS nz, vec_id % 7 * 30 AS red, vec_id % 5 * 40 AS green,
    vec_id % 3 * 60 AS blue, CAST(embedding[7] AS DOUBLE) AS density, label
  FROM embeddings),
faces AS (
  SELECT v.mesh_id, v.vid AS fid, v.vid AS v1, v.vid + 1 AS v2, v.vid + 2 AS v3
  FROM vertices v JOIN vertices w ON w.mesh_id = v.mesh_id AND w.vid = v.vid + 2
  WHERE v.vid % 16 <> 15),
corners AS (
  SELECT mesh_id, fid, 0 AS corner, v1 AS vid FROM faces
  UNION ALL SELECT mesh_id, fid, 1, v2 FROM faces
  UNION ALL SELECT mesh_id, fid, 2, v3 FROM faces),
cv AS (SELECT c.fid, c.corner, v.* FROM corners c JOIN vertices v USING (mesh_id, vid)),
edges AS (
  SELECT mesh_id, fid, least(v1, v2) AS ea, greatest(v1, v2) AS eb FROM faces
  UNION ALL SELECT mesh_id, fid, least(v2, v3), greatest(v2, v3) FROM faces
  UNION ALL SELECT mesh_id, fid, least(v1, v3), greatest(v1, v3) FROM faces)"""

NORMALS = """unit_corners AS (
  SELECT mesh_id, fid, corner,
    CASE WHEN nx*nx+ny*ny+nz*nz > 0 THEN nx / sqrt(nx*nx+ny*ny+nz*nz) ELSE nx END AS ux,
    CASE WHEN nx*nx+ny*ny+nz*nz > 0 THEN ny / sqrt(nx*nx+ny*ny+nz*nz) ELSE ny END AS uy,
    CASE WHEN nx*nx+ny*ny+nz*nz > 0 THEN nz / sqrt(nx*nx+ny*ny+nz*nz) ELSE nz END AS uz
  FROM cv),
normal_sums AS (
  SELECT mesh_id, fid, sum(ux) AS sx, sum(uy) AS sy, sum(uz) AS sz FROM unit_corners GROUP BY 1, 2),
normals AS (
  SELECT mesh_id, fid, sx / sqrt(sx*sx+sy*sy+sz*sz) AS fnx, sy / sqrt(sx*sx+sy*sy+sz*sz) AS fny,
    sz / sqrt(sx*sx+sy*sy+sz*sz) AS fnz
  FROM normal_sums)"""


# ------------------------------------------------------------------ helpers

def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison; adding zero drops a negative zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def with_views(*ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + body


def sql_round(digits: int, **columns: str) -> str:
    return ", ".join(f"round({expr}, {digits}) + 0.0 AS {name}" for name, expr in columns.items())
