"""Queries on poses, tracks, anchors, fits, resampling and georeferencing."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from posegrid.catalog import views as V
from posegrid.catalog.register import query
from posegrid.functions import geo as G
from posegrid.functions import linalg as L
from posegrid.functions import names as N
from posegrid.operators import anchor as A
from posegrid.operators import fit as FT
from posegrid.operators import outliers as OU
from posegrid.operators import poses as P
from posegrid.operators import resample as RS
from posegrid.plans import georeference as GE

W = V.with_views
R = V.sql_round
XYZ = ("x", "y", "z")


def with_center(df, center="center"):
    return df.withColumn(center, L.vec(*XYZ))


def spread(df, column, names=XYZ):
    return df.withColumns({n: F.col(column)[a] for a, n in zip(XYZ, names)})


# ------------------------------------------------------------------ projections

@query("p04_similarity_apply", W(V.POSES, body=f"""
 SELECT route_id, pose_key, {R(6, x="2.5 * (cos(a) * x + sin(a) * z) + 10", y="2.5 * y - 4",
   z="2.5 * (-sin(a) * x + cos(a) * z) + 0.5")}
 FROM (SELECT *, radians(route_id % 90) AS a FROM poses)"""))
def similarity_apply(spark, d):
    p = V.poses(spark, d)
    r = L.rotation_y(F.radians(F.col("route_id") % 90))
    out = p.withColumn("_r", r).withColumn("v", L.similarity(
        L.vec(*XYZ), F.lit(2.5), "_r", L.vec(10, -4, 0.5)))
    return V.rounded(spread(out, "v").select("route_id", "pose_key", *XYZ), 6, *XYZ)


COMPOSE = """rod AS (
  SELECT *, radians(pose_key * 7 % 170 + 5) AS ang, 2.0 / 3 AS ax, -1.0 / 3 AS ay, 2.0 / 3 AS az,
    1 + route_id % 5 AS sc FROM poses),
comp AS (
  SELECT *, sc * (cos(ang) + ax*ax*(1-cos(ang))) AS m00, sc * (ax*ay*(1-cos(ang)) - az*sin(ang)) AS m01,
    sc * (ax*az*(1-cos(ang)) + ay*sin(ang)) AS m02,
    sc * (ay*ax*(1-cos(ang)) + az*sin(ang)) AS m10, sc * (cos(ang) + ay*ay*(1-cos(ang))) AS m11,
    sc * (ay*az*(1-cos(ang)) - ax*sin(ang)) AS m12,
    sc * (az*ax*(1-cos(ang)) - ay*sin(ang)) AS m20, sc * (az*ay*(1-cos(ang)) + ax*sin(ang)) AS m21,
    sc * (cos(ang) + az*az*(1-cos(ang))) AS m22
  FROM rod)""".replace("2.0 / 3", "2.0::DOUBLE / 3").replace("-1.0 / 3", "-1.0::DOUBLE / 3")


def _composed(spark, d):
    p = V.poses(spark, d)
    ang = (F.col("pose_key") * 7 % 170 + 5).cast("double")
    return p.withColumn("matrix", L.compose(
        1 + F.col("route_id") % 5, ang, L.vec(2 / 3, -1 / 3, 2 / 3), L.vec("y", 3, -2)))


@query("p05_p06_p38_compose_and_apply", W(V.POSES, COMPOSE, body=f"""
 SELECT route_id, pose_key, {R(6, tx="m00*x + m01*y + m02*z + y", ty="m10*x + m11*y + m12*z + 3",
   tz="m20*x + m21*y + m22*z - 2", m01="m01", m12="m12", m20="m20")} FROM comp"""))
def compose_apply(spark, d):
    out = _composed(spark, d).withColumn("v", L.mat4_apply("matrix", L.vec(*XYZ)))
    cols = {"m01": L.entry("matrix", 0, 1, 4), "m12": L.entry("matrix", 1, 2, 4),
            "m20": L.entry("matrix", 2, 0, 4)}
    out = spread(out, "v", ("tx", "ty", "tz")).withColumns(cols)
    return V.rounded(out.select("route_id", "pose_key", "tx", "ty", "tz", *cols), 6, "tx", "ty",
                     "tz", *cols)


@query("p07_p16_decompose", W(V.POSES, COMPOSE, body=f"""
 SELECT route_id, pose_key, {R(6, scale="sc", angle_deg="degrees(ang)", axis_x="ax", axis_y="ay",
   axis_z="az", off_x="y", off_y="3.0", rv_y="ay * ang")} FROM comp"""))
def decompose(spark, d):
    out = L.with_decomposition(_composed(spark, d), "matrix", "p").withColumn(
        "_rot", L.mat4_rotation("matrix"))
    out = L.with_rotation_vector(out, "_rot", "rv")
    c = F.col("p")
    out = out.select("route_id", "pose_key", c["scale"].alias("scale"),
                     c["angle_deg"].alias("angle_deg"),
                     *[c["axis"][a].alias(f"axis_{a}") for a in XYZ],
                     c["offset"]["x"].alias("off_x"), c["offset"]["y"].alias("off_y"),
                     F.col("rv")["y"].alias("rv_y"))
    return V.rounded(out, 6, *out.columns[2:])


@query("p09_p33_transform_poses", W(V.POSES, V.ROTATED, """
 first AS (SELECT route_id, min_by(r00, pose_key) AS f00, min_by(r01, pose_key) AS f01,
   min_by(r02, pose_key) AS f02, min_by(r10, pose_key) AS f10, min_by(r11, pose_key) AS f11,
   min_by(r12, pose_key) AS f12, min_by(r20, pose_key) AS f20, min_by(r21, pose_key) AS f21,
   min_by(r22, pose_key) AS f22 FROM rotated GROUP BY 1)""", body=f"""
 SELECT route_id, pose_key, {R(6, cx="f00*x + f01*y + f02*z", cy="f10*x + f11*y + f12*z",
   cz="f20*x + f21*y + f22*z", q00="r00*f00 + r01*f01 + r02*f02", q12="r10*f20 + r11*f21 + r12*f22",
   q21="r20*f10 + r21*f11 + r22*f12")} FROM rotated JOIN first USING (route_id)"""))
def transform_poses(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).withColumnRenamed("route_id", "scene_id")
    moved = P.transform_poses(p, P.zeroing_matrix(p))
    out = spread(moved, "center", ("cx", "cy", "cz")).withColumns({
        "q00": L.entry("rotation", 0, 0), "q12": L.entry("rotation", 1, 2),
        "q21": L.entry("rotation", 2, 1)}).withColumnRenamed("scene_id", "route_id")
    cols = ("cx", "cy", "cz", "q00", "q12", "q21")
    return V.rounded(out.select("route_id", "pose_key", *cols), 6, *cols)


@query("p10_p11_p19_axes", W(V.POSES, body=f"""
 SELECT route_id, pose_key, {R(6, ux="x", uy="z", uz="-y", bx="x", by="y", bz="z", flat_a="x",
   flat_b="z")} FROM poses"""))
def axes(spark, d):
    p = V.poses(spark, d)
    out = p.withColumn("u", G.sfm_to_utm(L.vec(*XYZ))).withColumn("b", G.utm_to_sfm("u")) \
        .withColumn("f", L.drop_axis(L.vec(*XYZ), "y"))
    out = spread(spread(out, "u", ("ux", "uy", "uz")), "b", ("bx", "by", "bz")).withColumns({
        "flat_a": F.col("f")["a"], "flat_b": F.col("f")["b"]})
    cols = ("ux", "uy", "uz", "bx", "by", "bz", "flat_a", "flat_b")
    return V.rounded(out.select("route_id", "pose_key", *cols), 6, *cols)


def utm_ctes(src: str, lon: str = "lon", lat: str = "lat", out: str = "utm") -> str:
    """UTM coordinates ``ue, un, zone`` of a relation by the same series."""
    e2 = "0.00669438"
    return f"""{out}_a AS (
  SELECT *, CAST(floor(({lon} + 180) / 6) AS INTEGER) + 1 AS zone, radians({lat}) AS phi FROM {src}),
{out}_b AS (
  SELECT *, 6378137.0 / sqrt(1 - {e2} * sin(phi) ** 2) AS nu, tan(phi) ** 2 AS tt,
    {e2} / (1 - {e2}) * cos(phi) ** 2 AS cc, {e2}::DOUBLE / (1 - {e2}) AS ep,
    cos(phi) * (radians({lon}) - radians((zone - 1) * 6 - 180 + 3)) AS aa,
    6378137.0 * ((1 - {e2}/4 - 3 * {e2}**2/64 - 5 * {e2}**3/256) * phi
      - (3 * {e2}/8 + 3 * {e2}**2/32 + 45 * {e2}**3/1024) * sin(2 * phi)
      + (15 * {e2}**2/256 + 45 * {e2}**3/1024) * sin(4 * phi)
      - (35 * {e2}**3/3072) * sin(6 * phi)) AS arc
  FROM {out}_a),
{out} AS (
  SELECT *, 0.9996 * nu * (aa + (1 - tt + cc) * aa**3 / 6
      + (5 - 18 * tt + tt * tt + 72 * cc - 58 * ep) * aa**5 / 120) + 500000 AS ue,
    0.9996 * (arc + nu * tan(phi) * (aa**2 / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * aa**4 / 24
      + (61 - 58 * tt + tt * tt + 600 * cc - 330 * ep) * aa**6 / 720)) AS un
  FROM {out}_b)"""


def geo_ctes(src: str, e: str, n: str, zone: str, out: str = "geo") -> str:
    """Longitude and latitude ``glon, glat`` of northern UTM coordinates."""
    e2 = "0.00669438::DOUBLE"
    return f"""{out}_a AS (
  SELECT *, (1 - sqrt(1 - {e2})) / (1 + sqrt(1 - {e2})) AS k1,
    {n} / 0.9996 / (6378137.0 * (1 - {e2}/4 - 3 * {e2}**2/64 - 5 * {e2}**3/256)) AS mu FROM {src}),
{out}_b AS (
  SELECT *, mu + (3 * k1/2 - 27 * k1**3/32 + 269 * k1**5/512) * sin(2 * mu)
    + (21 * k1**2/16 - 55 * k1**4/32) * sin(4 * mu) + (151 * k1**3/96 - 417 * k1**5/128) * sin(6 * mu)
    + (1097 * k1**4/512) * sin(8 * mu) AS ph FROM {out}_a),
{out}_c AS (
  SELECT *, 1 - {e2} * sin(ph)**2 AS s2, tan(ph)**2 AS gt, {e2} / (1 - {e2}) * cos(ph)**2 AS gc,
    {e2} / (1 - {e2}) AS gp FROM {out}_b),
{out}_d AS (SELECT *, ({e} - 500000) / (6378137.0 / sqrt(s2) * 0.9996) AS dd FROM {out}_c),
{out} AS (
  SELECT *, degrees(ph - (tan(ph) * s2 / (1 - {e2})) * (dd**2 / 2
      - (5 + 3 * gt + 10 * gc - 4 * gc * gc - 9 * gp) * dd**4 / 24
      + (61 + 90 * gt + 298 * gc + 45 * gt * gt - 252 * gp - 3 * gc * gc) * dd**6 / 720)) AS glat,
    degrees((dd - (1 + 2 * gt + gc) * dd**3 / 6
      + (5 - 2 * gc + 28 * gt - 3 * gc * gc + 8 * gp + 24 * gt * gt) * dd**5 / 120) / cos(ph)
      + radians(({zone} - 1) * 6 - 180 + 3)) AS glon
  FROM {out}_d)"""


@query("p12_p13_utm_round_trip", W(V.FIXES, utm_ctes("fixes"), geo_ctes("utm", "ue", "un", "zone"), body=f"""
 SELECT route_id, seq, zone, {R(5, east="ue", north="un")}, {R(7, lon="glon", lat="glat")} FROM geo"""))
def utm_round_trip(spark, d):
    f = V.fixes(spark, d).withColumn("u", G.to_utm("lon", "lat", "elev")).withColumn(
        "g", G.from_utm(F.col("u.x"), F.col("u.y"), F.col("u.z"), F.col("u.zone"), F.col("u.south")))
    out = f.select("route_id", "seq", F.col("u.zone").alias("zone"), F.col("u.x").alias("east"),
                   F.col("u.y").alias("north"), F.col("g.lon").alias("lon"), F.col("g.lat").alias("lat"))
    return V.rounded(V.rounded(out, 5, "east", "north"), 7, "lon", "lat")


@query("p14_ecef", W(V.FIXES, """
 rad AS (SELECT *, 6378137.0 / sqrt(1 - e2 * sin(radians(lat))**2) AS nn FROM (
   SELECT *, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) AS e2 FROM fixes))""", body=f"""
 SELECT route_id, seq, {R(4, ex="(nn + elev) * cos(radians(lat)) * cos(radians(lon))",
   ey="(nn + elev) * cos(radians(lat)) * sin(radians(lon))",
   ez="(nn * (1 - e2) + elev) * sin(radians(lat))", back_elev="elev")},
   {R(7, back_lon="lon", back_lat="lat")} FROM rad"""))
def ecef(spark, d):
    f = V.fixes(spark, d).withColumn("e", G.to_ecef("lon", "lat", "elev")).withColumn(
        "g", G.from_ecef(F.col("e.x"), F.col("e.y"), F.col("e.z")))
    out = f.select("route_id", "seq", F.col("e.x").alias("ex"), F.col("e.y").alias("ey"),
                   F.col("e.z").alias("ez"), F.col("g.elev").alias("back_elev"),
                   F.col("g.lon").alias("back_lon"), F.col("g.lat").alias("back_lat"))
    return V.rounded(V.rounded(out, 4, "ex", "ey", "ez", "back_elev"), 7, "back_lon", "back_lat")


ANGLES_SQL = dict(alpha="asin(greatest(-1.0, least(1.0, -r12)))", beta="atan2(-r02, r22)",
                  gamma="atan2(r10, r11)")


@query("p15_viewer_angles", W(V.POSES, V.ROTATED, body=f"""
 SELECT route_id, pose_key, {R(6, **ANGLES_SQL)} FROM rotated"""))
def viewer_angles(spark, d):
    p = V.poses(spark, d, rotation=True).withColumn("a", G.viewer_angles("rotation"))
    cols = ("alpha", "beta", "gamma")
    out = p.select("route_id", "pose_key", *[F.col("a")[c].alias(c) for c in cols])
    return V.rounded(out, 6, *cols)


@query("p17_p18_heights", W(V.FIXES, V.POSES, body=f"""
 SELECT 'fix' AS kind, seq, {R(6, v="elev - height")} FROM fixes
 UNION ALL SELECT 'pose', seq, {R(6, v="CASE WHEN seq % 3 = 0 THEN 1.8 ELSE sqrt(0.25 + y * y) END")} FROM poses"""))
def heights(spark, d):
    f = A.track_footprints(V.fixes(spark, d)).select(F.lit("fix").alias("kind"), "seq",
                                                     F.col("foot_elev").alias("v"))
    p = with_center(V.poses(spark, d)).withColumn("foot", F.when(
        F.col("seq") % 3 != 0, L.vec(F.col("x") + 0.5, 0, "z")))
    p = p.select(F.lit("pose").alias("kind"), "seq", G.camera_height("center", "foot").alias("v"))
    return V.rounded(f.unionByName(p), 6, "v")


@query("p20_p24_manual_transform", W(V.POSES, V.ROTATED, body=f"""
 SELECT route_id, pose_key, {R(6, px="1.7 * (c * x + s * z) + 30", py="1.7 * y",
   pz="1.7 * (-s * x + c * z) + 20", q00="r00 * c + r02 * s", q12="-r10 * s + r12 * c")}
 FROM (SELECT *, cos(radians(33)) AS c, sin(radians(33)) AS s FROM rotated)"""))
def manual_transform(spark, d):
    p = with_center(V.poses(spark, d, rotation=True))
    pos, rot, _ = G.manual_transform("center", "rotation", "center", 1.7, 33, (20, 30))
    out = spread(p.withColumns({"_p": pos, "_r": rot}), "_p", ("px", "py", "pz")).withColumns({
        "q00": L.entry("_r", 0, 0), "q12": L.entry("_r", 1, 2)})
    cols = ("px", "py", "pz", "q00", "q12")
    return V.rounded(out.select("route_id", "pose_key", *cols), 6, *cols)


@query("p25_g09_manual_georeference", W(V.POSES, V.ROTATED, """
 origin AS (SELECT 121.5 AS lon, 25.03 AS lat)""", utm_ctes("origin"), """
 moved AS (SELECT r.*, 1.7 * (c * x + s * z) + 30 AS px, 1.7 * y AS py, 1.7 * (-s * x + c * z) + 20 AS pz,
    1.7 * 1.6 AS hh, ue, un, zone
  FROM (SELECT *, cos(radians(33)) AS c, sin(radians(33)) AS s FROM rotated) r, utm)""",
  geo_ctes("moved", "(ue + px)", "(un + pz)", "zone"), body=f"""
 SELECT route_id AS video, pose_key AS frame_idx, {R(7, lon="glon", lat="glat")},
   {R(5, elev="12.5 - py", height="hh")}, {R(3, ms="1.7e12 + pose_key / 10.0 * 1000")} FROM geo"""))
def manual_georeference(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).select(
        F.col("route_id").alias("video"), F.lit(0).alias("slice"), F.col("pose_key").alias("frame_idx"),
        (F.col("pose_key") / 10.0).alias("timestamp"), F.col("center").alias("position"), "rotation",
        L.vec("x", F.col("y") + 1.6, "z").alias("footprint"))
    out = GE.georeference_by_hand(p, 1.7, 33, (20, 30), (25.03, 121.5, 12.5), 1.7e12)
    e = F.col("entry")
    out = out.select("video", "frame_idx", e[0].alias("lon"), e[1].alias("lat"), e[2].alias("elev"),
                     e[4].alias("height"), e[3].alias("ms"))
    return V.rounded(V.rounded(V.rounded(out, 7, "lon", "lat"), 5, "elev", "height"), 3, "ms")


@query("p34_relative_transform", W(V.POSES, V.ROTATED, """
 two AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz FROM rotated
   WINDOW w AS (PARTITION BY route_id ORDER BY pose_key)),
 rel AS (SELECT *, sqrt((x-nx)**2 + (y-ny)**2 + (z-nz)**2) * 2 / sqrt((x-nx)**2 + (y-ny)**2 + (z-nz)**2) AS sc
   FROM two WHERE nx IS NOT NULL AND (x-nx)**2 + (y-ny)**2 + (z-nz)**2 > 0)""", body=f"""
 SELECT route_id, pose_key, {R(5, scale="sc", m00="sc", m11="sc", off_x="2*x + 1 - sc * x",
   off_z="2*z - sc * z")} FROM rel"""))
def relative_transform(spark, d):
    from posegrid.scale import line, ordered
    p = V.poses(spark, d, rotation=True)
    two = ordered(p, line("route_id", "pose_key"), following={f"n{a}": a for a in XYZ}) \
        .filter("nx IS NOT NULL")
    grown = lambda x, y, z: L.vec(F.col(x) * 2 + 1, F.col(y) * 2, F.col(z) * 2)
    two = two.withColumns({"_s": L.vec(*XYZ), "_s2": L.vec("nx", "ny", "nz"), "_m": grown(*XYZ),
                           "_m2": grown("nx", "ny", "nz")}).filter(L.dist("_s", "_s2") > 0)
    t = two.withColumn("t", L.relative_transform("_m", "rotation", "_m2", "_s", "rotation", "_s2"))
    out = t.select("route_id", "pose_key", L.mat4_scale("t").alias("scale"),
                   L.entry("t", 0, 0, 4).alias("m00"), L.entry("t", 1, 1, 4).alias("m11"),
                   L.entry("t", 0, 3, 4).alias("off_x"), L.entry("t", 2, 3, 4).alias("off_z"))
    return V.rounded(out, 5, "scale", "m00", "m11", "off_x", "off_z")


# ------------------------------------------------------------------ filters

@query("f01_center_outliers", W(V.POSES, """
 m AS (SELECT route_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM poses GROUP BY 1),
 dd AS (SELECT p.route_id, pose_key, sqrt((x-mx)**2 + (y-my)**2 + (z-mz)**2) AS dist
   FROM poses p JOIN m USING (route_id))""", body="""
 SELECT route_id, pose_key FROM dd JOIN (SELECT route_id, avg(dist) + stddev_pop(dist) AS thr FROM dd GROUP BY 1)
 USING (route_id) WHERE dist <= thr"""))
def center_outliers(spark, d):
    return OU.center_outliers(V.poses(spark, d), ["route_id"]).select("route_id", "pose_key")


@query("f02_rotation_outliers", W(V.POSES, V.ROTATED, """
 m AS (SELECT route_id, avg(r10) AS a, avg(r11) AS b, avg(r12) AS c FROM rotated GROUP BY 1)""", body="""
 SELECT route_id, pose_key FROM rotated JOIN m USING (route_id)
 WHERE acos(least(1.0, r10*a + r11*b + r12*c)) < 0.25"""))
def rotation_outliers(spark, d):
    return OU.rotation_outliers(V.poses(spark, d, rotation=True), 0.25, ["route_id"]).select(
        "route_id", "pose_key")


@query("f08_crop", W(V.POSES, V.FIXES, body="""
 SELECT route_id, pose_key FROM poses JOIN (SELECT route_id, min(ms) AS lo, max(ms) AS hi FROM fixes GROUP BY 1)
 USING (route_id) WHERE ms BETWEEN lo AND hi"""))
def crop(spark, d):
    return RS.crop(V.poses(spark, d), V.fixes(spark, d), "ms").select("route_id", "pose_key")


@query("f03_f06_curve_filter")
def curve_filter(spark, d):
    return OU.curve_filter(V.poses(spark, d), order="pose_key").select("route_id", "pose_key")


@query("f05_filter_poses")
def filter_poses(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).withColumnRenamed("route_id", "scene_id") \
        .drop(*XYZ)
    return OU.filter_poses(p).select("scene_id", "pose_key", "new_key")


@query("f07_robust_covariance_filter")
def robust_covariance(spark, d):
    p = V.poses(spark, d).withColumn("scene_id", F.col("route_id") % 10)
    return OU.robust_covariance_filter(p, 0.05).select("scene_id", "route_id", "pose_key")


@query("f09_a02_merge_lenses", W(V.RIG, body=f"""
 SELECT scene_id, frame_no, count(*) AS n_lenses, {R(9, x="avg(x)", y="avg(y)", z="avg(z)")},
   max(lens) FILTER (WHERE lens = 0) AS rotation_lens
 FROM rig GROUP BY 1, 2 HAVING bool_and(has)"""))
def merge_lenses(spark, d):
    r = V.rig(spark, d).withColumns({"rotation": F.array("lens"),
                                     "footprint": F.lit(None).cast("struct<x:double,y:double,z:double>")})
    m = P.merge_lenses(r, 0, ("scene_id", "frame_no"))
    out = spread(m, "position").select("scene_id", "frame_no", "n_lenses", *XYZ,
                                       F.col("rotation")[0].alias("rotation_lens"))
    return V.rounded(out, 9, *XYZ)


# ------------------------------------------------------------------ pose joins

@query("j01_reorder", W(V.SHOTS, body=f"""
 SELECT s.scene_id, s.view_key, s.new_key, {R(6, x="p.x")} FROM (
   SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY split_part(filename, '.', 1), view_key) - 1 AS new_key
   FROM shots) s JOIN shot_poses p ON p.scene_id = s.scene_id AND p.pose_key = s.view_key"""))
def reorder(spark, d):
    out = P.reorder(V.shots(spark, d).select("scene_id", "view_key", "filename"),
                    V.shot_poses(spark, d), digits=5)
    return V.rounded(out.select("scene_id", "view_key", "new_key", F.col("center.x").alias("x")), 6, "x")


@query("j02_views_with_poses", W(V.SHOTS, body="""
 SELECT s.scene_id, s.filename FROM shots s JOIN shot_poses p
 ON p.scene_id = s.scene_id AND p.pose_key = s.view_key"""))
def views_with_poses(spark, d):
    return P.views_with_poses(V.shots(spark, d), V.shot_poses(spark, d)).select("scene_id", "filename")


@query("j03_reduce_views", W(V.SHOTS, body="""
 SELECT s.scene_id, s.view_key FROM shots s JOIN shot_poses p
 ON p.scene_id = s.scene_id AND p.pose_key = s.view_key
 WHERE split_part(filename, '.', 1) IN (SELECT split_part(filename, '.', 1) FROM shots WHERE cam_id <> 1)"""))
def reduce_views(spark, d):
    s = V.shots(spark, d)
    return P.reduce_views(s.filter("cam_id <> 1"), s, V.shot_poses(spark, d)).select("scene_id", "view_key")


@query("j04_u05_pair_scenes", W(V.SHOTS, """
 main AS (SELECT scene_id % 10 AS scene_id, split_part(filename, '.', 1) AS stem, view_key AS k FROM shots
   WHERE view_key % 4 <> 1),
 sub AS (SELECT scene_id % 10 AS scene_id, split_part(filename, '.', 1) AS stem, view_key + 7 AS k FROM shots
   WHERE view_key % 3 <> 2),
 prs AS (SELECT m.scene_id, m.k AS main_key, s.k AS sub_key FROM main m JOIN sub s USING (scene_id, stem)
   WHERE m.k < (SELECT max(k) FROM main mm WHERE mm.scene_id = m.scene_id))""", body="""
 SELECT *, 'camera' AS kind FROM prs UNION ALL SELECT *, 'footprint' FROM prs"""))
def pair_scenes(spark, d):
    s = V.shots(spark, d).withColumns({"scene_id": F.col("scene_id") % 10, "stem": N.stem("filename"),
                                       "center": L.vec(0, 0, 0), "pose_key": F.col("view_key")})
    prs = P.pair_scenes(s.filter("view_key % 4 <> 1"), s.filter("view_key % 3 <> 2").withColumn(
        "pose_key", F.col("view_key") + 7), skip_last=True)
    kinds = F.explode(F.array(F.lit("camera"), F.lit("footprint")))
    return prs.select("scene_id", "main_key", "sub_key", kinds.alias("kind"))


@query("j07_g14_route_table", W(V.SHOTS, """
 lk AS (SELECT s.scene_id, s.frame_idx, s.cam_id, p.x, p.y, p.z, p.pose_key IS NOT NULL AS has
  FROM shots s LEFT JOIN shot_poses p ON p.scene_id = s.scene_id AND p.pose_key = s.id_view)""", body=f"""
 SELECT scene_id, frame_idx, count(*) AS n_lenses, {R(9, timestamp="frame_idx / 10.0 + 4", x="avg(x)",
   y="avg(y)", z="avg(z)")} FROM lk GROUP BY 1, 2 HAVING bool_and(has)"""))
def route_table(spark, d):
    s = V.shots(spark, d)
    lens = s.select("scene_id", "frame_idx", F.col("cam_id").alias("lens"), "filename",
                    F.lit(10.0).alias("fps"), F.lit(4.0).alias("ss"))
    poses = V.shot_poses(spark, d).withColumn("rotation", L.identity3())
    out = spread(P.route_table(lens, s.select("scene_id", "filename", "id_pose"), poses), "position")
    return V.rounded(out.select("scene_id", "frame_idx", "n_lenses", "timestamp", *XYZ), 9,
                     "timestamp", *XYZ)


@query("j14_drop_main_rows", W(V.SHOTS, """
 main AS (SELECT scene_id, view_key FROM shots WHERE view_key % 2 = 0),
 cnt AS (SELECT scene_id, count(*) AS n_main FROM main GROUP BY 1)""", body="""
 SELECT s.scene_id, s.view_key - n_main AS view_key, s.filename FROM shots s JOIN cnt USING (scene_id)
 WHERE NOT EXISTS (SELECT 1 FROM main m WHERE m.scene_id = s.scene_id AND m.view_key = s.view_key)"""))
def drop_main_rows(spark, d):
    s = V.shots(spark, d).select("scene_id", "view_key",
                                 F.concat(F.lit("sub_"), "filename").alias("filename"))
    main = s.filter("view_key % 2 = 0")
    return P.drop_main_rows(s, main, main.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n_main")))


# ------------------------------------------------------------------ aggregates and windows

@query("a01_rig_mean", W(V.RIG, body=f"""
 SELECT scene_id, pos, {R(9, x="CASE WHEN has THEN avg(x) FILTER (WHERE has) OVER w END",
   z="CASE WHEN has THEN avg(z) FILTER (WHERE has) OVER w END")} FROM rig
 WINDOW w AS (PARTITION BY scene_id, pos // 8)"""))
def rig_mean(spark, d):
    out = P.rig_mean(V.rig(spark, d), 8).select("scene_id", "pos", F.col("center.x").alias("x"),
                                                F.col("center.z").alias("z"))
    return V.rounded(out, 9, "x", "z")


@query("a03_footprint_clamp", W(V.POSES, V.ROTATED, """
 dir AS (SELECT route_id, avg(r10) AS dx, avg(r11) AS dy, avg(r12) AS dz FROM rotated GROUP BY 1),
 hit AS (SELECT *, seq % 4 <> 0 AS has, 0.5 + CAST(seq % 9973 AS DOUBLE) / 1000 AS v FROM rotated),
 rk AS (SELECT route_id, v, row_number() OVER (PARTITION BY route_id ORDER BY v) - 1 AS r,
   count(*) OVER (PARTITION BY route_id) AS n FROM hit WHERE has),
 st AS (SELECT route_id, max(v) FILTER (WHERE r = round_even(0.3 * (n - 1), 0)) AS p30,
   max(v) FILTER (WHERE r = round_even(0.5 * (n - 1), 0)) AS p50,
   max(v) FILTER (WHERE r = round_even(0.7 * (n - 1), 0)) AS p70 FROM rk GROUP BY 1)""", body=f"""
 SELECT route_id, pose_key, {R(6, fx="CASE WHEN has AND v BETWEEN p30 AND p70 THEN x ELSE x + k * dx END",
   fy="CASE WHEN has AND v BETWEEN p30 AND p70 THEN y + v ELSE y + k * dy END")} FROM (
   SELECT *, CASE WHEN NOT has THEN p50 WHEN v < p30 THEN p30 ELSE p70 END AS k
   FROM hit JOIN dir USING (route_id) JOIN st USING (route_id))"""))
def footprint_clamp(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).withColumnRenamed("route_id", "scene_id")
    hits = p.filter("seq % 4 <> 0").select("scene_id", "pose_key", L.vec(
        "x", F.col("y") + (0.5 + F.col("seq") % 9973 / 1000.0), "z").alias("hit"))
    out = P.clamp_footprints(p, hits).select(
        F.col("scene_id").alias("route_id"), "pose_key", F.col("footprint.x").alias("fx"),
        F.col("footprint.y").alias("fy"))
    return V.rounded(out, 6, "fx", "fy")


@query("a21_rig_spacing", W(V.RIG, """
 st AS (SELECT scene_id, sqrt((x-nx)**2 + (y-ny)**2 + (z-nz)**2) AS v FROM (
   SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz FROM rig WHERE has
   WINDOW w AS (PARTITION BY scene_id ORDER BY pos)) WHERE nx IS NOT NULL),
 rk AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY v) - 1 AS r,
   count(*) OVER (PARTITION BY scene_id) AS n FROM st)""", body=f"""
 SELECT scene_id, n, {R(6, rig_dist="v")} FROM rk WHERE r = round_even(0.3 * (n - 1), 0)"""))
def rig_spacing(spark, d):
    return V.rounded(P.rig_spacing(V.rig(spark, d).filter("center IS NOT NULL")), 6, "rig_dist")


@query("a15_time_step", W(V.POSES, body=f"""
 SELECT route_id, count(*) AS n, {R(6, time_step="quantile_cont(dt, 0.5)")} FROM (
   SELECT route_id, seq // 40 - lag(seq // 40) OVER w AS di, (ms - lag(ms) OVER w) / 1000.0 AS dt FROM (
     SELECT *, row_number() OVER (PARTITION BY route_id, seq // 40 ORDER BY seq) AS k FROM poses) WHERE k = 1
   WINDOW w AS (PARTITION BY route_id ORDER BY seq // 40)) WHERE di = 1 GROUP BY 1"""))
def time_step(spark, d):
    p = V.poses(spark, d).withColumn("frame_idx", F.floor(F.col("seq") / 40))
    one = p.groupBy("route_id", "frame_idx").agg(F.min_by("ms", "seq").alias("_ms")).withColumn(
        "timestamp", F.col("_ms") / 1000.0)
    return V.rounded(RS.time_step(one), 6, "time_step")


@query("a23_w12_w14_rig_center")
def rig_center(spark, d):
    out = P.rig_center(V.rig(spark, d), 8)
    return V.rounded(spread(out, "center").select("scene_id", "pos", *XYZ), 6, *XYZ)


@query("w12_longest_run", W(V.POSES, """
 g AS (SELECT *, seq % 5 <> 0 AS good, count(*) FILTER (WHERE seq % 5 = 0) OVER (
   PARTITION BY route_id ORDER BY pose_key) AS island FROM poses),
 r AS (SELECT route_id, island, min(pose_key) FILTER (WHERE good) AS run_beg,
   max(pose_key) FILTER (WHERE good) AS run_end, count(*) FILTER (WHERE good) AS len FROM g GROUP BY 1, 2)""", body="""
 SELECT route_id, run_beg, run_end, len AS run_length FROM (
   SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY len DESC, island) AS k FROM r) WHERE k = 1"""))
def longest_run(spark, d):
    p = V.poses(spark, d).withColumn("good", F.col("seq") % 5 != 0)
    return P.longest_run(p, "good", "pose_key", ["route_id"]).drop("n")


@query("w01_step_length", W(V.POSES, body=f"""
 SELECT route_id, pose_key, {R(6, step="coalesce(sqrt((nx-x)**2 + (ny-y)**2 + (nz-z)**2), sqrt((x-px)**2 + (y-py)**2 + (z-pz)**2))")}
 FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz, lag(x) OVER w AS px,
   lag(y) OVER w AS py, lag(z) OVER w AS pz FROM poses WINDOW w AS (PARTITION BY route_id ORDER BY pose_key))"""))
def step_length(spark, d):
    out = P.step_length(V.poses(spark, d), "pose_key", keys=["route_id"])
    return V.rounded(out.select("route_id", "pose_key", "step"), 6, "step")


STEPS = """tsteps AS (
 SELECT *, coalesce(sqrt((nx-ue)**2 + (nn-un)**2), sqrt((ue-px)**2 + (un-pn)**2)) AS step FROM (
   SELECT *, lead(ue) OVER w AS nx, lead(un) OVER w AS nn, lag(ue) OVER w AS px, lag(un) OVER w AS pn
   FROM utm WINDOW w AS (PARTITION BY route_id ORDER BY seq)))"""


@query("w02_track_steps", W(V.FIXES, utm_ctes("fixes"), STEPS, body=f"""
 SELECT route_id, seq, {R(4, step="step")} FROM tsteps"""))
def track_steps(spark, d):
    return V.rounded(A.track_steps(V.fixes(spark, d)).select("route_id", "seq", "step"), 4, "step")


@query("w03_a04_track_step_footprints", W(V.FIXES, utm_ctes("fixes"), STEPS, body=f"""
 SELECT route_id, seq, {R(5, foot_elev="elev - step * 1.8 / avg(step) OVER (PARTITION BY route_id)")},
   {R(9, step_factor="1.8 / avg(step) OVER (PARTITION BY route_id)")} FROM tsteps"""))
def track_step_footprints(spark, d):
    out = A.track_step_footprints(V.fixes(spark, d)).select("route_id", "seq", "foot_elev", "step_factor")
    return V.rounded(V.rounded(out, 5, "foot_elev"), 9, "step_factor")


@query("w03_step_anchor", W(V.POSES, V.ROTATED, """
 st AS (SELECT *, coalesce(sqrt((nx-x)**2 + (ny-y)**2 + (nz-z)**2), sqrt((x-px)**2 + (y-py)**2 + (z-pz)**2)) AS step
 FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(z) OVER w AS nz, lag(x) OVER w AS px,
   lag(y) OVER w AS py, lag(z) OVER w AS pz FROM rotated WINDOW w AS (PARTITION BY route_id ORDER BY pose_key)))""", body=f"""
 SELECT route_id, pose_key, {R(6, fx="x + 4 * step * r10", fy="y + 4 * step * r11", fz="z + 4 * step * r12")}
 FROM st"""))
def step_anchor(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).drop(*XYZ)
    out = spread(P.step_anchor(p, keys=["route_id"]), "footprint", ("fx", "fy", "fz"))
    return V.rounded(out.select("route_id", "pose_key", "fx", "fy", "fz"), 6, "fx", "fy", "fz")


def _curve_sql(power: str) -> str:
    return W(V.POSES, f"""
 sg AS (SELECT *, coalesce(sqrt((x-px)**2 + (y-py)**2 + (z-pz)**2) ** {power}, 0.0) AS seg FROM (
   SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(z) OVER w AS pz FROM poses
   WINDOW w AS (PARTITION BY route_id ORDER BY pose_key))),
 cu AS (SELECT *, sum(seg) OVER (PARTITION BY route_id ORDER BY pose_key) AS run,
   sum(seg) OVER (PARTITION BY route_id) AS whole FROM sg)""", body=f"""
 SELECT route_id, pose_key, {R(6, u="CASE WHEN whole > 0 THEN run / whole ELSE 0 END")} FROM cu""")


def _curve(mode):
    def run(spark, d):
        out = OU.curve_parameter(V.poses(spark, d), "pose_key", mode)
        return V.rounded(out.select("route_id", "pose_key", "u"), 6, "u")
    return run


query("w04_curve_parameter_centripetal", _curve_sql("0.5"))(_curve("centripetal"))
query("w04_curve_parameter_chord", _curve_sql("1.0"))(_curve("chordlength"))
query("w04_curve_parameter_uniform", W(V.POSES, body=f"""
 SELECT route_id, pose_key, {R(6, u="CASE WHEN n > 1 THEN pose_key / (n - 1) ELSE 0 END")} FROM (
   SELECT *, count(*) OVER (PARTITION BY route_id) AS n FROM poses)"""))(_curve("uniform"))


# ------------------------------------------------------------------ interpolation

LERP = """knots AS (SELECT route_id, CAST(ms AS DOUBLE) AS kms, min(elev) AS v FROM fixes GROUP BY 1, 2),
before AS (SELECT p.route_id, p.pose_key, CAST(p.ms AS DOUBLE) AS t, k.kms AS t0, k.v AS v0
  FROM poses p ASOF LEFT JOIN knots k ON k.route_id = p.route_id AND k.kms <= p.ms),
around AS (SELECT b.*, k.kms AS t1, k.v AS v1
  FROM before b ASOF LEFT JOIN knots k ON k.route_id = b.route_id AND k.kms >= b.t)"""


@query("w05_interpolate", W(V.POSES, V.FIXES, LERP, body=f"""
 SELECT route_id, pose_key, {R(5, elev="CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL THEN v0 WHEN t1 > t0 THEN v0 + (v1 - v0) * ((t - t0) / (t1 - t0)) ELSE v0 END")}
 FROM around WHERE t0 IS NOT NULL OR t1 IS NOT NULL"""))
def interpolate(spark, d):
    p = V.poses(spark, d).select("route_id", "pose_key", F.col("ms").cast("double").alias("ms"))
    f = V.fixes(spark, d).withColumn("ms", F.col("ms").cast("double"))
    out = RS.interpolate(p, f, "ms", ["elev"], width=float(1 << 30)).filter("elev IS NOT NULL")
    return V.rounded(out.select("route_id", "pose_key", "elev"), 5, "elev")


@query("w06_w07_path_at_fixes")
def path_at_fixes(spark, d):
    p = V.poses(spark, d, rotation=True)
    path = p.withColumn("timestamp", (F.col("ms") - 1704067200000) / 1000.0)
    out = RS.path_at_fixes(path.select("route_id", "timestamp", *XYZ, "rotation"), V.fixes(spark, d))
    out = out.withColumn("r00", L.entry("rotation", 0, 0)).select("route_id", "seq", "timestamp", *XYZ, "r00")
    return V.rounded(out, 5, "timestamp", *XYZ, "r00")


@query("w08_densify", W(V.FIXES, """
 sp AS (SELECT route_id, min(ms)::DOUBLE AS lo, max(ms)::DOUBLE AS hi FROM fixes GROUP BY 1),
 gr AS (SELECT route_id, i AS seq, CASE WHEN i = 9 THEN hi ELSE lo + (hi - lo) * i / 9 END AS ms
   FROM sp, (SELECT unnest(range(10)) AS i)),
 kn AS (SELECT route_id, ms::DOUBLE AS kms, min(elev) AS v FROM fixes GROUP BY 1, 2),
 b AS (SELECT g.*, k.kms AS t0, k.v AS v0 FROM gr g ASOF LEFT JOIN kn k ON k.route_id = g.route_id AND k.kms <= g.ms),
 a AS (SELECT b.*, k.kms AS t1, k.v AS v1 FROM b ASOF LEFT JOIN kn k ON k.route_id = b.route_id AND k.kms >= b.ms)""",
 body=f"""SELECT route_id, CAST(seq AS INTEGER) AS seq, {R(3, ms="ms")},
 {R(5, elev="CASE WHEN t1 > t0 THEN v0 + (v1 - v0) * ((ms - t0) / (t1 - t0)) ELSE v0 END")} FROM a"""))
def densify(spark, d):
    out = RS.densify(V.fixes(spark, d), ["elev"]).select("route_id", "seq", "ms", "elev")
    return V.rounded(V.rounded(out, 3, "ms"), 5, "elev")


@query("w09_fill_route", W(V.POSES, """
 kept AS (SELECT route_id, pose_key * 2 AS t, pose_key, x FROM poses WHERE seq % 3 <> 0 AND pose_key > 1),
 can AS (SELECT DISTINCT a.route_id FROM kept a JOIN kept b ON a.route_id = b.route_id AND b.pose_key = a.pose_key + 1),
 tot AS (SELECT route_id, max(pose_key) + 3 AS n FROM poses WHERE route_id IN (SELECT route_id FROM can) GROUP BY 1),
 gr AS (SELECT route_id, unnest(range(n)) AS frame_idx FROM tot),
 b AS (SELECT g.*, k.pose_key AS t0, k.x AS v0 FROM gr g ASOF LEFT JOIN kept k ON k.route_id = g.route_id AND k.pose_key <= g.frame_idx),
 a AS (SELECT b.*, k.pose_key AS t1, k.x AS v1 FROM b ASOF LEFT JOIN kept k ON k.route_id = b.route_id AND k.pose_key >= b.frame_idx)""",
 body=f"""SELECT route_id, frame_idx, {R(5, timestamp="frame_idx * 2.0",
  x="CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL THEN v0 WHEN t1 > t0 THEN v0 + (v1 - v0) * ((frame_idx - t0) / (t1 - t0)) ELSE v0 END")}
 FROM a"""))
def fill_route(spark, d):
    p = V.poses(spark, d)
    totals = p.groupBy("route_id").agg((F.max("pose_key") + 3).alias("n_total"))
    kept = p.filter("seq % 3 <> 0 AND pose_key > 1").select(
        "route_id", F.col("pose_key").alias("frame_idx"), (F.col("pose_key") * 2.0).alias("timestamp"), "x")
    out = RS.fill_route(kept, totals, ["x"], rotation=None)
    return V.rounded(out.select("route_id", "frame_idx", "timestamp", "x"), 5, "timestamp", "x")


# ------------------------------------------------------------------ anchors

ANCHORS = """counted AS (
  SELECT *, count(*) OVER (PARTITION BY route_id) AS n FROM poses),
anchors AS (
  SELECT *, CASE WHEN n < 16 OR pose_key < 8 THEN 'start' ELSE 'end' END AS anchor_group FROM counted
  WHERE n < 16 OR pose_key < 8 OR pose_key >= n - 8)"""
MATCHES = """cand AS (
  SELECT a.*, f.seq AS gps_seq, f.ms AS gps_ms, abs(a.ms - f.ms) AS dt, f.lon, f.lat, f.elev, f.height,
    row_number() OVER (PARTITION BY a.route_id, a.pose_key ORDER BY abs(a.ms - f.ms), f.seq) AS k
  FROM anchors a JOIN fixes f USING (route_id)),
near AS (SELECT * FROM cand WHERE k = 1 AND dt < 21600000),
matches AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY route_id, gps_seq ORDER BY dt, pose_key) AS b FROM near)
  WHERE b = 1)"""
SIX_HOURS = 21600000


def _anchors(spark, d):
    return A.anchor_frames(V.poses(spark, d), 8)


def _near(spark, d):
    return A.nearest_fix(_anchors(spark, d), V.fixes(spark, d), SIX_HOURS, width_ms=float(1 << 30))


@query("w15_anchor_frames", W(V.POSES, ANCHORS, body="SELECT route_id, pose_key, anchor_group FROM anchors"))
def anchor_frames(spark, d):
    return _anchors(spark, d).select("route_id", "pose_key", "anchor_group")


@query("j05_nearest_fix", W(V.POSES, V.FIXES, """
 cand AS (SELECT p.route_id, p.pose_key, f.seq AS gps_seq, f.ms AS gps_ms, abs(p.ms - f.ms) AS dt,
   row_number() OVER (PARTITION BY p.route_id, p.pose_key ORDER BY abs(p.ms - f.ms), f.seq) AS k
   FROM poses p JOIN fixes f USING (route_id))""", body="""
 SELECT route_id, pose_key, gps_seq, gps_ms, dt FROM cand WHERE k = 1 AND dt < 21600000"""))
def nearest_fix(spark, d):
    out = A.nearest_fix(V.poses(spark, d), V.fixes(spark, d), SIX_HOURS, width_ms=float(1 << 30))
    return out.select("route_id", "pose_key", "gps_seq", "gps_ms", "dt")


@query("j06_one_to_one", W(V.POSES, V.FIXES, ANCHORS, MATCHES, body="""
 SELECT route_id, pose_key, gps_seq, dt FROM matches"""))
def one_to_one(spark, d):
    return A.one_to_one(_near(spark, d)).select("route_id", "pose_key", "gps_seq", "dt")


@query("a17_anchor_range", W(V.POSES, V.FIXES, ANCHORS, MATCHES, body="""
 SELECT route_id, min(gps_seq) AS first_seq, max(gps_seq) AS last_seq, count(*) AS n FROM matches GROUP BY 1"""))
def anchor_range(spark, d):
    return A.anchor_range(A.one_to_one(_near(spark, d)))


def _smooth(mode):
    def run(spark, d):
        m = A.with_fix(A.one_to_one(_near(spark, d)), V.fixes(spark, d))
        out = A.smooth_anchors(m, ["elev", "y"], mode)
        return V.rounded(out.select("route_id", "pose_key", "elev", "y"), 6, "elev", "y")
    return run


for _mode, _part in (("anchor", "route_id, anchor_group"), ("full", "route_id")):
    query(f"a18_smooth_{_mode}", W(V.POSES, V.FIXES, ANCHORS, MATCHES, body=f"""
     SELECT route_id, pose_key, {R(6, elev=f"avg(elev) OVER (PARTITION BY {_part})",
                                   y=f"avg(y) OVER (PARTITION BY {_part})")} FROM matches"""))(_smooth(_mode))


@query("w16_splice", W(V.POSES, V.FIXES, ANCHORS, MATCHES, """
 span AS (SELECT route_id, min(gps_seq) AS f, max(gps_seq) AS l FROM matches GROUP BY 1)""", body="""
 SELECT route_id, 0 AS part, seq FROM fixes JOIN span USING (route_id) WHERE seq < f
 UNION ALL SELECT route_id, 1, pose_key FROM poses
 UNION ALL SELECT route_id, 2, seq FROM fixes JOIN span USING (route_id) WHERE seq > l"""))
def splice(spark, d):
    path = V.poses(spark, d).select("route_id", F.col("pose_key").alias("seq"),
                                    F.array("x", "y", "z").alias("entry"))
    fx = V.fixes(spark, d).select("route_id", "seq", F.array("lon", "lat", "elev").alias("entry"))
    return A.splice(path, fx, A.one_to_one(_near(spark, d))).select("route_id", "part", "seq")


@query("p37_match_xyz", W(V.POSES, V.FIXES, ANCHORS, MATCHES, utm_ctes("matches"), body=f"""
 SELECT route_id, pose_key, 'camera' AS kind, zone, {R(5, fx="x", fy="y", fz="z", tx="ue", ty="-elev", tz="un")} FROM utm
 UNION ALL SELECT route_id, pose_key, 'footprint', zone, {R(5, fx="x", fy="y + 1.6", fz="z", tx="ue",
   ty="-(elev - height)", tz="un")} FROM utm"""))
def match_xyz(spark, d):
    m = with_center(A.with_fix(A.one_to_one(_near(spark, d)), A.track_footprints(V.fixes(spark, d)))) \
        .withColumn("footprint", L.vec("x", F.col("y") + 1.6, "z"))
    out = A.match_xyz(A.match_points(m)).select("route_id", "pose_key", "kind", "zone", "fx", "fy", "fz",
                                                "tx", "ty", "tz")
    return V.rounded(out, 5, "fx", "fy", "fz", "tx", "ty", "tz")


@query("f26_track_lengths", W(V.FIXES, body="""
 SELECT route_id, n, CASE WHEN n < 2 THEN 'reject' WHEN n <= 3 THEN 'densify' ELSE 'keep' END AS verdict
 FROM (SELECT route_id * 100000 + ms // 86400000 AS route_id, count(*) AS n FROM fixes GROUP BY 1)"""))
def track_lengths(spark, d):
    # a track is what a route recorded in one day
    f = V.fixes(spark, d).withColumn("route_id", F.col("route_id") * 100000 + F.floor(F.col("ms") / 86400000))
    n = f.groupBy("route_id").agg(F.count(F.lit(1)).alias("n"))
    usable = A.long_enough(f).groupBy("route_id").agg(F.count(F.lit(1)).alias("m"))
    out = n.join(usable, "route_id", "left")
    verdict = F.when(F.col("m").isNull(), "reject").when(F.col("m") != F.col("n"), "densify").otherwise("keep")
    return out.select("route_id", "n", verdict.alias("verdict"))


# ------------------------------------------------------------------ fits

YAW = """mom AS (
  SELECT route_id, count(*) AS n, avg(fx) AS mfx, avg(fy) AS mfy, avg(fz) AS mfz, avg(tx) AS mtx, avg(ty) AS mty,
    avg(tz) AS mtz, covar_pop(tx, fx) + covar_pop(tz, fz) AS dots, covar_pop(tz, fx) - covar_pop(tx, fz) AS crs,
    var_pop(fx) + var_pop(fz) AS vv FROM {src} GROUP BY 1),
yaw AS (
  SELECT *, sqrt(dots*dots + crs*crs) / vv AS sc, dots / sqrt(dots*dots + crs*crs) AS co,
    crs / sqrt(dots*dots + crs*crs) AS si FROM mom)"""


@query("a06_planar_fit", W(V.POSES, V.KNOWN, YAW.format(src="known"), body=f"""
 SELECT route_id, n, {R(6, yaw_scale="sc", co="co", si="si", tx="mtx - sc * (co * mfx - si * mfz)",
   ty="mty - sc * mfy", tz="mtz - sc * (si * mfx + co * mfz)")} FROM yaw"""))
def planar_fit(spark, d):
    f = FT.planar_fit(V.known_pairs(spark, d))
    out = f.select("route_id", "n", "yaw_scale", L.entry("yaw_rotation", 0, 0).alias("co"),
                   L.entry("yaw_rotation", 2, 0).alias("si"),
                   *[F.col("yaw_t")[a].alias(f"t{a}") for a in XYZ])
    return V.rounded(out, 6, "yaw_scale", "co", "si", "tx", "ty", "tz")


def _exact_pairs(spark, d):
    """Pose points and where a similarity of their site puts them, exactly."""
    p = V.poses(spark, d).withColumn("site_id", F.col("route_id") % 7)
    yaw, k = F.radians(F.col("site_id") * 20 + 5.0), 1.5 + F.col("site_id") / 10.0
    return p.select("site_id", "route_id", "pose_key", *[F.col(a).alias(f"f{a}") for a in XYZ],
                    (k * (F.cos(yaw) * F.col("x") - F.sin(yaw) * F.col("z")) + 11).alias("tx"), (k * F.col("y") - 3).alias("ty"),
                    (k * (F.sin(yaw) * F.col("x") + F.cos(yaw) * F.col("z")) + 7).alias("tz"))


#: what every fit of exact pairs must find
EXACT = """exact AS (SELECT route_id % 7 AS site_id, route_id, count(*) AS n, 1.5 + CAST(route_id % 7 AS DOUBLE) / 10 AS scale,
   cos(radians(route_id % 7 * 20 + 5.0)) AS r00, -sin(radians(route_id % 7 * 20 + 5.0)) AS r02 FROM poses GROUP BY route_id)"""


@query("a05_similarity_fit", W(V.POSES, EXACT, body=f"""
 SELECT route_id, n, NULL::VARCHAR AS reason, {R(6, scale="scale", tx="11.0::DOUBLE", ty="-3.0::DOUBLE", tz="7.0::DOUBLE", r00="r00", r02="r02",
   r11="1.0::DOUBLE")} FROM exact"""))
def similarity_fit(spark, d):
    out = FT.similarity_fit(_exact_pairs(spark, d))
    out = spread(out, "t", ("tx", "ty", "tz")).withColumns({
        f"r{i}{j}": L.entry("rotation", i, j) for i, j in ((0, 0), (0, 2), (1, 1))})
    out = out.select("route_id", "n", "reason", "scale", "tx", "ty", "tz", "r00", "r02", "r11")
    return V.rounded(out, 6, *out.columns[3:])


@query("a05_noisy_fit")
def noisy_fit(spark, d):
    out = FT.similarity_fit(V.known_pairs(spark, d))
    return V.rounded(spread(out, "t", ("tx", "ty", "tz")).select("route_id", "n", "reason", "scale", "tx", "ty", "tz"),
                     6, "scale", "tx", "ty", "tz")


# all trials fit exact pairs, so any of them is the best: its number is left out
@query("a07_ransac_fit", W(V.POSES, EXACT, body=f"""
 SELECT route_id, {R(6, score="0.0::DOUBLE", scale="scale", tx="11.0::DOUBLE", r02="r02")} FROM exact"""))
def ransac_fit(spark, d):
    out = FT.ransac_fit(_exact_pairs(spark, d), "pose_key", ["route_id"], 0.4, 0.8, 6)
    return V.rounded(out.select("route_id", "score", "scale", F.col("t.x").alias("tx"), L.entry("rotation", 0, 2).alias("r02")),
                     6, "score", "scale", "tx", "r02")


@query("a07_noisy_ransac_fit")
def noisy_ransac_fit(spark, d):
    out = FT.ransac_fit(V.known_pairs(spark, d), "pose_key", ["route_id"], 0.4, 0.8, 6)
    return V.rounded(out.select("route_id", "trial", "score", "scale"), 6, "score", "scale")


@query("a09_site_fit", W(V.POSES, EXACT, body=f"""
 SELECT site_id, sum(n) AS n, {R(6, scale="any_value(scale)", yaw_scale="any_value(scale)", r00="any_value(r00)", y02="any_value(r02)",
   tx="11.0::DOUBLE", ytz="7.0::DOUBLE")} FROM exact GROUP BY 1"""))
def site_fit(spark, d):
    out = FT.full_and_yaw_fit(_exact_pairs(spark, d), ["site_id"])
    out = out.select("site_id", "n", "scale", "yaw_scale", L.entry("rotation", 0, 0).alias("r00"),
                     L.entry("yaw_rotation", 0, 2).alias("y02"), F.col("t.x").alias("tx"), F.col("yaw_t.z").alias("ytz"))
    return V.rounded(out, 6, *out.columns[2:])


@query("a25_alignment_residual", W(V.POSES, V.KNOWN, body=f"""
 SELECT route_id, {R(6, residual="sqrt(sum((1.5*fx + 1 - tx)**2 + (1.5*fy - ty)**2 + (1.5*fz - 2 - tz)**2)) / count(*)")}
 FROM known GROUP BY 1"""))
def alignment_residual(spark, d):
    prs = V.known_pairs(spark, d)
    fits = prs.groupBy("route_id").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "scale": F.lit(1.5), "rotation": L.identity3(), "t": L.vec(1, 0, -2)})
    return V.rounded(FT.alignment_residual(prs, fits, ["route_id"]), 6, "residual")


@query("a26_scale_agreement", W(V.POSES, V.KNOWN, """
 m AS (SELECT route_id, sqrt((covar_pop(tx, fx) + covar_pop(tz, fz))**2 + (covar_pop(tz, fx) - covar_pop(tx, fz))**2)
   / (var_pop(fx) + var_pop(fz)) AS sc, 1.5 + CAST(route_id % 9 AS DOUBLE) / 10 AS guess FROM known GROUP BY 1)""", body=f"""
 SELECT route_id, {R(6, agreement="least(sc, guess) / greatest(sc, guess)")},
   least(sc, guess) / greatest(sc, guess) > 0.95 AS agrees FROM m"""))
def scale_agreement(spark, d):
    f = FT.planar_fit(V.known_pairs(spark, d)).withColumn("a", FT.scale_agreement(
        "yaw_scale", 1.5 + F.col("route_id") % 9 / 10.0))
    return V.rounded(f.select("route_id", F.col("a").alias("agreement"), (F.col("a") > 0.95).alias("agrees")),
                     6, "agreement")


# ------------------------------------------------------------------ georeferencing

def _geo_frames(spark, d):
    p = with_center(V.poses(spark, d, rotation=True)).drop(*XYZ)
    return p.withColumn("footprint", L.vec(F.col("center.x"), F.col("center.y") + 1.6, F.col("center.z")))


def _geo_out(g):
    out = g.select("route_id", "pose_key", F.col("geo.lon").alias("lon"), F.col("geo.lat").alias("lat"),
                   F.col("geo.elev").alias("elev"), "height",
                   *[F.col("angles")[c].alias(c) for c in ("alpha", "beta", "gamma")])
    return V.rounded(V.rounded(out, 6, "lon", "lat", "alpha", "beta", "gamma"), 4, "elev", "height")


@query("g08_georeference_planar", W(V.POSES, V.ROTATED, V.FIXES, ANCHORS, MATCHES, utm_ctes("matches"), """
 prs AS (SELECT route_id, gps_seq, zone, x AS fx, y AS fy, z AS fz, ue AS tx, -elev AS ty, un AS tz FROM utm
   UNION ALL SELECT route_id, gps_seq, zone, x, y + 1.6, z, ue, -(elev - height), un FROM utm)""",
 YAW.format(src="prs"), """
 zones AS (SELECT route_id, min_by(zone, gps_seq) AS z0 FROM prs GROUP BY 1),
 moved AS (SELECT r.*, z0, sc * (co * x - si * z) + mtx - sc * (co * mfx - si * mfz) AS px,
   sc * y + mty - sc * mfy AS py, sc * (si * x + co * z) + mtz - sc * (si * mfx + co * mfz) AS pz, sc * 1.6 AS hh,
   r00 * co - r02 * si AS w00, r00 * si + r02 * co AS w02, r10 * co - r12 * si AS w10, r11 AS w11,
   r10 * si + r12 * co AS w12, r20 * si + r22 * co AS w22
   FROM rotated r JOIN yaw USING (route_id) JOIN zones USING (route_id) WHERE sc IS NOT NULL AND NOT isnan(sc))""",
 geo_ctes("moved", "px", "pz", "z0"), body=f"""
 SELECT route_id, pose_key, {R(6, lon="glon", lat="glat", alpha="asin(greatest(-1.0, least(1.0, -w12)))",
   beta="atan2(-w02, w22)", gamma="atan2(w10, w11)")}, {R(4, elev="-py", height="hh")} FROM geo"""))
def georeference_planar(spark, d):
    g = GE.georeference_route(_geo_frames(spark, d), A.track_footprints(V.fixes(spark, d)), anchors=8,
                              tolerance_ms=SIX_HOURS, clean=False, mode="planar")
    return _geo_out(g)


@query("g08_combined_track", W(V.POSES, V.ROTATED, V.FIXES, ANCHORS, MATCHES, utm_ctes("matches"), """
 prs AS (SELECT route_id, gps_seq, zone, x AS fx, y AS fy, z AS fz, ue AS tx, -elev AS ty, un AS tz FROM utm
   UNION ALL SELECT route_id, gps_seq, zone, x, y + 1.6, z, ue, -(elev - height), un FROM utm)""",
 YAW.format(src="prs"), """
 zones AS (SELECT route_id, min_by(zone, gps_seq) AS z0 FROM prs GROUP BY 1),
 moved AS (SELECT r.*, z0, sc * (co * x - si * z) + mtx - sc * (co * mfx - si * mfz) AS px,
   sc * y + mty - sc * mfy AS py, sc * (si * x + co * z) + mtz - sc * (si * mfx + co * mfz) AS pz
   FROM rotated r JOIN yaw USING (route_id) JOIN zones USING (route_id) WHERE sc IS NOT NULL AND NOT isnan(sc))""",
 geo_ctes("moved", "px", "pz", "z0"), """
 span AS (SELECT route_id, min(gps_seq) AS head, max(gps_seq) AS tail FROM matches
   WHERE route_id IN (SELECT route_id FROM geo) GROUP BY 1),
 pieces AS (SELECT route_id, 1 AS part, pose_key AS s, glon AS lon, glat AS lat, -py AS elev, ms FROM geo
   UNION ALL SELECT route_id, CASE WHEN seq < head THEN 0 ELSE 2 END, seq, lon, lat, elev, ms
   FROM fixes JOIN span USING (route_id) WHERE seq < head OR seq > tail)""", body=f"""
 SELECT route_id, row_number() OVER (PARTITION BY route_id ORDER BY part, s) - 1 AS seq, part, CAST(ms AS DOUBLE) AS ms,
   {R(6, lon="lon", lat="lat")}, {R(4, elev="elev")} FROM pieces"""))
def combined_track(spark, d):
    g = GE.georeferenced_track(_geo_frames(spark, d), A.track_footprints(V.fixes(spark, d)), anchors=8,
                               tolerance_ms=SIX_HOURS, clean=False, mode="planar")
    return V.rounded(V.rounded(g, 6, "lon", "lat"), 4, "elev")


@query("g08_georeference_full")
def georeference_full(spark, d):
    g = GE.georeference_route(_geo_frames(spark, d), A.track_footprints(V.fixes(spark, d)), anchors=8,
                              tolerance_ms=SIX_HOURS, smooth="anchor")
    return _geo_out(g)


@query("g07_georeference_site")
def georeference_site(spark, d):
    fr = _geo_frames(spark, d).withColumn("site_id", F.col("route_id") % 5)
    g = GE.georeference_site(fr, A.track_footprints(V.fixes(spark, d)), anchors=8, tolerance_ms=SIX_HOURS)
    return _geo_out(g)


# the sub scene is twice as large and turned by 90 degrees about y: (x, y, z) is at (2 z + 1, 2 y, -2 x)
@query("g10_align_sub_to_main", W(V.SHOTS, body=f"""
 SELECT scene_id, 2 * (count(*) - 1) AS n, {R(6, scale="0.5::DOUBLE", tx="0.0::DOUBLE", tz="-0.5::DOUBLE", r02="-1.0::DOUBLE", r11="1.0::DOUBLE")}
 FROM shot_poses GROUP BY 1 HAVING count(*) > 2"""))
def align(spark, d):
    from posegrid.plans.alignment import align_sub_to_main
    views = V.shots(spark, d).select("scene_id", "view_key", "filename")
    main = V.shot_poses(spark, d).withColumn("rotation", L.identity3())
    sub = main.withColumns({"center": L.vec(F.col("center.z") * 2 + 1, F.col("center.y") * 2, F.col("center.x") * -2),
                            "rotation": L.rotation_y(F.lit(-math.pi / 2))})
    out = align_sub_to_main(views, main, views, sub).filter("reason IS NULL")
    out = out.select("scene_id", "n", "scale", F.col("t.x").alias("tx"), F.col("t.z").alias("tz"),
                     L.entry("rotation", 0, 2).alias("r02"), L.entry("rotation", 1, 1).alias("r11"))
    return V.rounded(out, 6, *out.columns[2:])


@query("a20_slice_numbers", W(V.SHOTS, body="""
 SELECT scene_id AS video, slice, row_number() OVER (PARTITION BY scene_id ORDER BY slice) - 1 AS nth, n_frames
 FROM (SELECT scene_id, frame_idx // 100 AS slice, count(*) AS n_frames FROM shots GROUP BY 1, 2)"""))
def slice_numbers(spark, d):
    from posegrid.operators.frames import rekey
    s = V.shots(spark, d).groupBy(F.col("scene_id").alias("video"), F.floor(F.col("frame_idx") / 100)
                                  .alias("slice")).agg(F.count(F.lit(1)).alias("n_frames"))
    return rekey(s, "slice", "nth", ["video"])
