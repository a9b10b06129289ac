"""Queries on captures, manifests, sampling, slices and view pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from posegrid.catalog import views as V
from posegrid.catalog.register import query
from posegrid.functions import names as N
from posegrid.operators import frames as FR
from posegrid.operators import pairs as PR
from posegrid.sources import sinks

W = V.with_views


# ------------------------------------------------------------------ sources of frames

def _grid(kind: str, name_sql: str, cams_sql: str = "NULL::INTEGER") -> tuple[str, object]:
    sql = W(V.CAPTURES, body=f"""
      , grid AS (SELECT *, CAST(floor(("to" - ss) * fps) AS BIGINT) AS n_frames FROM captures),
      framed AS (SELECT capture_id, fps, ss, unnest(range(n_frames)) AS frame_idx FROM grid
                 WHERE n_frames > 0),
      cams AS (SELECT *, {cams_sql} AS cam_id FROM framed)
      SELECT capture_id, frame_idx, cam_id, {name_sql} AS filename,
        {V.sql_round(6, seconds="frame_idx / fps + ss")} FROM cams""".lstrip(" \n,").replace(
        "grid AS", "grid AS", 1))
    # the extra views continue the WITH list
    sql = sql.replace("FROM customer)\ngrid AS", "FROM customer),\ngrid AS")

    def run(spark, d):
        g = FR.capture_grid(V.captures(spark, d), kind)
        return V.rounded(g.select("capture_id", "frame_idx", "cam_id", "filename", "seconds"), 6,
                         "seconds")
    return sql, run


for _kind, _name, _cams in (
        ("single", "printf('%05d.jpg', frame_idx)", "NULL::INTEGER"),
        ("equirect", "printf('%05d.jpg', frame_idx)", "NULL::INTEGER"),
        ("list", "printf('%d_%05d.jpg', capture_id, frame_idx)", "NULL::INTEGER"),
        ("rig", "printf('%05d_%d.jpg', frame_idx, cam_id)", "unnest([1, 2, 3, 4, 5, 6])")):
    _sql, _run = _grid(_kind, _name, _cams)
    query(f"s10_capture_grid_{_kind}", _sql)(_run)


@query("s08_p01_manifest", W(V.SHOTS, body="""
  SELECT scene_id, filename, CAST(split_part(split_part(filename, '.', 1), '_', 1) AS BIGINT) AS key_idx,
    CAST(split_part(split_part(filename, '.', 1), '_', 2) AS INTEGER) AS cam,
    split_part(filename, '.', 1) AS stem, contains(filename, '_mask') AS is_mask FROM (
    SELECT scene_id, filename FROM shots
    UNION ALL SELECT scene_id, replace(filename, '.jpg', '_mask.png') FROM shots WHERE view_key % 4 = 0)"""))
def manifest(spark, d):
    s = V.shots(spark, d).select("scene_id", "filename", "view_key")
    masks = s.filter("view_key % 4 = 0").withColumn(
        "filename", F.regexp_replace("filename", r"\.jpg$", "_mask.png"))
    m = FR.manifest(s.unionByName(masks))
    return m.select("scene_id", "filename", "key_idx", N.camera_index("filename").alias("cam"),
                    N.stem("filename").alias("stem"), "is_mask")


@query("a19_files_per_key", W(V.SHOTS, body="""
  SELECT scene_id, filename, row_number() OVER w - 1 AS file_no,
    count(*) OVER (PARTITION BY scene_id) AS n_files
  FROM shots WINDOW w AS (PARTITION BY scene_id ORDER BY filename)"""))
def files_per_key(spark, d):
    s = V.shots(spark, d).select("scene_id", "filename")
    return FR.files_per_key(s, ["scene_id"], digits=4)


@query("s09_f10_key_frames", W(V.SHOTS, body="""
  SELECT scene_id, frame_idx, cam_id, filename FROM shots
  WHERE frame_idx IN (SELECT l_orderkey // 3 FROM lineitem WHERE l_returnflag = 'R')"""))
def keep_key_frames(spark, d):
    keys = V.table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(
        (F.col("l_orderkey") / 3).cast("bigint").alias("frame_idx")).distinct()
    return FR.keep_key_frames(V.shots(spark, d), keys, ["frame_idx"]).select(
        "scene_id", "frame_idx", "cam_id", "filename")


@query("f11_uniform_video_sample", W(V.SHOTS, body="""
  SELECT scene_id, filename FROM (
    SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY view_key) - 1 AS p FROM shots)
  WHERE p % 7 = 0"""))
def uniform_video_sample(spark, d):
    return FR.uniform_video_sample(V.shots(spark, d), 7, order="view_key").select(
        "scene_id", "filename")


@query("f12_uniform_rig_sample", W(V.SHOTS, V.KEY_FRAMES, body="""
  SELECT s.scene_id, s.filename FROM shots s JOIN key_frames k USING (scene_id, frame_idx)
  WHERE p >= 2 AND (p - 2) % 5 = 0"""))
def uniform_rig_sample(spark, d):
    return FR.uniform_rig_sample(V.shots(spark, d), 5).select("scene_id", "filename")


@query("f13_all_frames", W(V.SHOTS, body="SELECT scene_id, frame_idx, cam_id, filename FROM shots"))
def all_frames(spark, d):
    return FR.all_frames(V.shots(spark, d)).select("scene_id", "frame_idx", "cam_id", "filename")


# ------------------------------------------------------------------ slices

SLICES = """slices AS (
  SELECT scene_id, CAST(i AS BIGINT) AS slice, n, k, p0,
    CASE WHEN i = k - 1 THEN greatest(0, n - 25) ELSE i * 25 END AS beg,
    CASE WHEN i = k - 1 THEN n ELSE (i + 1) * 25 END AS en
  FROM (SELECT *, unnest(range(k)) AS i FROM (
    SELECT scene_id, n, greatest(1, CAST(ceil(n / 25) AS BIGINT)) AS k, 0 AS p0
    FROM key_frames GROUP BY ALL)))"""


@query("w10_slice_frames", W(V.SHOTS, V.KEY_FRAMES, SLICES, body="""
  SELECT s.scene_id, s.slice, f.frame_idx, 'body' AS role
  FROM slices s JOIN key_frames f ON f.scene_id = s.scene_id AND f.p >= s.beg AND f.p < s.en
  UNION ALL
  SELECT s.scene_id, s.slice, f.frame_idx, 'halo' FROM slices s JOIN key_frames f
  ON f.scene_id = s.scene_id AND ((s.beg - f.p) IN (1, 2, 3, 5, 7) OR (f.p - s.en + 1) IN (1, 2, 3, 5, 7))"""))
def slice_frames(spark, d):
    return FR.slice_frames(V.key_frames(spark, d), 25, [(1, 3), (2, 2)]).select(
        "scene_id", "slice", "frame_idx", "role")


BOUNDS = """bounds AS (
  SELECT s.scene_id, s.slice, CASE WHEN s.slice = 0 THEN 4.0 ELSE b.frame_idx / 2.0 + 4.0 END AS slice_beg,
    coalesce(e.frame_idx / 2.0 + 4.0, 1e7) AS slice_end
  FROM slices s JOIN key_frames b ON b.scene_id = s.scene_id AND b.p = s.slice * 25
  LEFT JOIN key_frames e ON e.scene_id = s.scene_id AND e.p = (s.slice + 1) * 25)"""


@query("w10_slice_bounds", W(V.SHOTS, V.KEY_FRAMES, SLICES, BOUNDS, body="""
  SELECT scene_id, slice, CAST(slice_beg AS DOUBLE) AS slice_beg, CAST(slice_end AS DOUBLE) AS slice_end
  FROM bounds"""))
def slice_bounds(spark, d):
    return FR.slice_bounds(V.key_frames(spark, d), 25)


@query("j15_dense_frames_to_slices", W(V.SHOTS, V.KEY_FRAMES, SLICES, BOUNDS, body="""
  SELECT f.scene_id, f.view_key, b.slice
  FROM shots f JOIN bounds b ON b.scene_id = f.scene_id
   AND (b.slice = 0 OR f.view_key / 6.0 + 4 >= b.slice_beg)
   AND (f.view_key / 6.0 + 4 < b.slice_end OR b.slice_end = 1e7)"""))
def dense_frames(spark, d):
    dense = V.shots(spark, d).select(
        "scene_id", "view_key", N.frame_seconds("view_key", F.lit(6.0), F.lit(4.0)).alias("seconds"))
    out = FR.assign_dense_frames(dense, FR.slice_bounds(V.key_frames(spark, d), 25))
    return out.select("scene_id", "view_key", "slice")


@query("w11_key_frame_slices", W(V.SHOTS, V.KEY_FRAMES, SLICES, """
 cnt AS (SELECT scene_id, count(*) AS n_dense FROM shots GROUP BY 1),
 mids AS (SELECT s.scene_id, s.slice, (b.frame_idx + coalesce(b2.frame_idx, b.frame_idx)) / 2.0 / n_dense AS mid
   FROM slices s JOIN cnt USING (scene_id)
   JOIN key_frames b ON b.scene_id = s.scene_id AND b.p = s.slice * 25
   LEFT JOIN key_frames b2 ON b2.scene_id = s.scene_id AND b2.p = s.slice * 25 + 1)""", body=f"""
 SELECT m.scene_id, m.slice, {V.sql_round(9, slice_beg="CASE WHEN m.slice = 0 THEN 0.0 ELSE m.mid END",
                                         slice_end="coalesce(x.mid, 1.0)")}
 FROM mids m LEFT JOIN mids x ON x.scene_id = m.scene_id AND x.slice = m.slice + 1"""))
def key_frame_slices(spark, d):
    counts = V.shots(spark, d).groupBy("scene_id").agg(F.count(F.lit(1)).alias("n_dense"))
    out = FR.key_frame_bounds(V.key_frames(spark, d), counts, 25)
    return V.rounded(out, 9, "slice_beg", "slice_end")


@query("w11_assign_by_fraction", W(V.SHOTS, V.KEY_FRAMES, SLICES, """
 cnt AS (SELECT scene_id, count(*) AS n_dense FROM shots GROUP BY 1),
 mids AS (SELECT s.scene_id, s.slice, (b.frame_idx + coalesce(b2.frame_idx, b.frame_idx)) / 2.0 / n_dense AS mid
   FROM slices s JOIN cnt USING (scene_id)
   JOIN key_frames b ON b.scene_id = s.scene_id AND b.p = s.slice * 25
   LEFT JOIN key_frames b2 ON b2.scene_id = s.scene_id AND b2.p = s.slice * 25 + 1)""", body="""
 SELECT f.scene_id, f.view_key, coalesce(max(m.slice), 0) AS slice FROM shots f JOIN cnt USING (scene_id)
 LEFT JOIN mids m ON m.scene_id = f.scene_id AND m.slice > 0 AND f.frame_idx / CAST(n_dense AS DOUBLE) >= m.mid
 WHERE f.scene_id IN (SELECT scene_id FROM slices) GROUP BY 1, 2"""))
def frames_by_fraction(spark, d):
    shots = V.shots(spark, d)
    counts = shots.groupBy("scene_id").agg(F.count(F.lit(1)).alias("n_dense"))
    bounds = FR.key_frame_bounds(V.key_frames(spark, d), counts, 25)
    scenes = bounds.select("scene_id").distinct()
    dense = shots.select("scene_id", "view_key", "frame_idx").join(scenes, "scene_id", "left_semi")
    return FR.assign_by_fraction(dense, counts, bounds).select("scene_id", "view_key", "slice")


@query("w13_rekey", W(V.SHOTS, body="""
  SELECT scene_id, pose_key, row_number() OVER (PARTITION BY scene_id ORDER BY pose_key) - 1 AS new_key
  FROM shot_poses"""))
def rekey(spark, d):
    return FR.rekey(V.shot_poses(spark, d).select("scene_id", "pose_key"), "pose_key")


# ------------------------------------------------------------------ capture tables

@query("p02_p03_frame_times", W(V.POSES, V.FIXES, f"""
 firsts AS (SELECT route_id, min_by(ms, seq) AS start_ms FROM fixes GROUP BY 1)""", body=f"""
 SELECT route_id, pose_key, {V.sql_round(3, seconds="pose_key / 10.0 + 4.0",
   abs_ms="start_ms + (pose_key / 10.0 + 4.0) * 1000")} FROM poses JOIN firsts USING (route_id)"""))
def frame_times(spark, d):
    from posegrid.operators.anchor import absolute_times
    p = V.poses(spark, d).select("route_id", "pose_key", N.frame_seconds(
        "pose_key", F.lit(10.0), F.lit(4.0)).alias("timestamp"))
    out = absolute_times(p, V.fixes(spark, d)).select(
        "route_id", "pose_key", F.col("timestamp").alias("seconds"), F.col("ms").alias("abs_ms"))
    return V.rounded(out, 3, "seconds", "abs_ms")


@query("p28_capture_metadata", W(V.CAPTURES, body=f"""
 SELECT capture_id, {V.sql_round(6, small_focal="focal_length / 8", face_focal="1024 / 2.0",
   fish_focal="focal_length * 0.8")}, 3 AS face_model FROM captures"""))
def capture_metadata(spark, d):
    c = V.captures(spark, d)
    small = FR.downsized(c, 3).select("capture_id", F.col("focal_length").alias("small_focal"))
    face = FR.cube_face_capture(c).select("capture_id", F.col("focal_length").alias("face_focal"),
                                          F.col("camera_model").alias("face_model"))
    fish = FR.undistorted_capture(c, "focal_length").select(
        "capture_id", F.col("focal_length").alias("fish_focal"))
    out = small.join(face, "capture_id").join(fish, "capture_id")
    return V.rounded(out, 6, "small_focal", "face_focal", "fish_focal")


@query("p29_face_views", W(V.SHOTS, body="""
 SELECT scene_id, filename, face, replace(filename, '.jpg', '') || '_' || face || '.jpg' AS face_filename, dense
 FROM (SELECT *, unnest([0, 1, 2, 3]) AS face, false AS dense FROM shots
   UNION ALL SELECT *, unnest([0, 4, 1, 5, 2, 6, 3, 7]) AS face, true AS dense FROM shots)"""))
def face_views(spark, d):
    s = V.shots(spark, d).select("scene_id", "filename")
    a = FR.face_views(s).withColumn("dense", F.lit(False))
    return a.unionByName(FR.face_views(s, dense=True).withColumn("dense", F.lit(True)))


@query("f25_window_violations", W(V.CAPTURES, body="""
 SELECT capture_id, CASE WHEN ss > "to" THEN 'ss is after to' WHEN ss < 0 THEN 'ss is negative'
   ELSE 'to is after the end' END AS reason
 FROM captures WHERE ss > "to" OR ss < 0 OR "to" > length"""))
def window_violations(spark, d):
    return FR.window_violations(V.captures(spark, d)).select("capture_id", "reason")


@query("k09_stationary_trajectory", W(V.CAPTURES, body="""
 SELECT capture_id, unnest([0.0, duration_ms]) AS t_ms, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y, 0.0::DOUBLE AS z,
   0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, 0.0::DOUBLE AS qz, 1.0::DOUBLE AS qw
 FROM captures WHERE movement_type = 'stationary'"""))
def stationary(spark, d):
    return FR.stationary_trajectory(V.captures(spark, d))


@query("p23_rainbow", W(V.SHOTS, """
 hue AS (SELECT scene_id, pose_key,
   CASE WHEN n > 1 THEN (2.0::DOUBLE / 3.0) * i / (n - 1) ELSE 0 END AS g FROM (
   SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY pose_key) - 1 AS i,
     count(*) OVER (PARTITION BY scene_id) AS n FROM shot_poses)),
 hues AS (SELECT *, g + 1.0::DOUBLE / 3 AS r,
   CASE WHEN g - 1.0::DOUBLE / 3 < 0 THEN g - 1.0::DOUBLE / 3 + 1 ELSE g - 1.0::DOUBLE / 3 END AS b FROM hue)""",
 body="SELECT scene_id, pose_key, " + ", ".join(
     f"CAST(floor(255 * CASE WHEN {c} < 1.0::DOUBLE / 6 THEN {c} * 6 WHEN {c} < 0.5 THEN 1 "
     f"WHEN {c} < 2.0::DOUBLE / 3 THEN (2.0::DOUBLE / 3 - {c}) * 6 ELSE 0 END) AS INTEGER) AS {n}"
     for c, n in (("r", "red"), ("g", "green"), ("b", "blue"))) + " FROM hues"))
def rainbow(spark, d):
    from posegrid.scale import line, ordered
    p = V.shot_poses(spark, d).select("scene_id", "pose_key")
    rows = ordered(p, line("scene_id", "pose_key"), position="_i", size="_n")
    c = N.rainbow("_i", "_n")
    return rows.select("scene_id", "pose_key", *[c[k].alias(k) for k in ("red", "green", "blue")])


@query("p30_s13_name_keys", """
 SELECT p_partkey, replace(replace(p_name, ' ', '/'), '/', '_') AS base_name,
   replace(replace(p_name, ' ', '/'), '/', '_') || '_' || p_brand AS folder,
   CASE WHEN length(CAST(p_partkey % 2000 AS VARCHAR)) < 3 THEN lpad(CAST(p_partkey % 2000 AS VARCHAR), 3, '0')
     ELSE CAST(p_partkey % 2000 AS VARCHAR) END AS slice_label FROM part""")
def name_keys(spark, d):
    p = V.table(spark, d, "part").withColumn("repo", F.regexp_replace("p_name", " ", "/"))
    base = N.repository_base("repo")
    return p.select("p_partkey", base.alias("base_name"),
                    N.repository_folder(base, "p_brand").alias("folder"),
                    N.slice_label(F.col("p_partkey") % 2000).alias("slice_label"))


@query("p31_marker_times", W(V.MARKERS, body=f"""
 SELECT n.route_id, n.node_id, {V.sql_round(3, node_s="n.begin_ms / 1000.0", ss="s.begin_ms / 1000.0",
   to_s="s.end_ms / 1000.0")} FROM nodes n JOIN spans s USING (route_id)"""))
def marker_times(spark, d):
    m = FR.marker_times(V.markers(spark, d)).withColumnRenamed("to", "to_s")
    return V.rounded(m, 3, "node_s", "ss", "to_s")


@query("p32_log_time", """
 SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d-%H-%M-%S') AS log_time FROM events""")
def log_time(spark, d):
    return V.table(spark, d, "events").select("event_id", N.log_time(F.col("ts").cast("timestamp"))
                                              .alias("log_time"))


@query("f20_timestamp_violations", W(V.SHOTS, body="""
 SELECT scene_id AS route_id, count(*) AS n_frames,
   count(*) FILTER (WHERE t <= before) AS n_violations FROM (
   SELECT *, lag(t) OVER (PARTITION BY scene_id ORDER BY view_key) AS before
   FROM (SELECT *, view_key * 10 - view_key % 37 AS t FROM shots)) GROUP BY 1"""))
def timestamp_violations(spark, d):
    s = V.shots(spark, d).select(F.col("scene_id").alias("route_id"), F.col("view_key").alias("frame_idx"),
                                 (F.col("view_key") * 10 - F.col("view_key") % 37).alias("timestamp"))
    return FR.timestamp_violations(s)


@query("f21_adjacent_slices", W(V.SHOTS, """
 sl AS (SELECT DISTINCT scene_id AS video, frame_idx // 8 AS slice FROM shots)""", body="""
 SELECT a.video, a.slice AS main_slice, b.slice AS sub_slice FROM sl a JOIN sl b
 ON a.video = b.video AND b.slice = a.slice + 1 WHERE a.slice % 9 <> 4 AND b.slice % 9 <> 4"""))
def adjacent_slices(spark, d):
    s = V.shots(spark, d).select(F.col("scene_id").alias("video"), F.floor(F.col("frame_idx") / 8)
                                 .alias("slice")).distinct()
    return FR.adjacent_slice_pairs(s.withColumn("is_scene", F.col("slice") % 9 != 4))


@query("f21_needs_matching", W(V.SHOTS, """
 sl AS (SELECT DISTINCT scene_id AS video, frame_idx // 8 AS slice FROM shots)""", body="""
 SELECT a.video, a.slice AS main_slice, b.slice AS sub_slice,
  CASE WHEN a.slice % 9 <> 4 THEN NOT (b.slice % 9 <> 4 AND b.slice - a.slice = 1) END AS needs_matching
 FROM sl a JOIN sl b ON a.video = b.video AND b.slice IN (a.slice + 1, a.slice + 2)"""))
def needs_matching(spark, d):
    s = V.shots(spark, d).select(F.col("scene_id").alias("video"), F.floor(F.col("frame_idx") / 8)
                                 .alias("slice")).distinct()
    steps = F.explode(F.array(F.lit(1), F.lit(2)))
    pairs = s.withColumn("main_slice", F.col("slice")).withColumn("_step", steps).withColumn(
        "slice", F.col("slice") + F.col("_step")).join(s, ["video", "slice"])
    scene = lambda c: F.col(c) % 9 != 4
    return pairs.select("video", "main_slice", F.col("slice").alias("sub_slice"), FR.needs_matching(
        "video", "main_slice", scene("main_slice"), "video", "slice", scene("slice")).alias("needs_matching"))


# ------------------------------------------------------------------ view pairs

SHOTP = """shotp AS (
  SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY view_key) - 1 AS p,
    count(*) OVER (PARTITION BY scene_id) AS n FROM shots)"""


@query("j08_window_pairs", W(V.SHOTS, SHOTP, body="""
 SELECT a.scene_id, a.id_view AS view_a, b.id_view AS view_b FROM shotp a JOIN shotp b
 ON a.scene_id = b.scene_id AND b.p > a.p AND b.p <= a.p + 5"""))
def window_pairs(spark, d):
    return PR.window_pairs(V.shots(spark, d), 5)


@query("k06_pair_lines", W(V.SHOTS, SHOTP, body="""
 SELECT a.scene_id, a.id_view || ' ' || b.id_view AS value FROM shotp a JOIN shotp b
 ON a.scene_id = b.scene_id AND b.p > a.p AND b.p <= a.p + 2"""))
def pair_lines(spark, d):
    return PR.pair_lines(PR.window_pairs(V.shots(spark, d), 2))


@query("j09_backbone_runs", W(V.SHOTS, SHOTP, body="""
 SELECT scene_id, id_view AS view_a, 0 AS from_pos, p - 1 AS to_pos FROM shotp WHERE p % 10 = 0 AND p > 0
 UNION ALL SELECT scene_id, id_view, p + 1, n - 1 FROM shotp WHERE p % 10 = 0 AND p < n - 1"""))
def backbone_runs(spark, d):
    return PR.backbone_runs(V.shots(spark, d), 10)


@query("j10_rig_ring_pairs", W(V.RIG, body="""
 SELECT b.scene_id, a.id_view AS view_a, b.id_view AS view_b
 FROM (SELECT *, least(4, count(*) OVER (PARTITION BY scene_id) - (p // 4) * 4) AS held FROM rigp) b JOIN rigp a
 ON a.scene_id = b.scene_id AND a.p = (b.p // 4) * 4 + (b.p % 4 + b.held - 1) % b.held WHERE b.held > 1"""))
def rig_ring(spark, d):
    return PR.rig_ring_pairs(V.rig(spark, d), 4)


@query("j11_rig_near_pairs", W(V.RIG, body="""
 SELECT b.scene_id, a.id_view AS view_a, b.id_view AS view_b FROM rigp b
 CROSS JOIN (SELECT unnest([1, 2]) AS df) CROSS JOIN (SELECT unnest([3, 4, 5]) AS dc)
 JOIN rigp a ON a.scene_id = b.scene_id AND a.p = (b.p // 4 - df) * 4 + (b.p % 4 + dc) % 4
 WHERE b.p // 4 >= df"""))
def rig_near(spark, d):
    return PR.rig_near_pairs(V.rig(spark, d), 4, 2)


@query("j12_rig_far_runs", W(V.RIG, body="""
 SELECT scene_id, id_view AS view_a, (p // 4 + 3) * 4 AS from_pos, n - 1 AS to_pos FROM rigp
 WHERE (p // 4 + 3) * 4 <= n - 1"""))
def rig_far(spark, d):
    return PR.rig_far_runs(V.rig(spark, d), 4, 2)
