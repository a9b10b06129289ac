"""Scene alignment jobs: sub scene to main scene, and levelling a mesh by its floor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.functions.names import stem
from posegrid.operators import fit, mesh
from posegrid.operators.poses import pair_scenes, step_anchor, views_with_poses


def _posed(views: DataFrame, poses: DataFrame, anchors: bool) -> DataFrame:
    p = poses.drop("footprint")
    p = step_anchor(p) if anchors else p
    return views_with_poses(views, p).withColumn("stem", stem("filename")) \
        .withColumnRenamed("view_key", "pose_key")


def paired_points(pairs: DataFrame, anchors: bool) -> DataFrame:
    """Sub-to-main point pairs: camera centres and, stacked below, step anchors."""
    kinds = [F.struct(F.lit("camera").alias("kind"), F.col("sub_center").alias("f"),
                      F.col("main_center").alias("t"))]
    if anchors:
        kinds.append(F.struct(F.lit("footprint").alias("kind"), F.col("sub_footprint").alias("f"),
                              F.col("main_footprint").alias("t")))
    rows = pairs.withColumn("_k", F.explode(F.array(*kinds)))
    return fit.pairs(rows.withColumns({"_f": F.col("_k.f"), "_t": F.col("_k.t")}), "_f", "_t",
                     "scene_id", "main_key")


def align_sub_to_main(main_views: DataFrame, main_poses: DataFrame, sub_views: DataFrame,
                      sub_poses: DataFrame, anchors: bool = True) -> DataFrame:
    """Similarity that moves each sub scene onto its main scene, from the poses of shared images.

    All tables share ``scene_id``, the id of the (main, sub) pair. Result: ``scene_id, scale,
    rotation, t, matrix, n, reason``.
    """
    m = _posed(main_views, main_poses, anchors)
    s = _posed(sub_views, sub_poses, anchors)
    prs = paired_points(pair_scenes(m, s, skip_last=anchors), anchors)
    fits = fit.similarity_fit(prs, ["scene_id"])
    return fits.withColumn("matrix", F.when(F.col("reason").isNull(),
                                            L.to_mat4("scale", "rotation", "t")))


def level_by_floor(vertices: DataFrame, faces: DataFrame, clusters: int = 50,
                   normal_threshold: float = 0.9, min_segment: int = 0,
                   floor_threshold: float = 0.9) -> DataFrame:
    """4x4 per mesh that levels it: cluster its flat vertices, grow a planar segment from each cluster
    seed, keep segments facing the floor, fit their plane."""
    labelled, centres = mesh.cluster_flat_vertices(vertices, clusters)
    seed_v = mesh.cluster_seed_vertices(labelled, centres)
    seed_f = mesh.vertex_flat_faces(vertices, faces, seed_v)
    seeds = seed_v.join(seed_f, ["mesh_id", "vid"]).select(
        "mesh_id", F.col("cluster").alias("seed_no"), "fid")
    segments = mesh.grow_segments(faces, vertices, seeds, normal_threshold)
    normals = mesh.face_normals(faces, vertices).select("mesh_id", "fid", "normal")
    seed_normals = seeds.join(normals, ["mesh_id", "fid"]).select(
        "mesh_id", F.col("seed_no").alias("segment"), "normal")
    summary = mesh.segment_summary(faces, vertices, segments, seed_normals, 0.0, min_segment)
    floor = mesh.aligned_segments(summary, floor_threshold).select("mesh_id", "segment")
    floor_faces = faces.join(segments.join(floor, ["mesh_id", "segment"], "left_semi"),
                             ["mesh_id", "fid"], "left_semi")
    return mesh.level_rotation(floor_faces, vertices)
