"""Pose tables: joins with views, refiners, footprints and step lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.functions import names as N
from posegrid.scale import attach, checkpointed, line, name_blocks, order_stats, ordered, state_scan

STEP_FACTOR = 4.0


# ------------------------------------------------------------------ joins

def views_with_poses(views: DataFrame, poses: DataFrame) -> DataFrame:
    """Views that have a pose, joined on key (both sides unique per key)."""
    return views.join(poses.withColumnRenamed("pose_key", "view_key"), ["scene_id", "view_key"])


def reorder(views: DataFrame, poses: DataFrame, digits: int = 3) -> DataFrame:
    """New keys in file-stem order over all views, then only views with a pose."""
    named = name_blocks(views.withColumn("stem", N.stem("filename")), ["scene_id"], "stem", digits)
    ranked = ordered(named, line("scene_id", ("stem", "view_key"), blocks=(F.col("_block"),)),
                     position="new_key").drop("_block")
    return views_with_poses(ranked, poses)


def reduce_views(reference: DataFrame, match: DataFrame, match_poses: DataFrame) -> DataFrame:
    """Views of ``match`` whose stem occurs in ``reference``, with their poses."""
    stems = reference.select(N.stem("filename").alias("stem")).distinct()
    kept = match.withColumn("stem", F.regexp_replace("filename", r"\.[^.]*$", "")) \
        .join(stems, "stem", "left_semi")
    return views_with_poses(kept, match_poses)


def pair_scenes(main: DataFrame, sub: DataFrame, skip_last: bool = False) -> DataFrame:
    """Poses of the same image in two scenes, by stem. Both sides: ``stem, pose_key, center,
    rotation`` and optionally ``footprint``. The last main key can be left out (its step anchor is
    not its own)."""
    m = main.select("scene_id", "stem", F.col("pose_key").alias("main_key"),
                    *[F.col(c).alias(f"main_{c}") for c in main.columns
                      if c in ("center", "rotation", "footprint")])
    if skip_last:
        last = m.groupBy("scene_id").agg(F.max("main_key").alias("_last"),
                                         F.count(F.lit(1)).alias("n"))
        m = attach(m, last, "scene_id").filter(F.col("main_key") < F.col("_last")) \
            .drop("_last", "n")
    s = sub.select("scene_id", "stem", F.col("pose_key").alias("sub_key"),
                   *[F.col(c).alias(f"sub_{c}") for c in sub.columns
                     if c in ("center", "rotation", "footprint")])
    return m.join(s, ["scene_id", "stem"])


def drop_main_rows(expanded: DataFrame, main: DataFrame, n_main: DataFrame,
                   prefix: str = "sub_") -> DataFrame:
    """Rows of an expanded scene that are not in the main scene, keys re-based, prefix removed."""
    rest = expanded.join(main.select("scene_id", "view_key"), ["scene_id", "view_key"],
                         "left_anti")
    return attach(rest, n_main, "scene_id").withColumns({
        "view_key": F.col("view_key") - F.col("n_main"),
        "filename": F.regexp_replace("filename", prefix, "")}).drop("n_main")


# ------------------------------------------------------------------ rig refiners

def rig_mean(views: DataFrame, n_cams: int) -> DataFrame:
    """Give every available view of a rig frame the mean camera centre of that frame.

    ``views``: ``scene_id, pos, center`` with NULL where a view has no pose; a frame is
    ``n_cams`` consecutive listing positions, so each window holds at most that many rows.
    """
    w = Window.partitionBy("scene_id", "frame")
    mean = L.vec(*[F.avg(F.col("center")[a]).over(w) for a in L.AXES])
    return views.withColumn("frame", F.floor(F.col("pos") / n_cams)).withColumn(
        "center", F.when(F.col("center").isNotNull(), mean))


def merge_lenses(lenses: DataFrame, rotation_lens: int = 0,
                 keys: Sequence[str] = ("scene_id", "frame_idx")) -> DataFrame:
    """Frame pose from its lenses: mean position and footprint, rotation of one lens. Frames with a
    missing lens pose are dropped. ``lenses``: ``lens, center, rotation, footprint``."""
    has_fp = F.bool_and(F.col("footprint").isNotNull())
    merged = lenses.groupBy(*keys).agg(
        F.bool_and(F.col("center").isNotNull() & F.col("rotation").isNotNull()).alias("_whole"),
        L.vec(*[F.avg(F.col("center")[a]) for a in L.AXES]).alias("position"),
        F.max(F.when(F.col("lens") == rotation_lens, F.col("rotation"))).alias("rotation"),
        F.when(has_fp, L.vec(*[F.avg(F.col("footprint")[a]) for a in L.AXES])).alias("footprint"),
        F.count(F.lit(1)).alias("n_lenses"))
    return merged.filter("_whole").drop("_whole")


def lens_poses(frame_lens: DataFrame, views: DataFrame, poses: DataFrame) -> DataFrame:
    """Look up the pose of every lens image by file name; missing poses stay NULL."""
    v = views.select("scene_id", "filename", F.col("id_pose").alias("pose_key"))
    return frame_lens.join(v, ["scene_id", "filename"], "left").join(
        poses, ["scene_id", "pose_key"], "left")


def rig_spacing(centers: DataFrame, order: str = "pos") -> DataFrame:
    """30th nearest-rank percentile of the distance between consecutive centres, per scene."""
    flat = centers.select("scene_id", order, *[F.col("center")[a].alias(a) for a in L.AXES])
    nxt = ordered(flat, line("scene_id", order), following={f"_{a}": a for a in L.AXES})
    steps = nxt.filter(F.col("_x").isNotNull()).select(
        "scene_id", L.dist(L.vec("x", "y", "z"), L.vec("_x", "_y", "_z")).alias("step"))
    return order_stats(steps, "scene_id", "step", {"rig_dist": 0.3})


def two_means(frames: DataFrame) -> DataFrame:
    """Best split of each frame's few camera centres into two clusters.

    ``frames``: ``scene_id, frame, centers array<point>``. All two-way splits are compared, many
    frames at a time, so the result does not depend on a random start.
    """
    import numpy as np
    import pandas as pd

    def split(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            out = np.zeros((len(pdf), 6))
            sizes = pdf["centers"].map(len).to_numpy()
            for m in np.unique(sizes):
                at = np.flatnonzero(sizes == m)
                pts = np.array([[[p["x"], p["y"], p["z"]] for p in pdf["centers"].iat[i]]
                                for i in at], dtype=float)
                best = np.full(len(at), np.inf)
                res = np.concatenate([pts.mean(1), pts.mean(1)], axis=1)
                for bits in range(1, 2 ** (m - 1)):
                    side = np.array([(bits >> j) & 1 for j in range(m)], dtype=bool)
                    a, b = pts[:, ~side], pts[:, side]
                    ca, cb = a.mean(1), b.mean(1)
                    cost = ((a - ca[:, None]) ** 2).sum((1, 2)) + \
                        ((b - cb[:, None]) ** 2).sum((1, 2))
                    better = cost < best - 1e-12
                    best = np.where(better, cost, best)
                    res[better] = np.concatenate([ca, cb], axis=1)[better]
                out[at] = res
            yield pd.DataFrame({"scene_id": pdf["scene_id"], "frame": pdf["frame"],
                                **{c: out[:, i] for i, c in
                                   enumerate(["ax", "ay", "az", "bx", "by", "bz"])}})

    key = frames.schema["scene_id"].dataType.simpleString()
    ddl = f"scene_id {key}, frame bigint, " + ", ".join(
        f"{c} double" for c in ["ax", "ay", "az", "bx", "by", "bz"])
    cen = frames.select("scene_id", "frame", "centers").mapInPandas(split, ddl)
    return cen.select("scene_id", "frame", L.vec("ax", "ay", "az").alias("c0"),
                      L.vec("bx", "by", "bz").alias("c1"))


def longest_run(frames: DataFrame, good: str = "good", order: str = "idx",
                keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """First longest run of good rows per group: ``run_beg, run_end`` (dense ``order``) and ``n``.
    Groups without a good row have a run of length zero."""
    marked = frames.select(*keys, order, good, (~F.col(good)).cast("bigint").alias("_bad"))
    isl = ordered(marked, line(keys, order), running={"_island": "_bad"})
    runs = isl.groupBy(*keys, "_island").agg(
        F.min(F.when(F.col(good), F.col(order))).alias("run_beg"),
        F.max(F.when(F.col(good), F.col(order))).alias("run_end"),
        F.count_if(F.col(good)).alias("_len"), F.count(F.lit(1)).alias("_rows"))
    pick = F.struct(-F.col("_len"), F.col("_island"))
    return runs.groupBy(*keys).agg(F.min_by("run_beg", pick).alias("run_beg"),
                                   F.min_by("run_end", pick).alias("run_end"),
                                   F.max("_len").alias("run_length"),
                                   F.sum("_rows").alias("n"))


def rig_center(views: DataFrame, n_cams: int) -> DataFrame:
    """Repair rig frames whose cameras fall into two clusters.

    Frames with more than half of their views are kept. A frame is good when its two cluster
    centres are closer than three rig spacings. From the longest good run outwards, each bad frame
    takes the cluster centre closest to the extrapolation of its two neighbours; lenses farther
    than three spacings from it are moved there. ``views``: ``scene_id, pos, center``.
    """
    v = views.withColumn("frame", F.floor(F.col("pos") / n_cams))
    per_frame = v.filter("center IS NOT NULL").groupBy("scene_id", "frame").agg(
        F.sort_array(F.collect_list(F.struct("pos", "center"))).alias("_s")) \
        .withColumn("centers", F.col("_s.center")).filter(F.size("centers") > n_cams // 2)
    per_frame = checkpointed(per_frame)
    valid = per_frame.select("scene_id", "frame", F.explode("_s").alias("_v")) \
        .select("scene_id", F.col("_v.pos").alias("pos"), F.col("_v.center").alias("center"))
    spacing = rig_spacing(valid)
    def average(axis: str) -> Column:
        return F.aggregate("centers", F.lit(0.0), lambda s, p: s + p[axis]) / F.size("centers")

    mean = L.vec(*[average(a) for a in L.AXES])
    frames = per_frame.join(two_means(per_frame), ["scene_id", "frame"]) \
        .withColumn("mean", mean).drop("_s", "centers")
    frames = attach(frames, spacing, "scene_id").withColumn(
        "good", L.dist("c0", "c1") < 3 * F.col("rig_dist"))
    frames = ordered(frames.drop("n"), line("scene_id", "frame"), position="idx")
    for k in (0, 1):
        frames = frames.withColumns({
            f"e{k}{a}": F.when(F.col("good"), F.col("mean")[a]).otherwise(F.col(f"c{k}")[a])
            for a in L.AXES})
    frames = checkpointed(frames)
    run = checkpointed(longest_run(frames))
    chosen = _outward_choice(frames, run)
    fix = L.vec(*[F.when(F.col("choice") == 1, F.col(f"e1{a}")).otherwise(F.col(f"e0{a}"))
                  for a in L.AXES])
    none_good = F.col("run_length") == 0
    target = chosen.select("scene_id", "frame", "good", "rig_dist",
                           F.when(none_good, F.col("mean")).otherwise(fix).alias("_target"))
    out = v.join(target, ["scene_id", "frame"], "left")
    far = (~F.col("good")) & (L.dist("center", "_target") > 3 * F.col("rig_dist"))
    return out.withColumn("center", F.when(far & F.col("center").isNotNull(), F.col("_target"))
                          .otherwise(F.col("center"))).select(*views.columns)


def _outward_choice(frames: DataFrame, run: DataFrame) -> DataFrame:
    """Choice 0/1 of every frame. Each frame is a step table over the choices of its two inner
    neighbours; ``state_scan`` runs the chains below and above the good run."""
    cand = [f"e{k}{a}" for k in (0, 1) for a in L.AXES]
    base = checkpointed(attach(frames, run, "scene_id").drop("n"))

    def neighbours(df: DataFrame, side: str) -> DataFrame:
        one = ordered(df, line("scene_id", "idx"),
                      **{side: {**{f"p_{c}": c for c in cand}, "p_good": "good"}})
        return ordered(checkpointed(one), line("scene_id", "idx"),
                       **{side: {**{f"q_{c}": f"p_{c}" for c in cand}, "q_good": "p_good"}})

    def steps(df: DataFrame, second_known: Column) -> DataFrame:
        """Next choice for every (choice of inner neighbour, choice of the one before)."""
        cols = {}
        for a in (0, 1):
            for b in (0, 1):
                def gap(k):
                    total = None
                    for ax in L.AXES:
                        near = F.col(f"p_e{a}{ax}")
                        anchor = F.when(second_known & F.col(f"q_e{b}{ax}").isNotNull(),
                                        2.5 * near - 1.5 * F.col(f"q_e{b}{ax}")).otherwise(near)
                        d = F.col(f"e{k}{ax}") - anchor
                        total = d * d if total is None else total + d * d
                    return total
                pick = F.when(F.col("good") | (gap(0) <= gap(1)), 0).otherwise(1)
                cols[f"s{2 * a + b}"] = pick * 2 + a
        return df.withColumns(cols)

    tables = ["s0", "s1", "s2", "s3"]
    below = neighbours(base.filter("run_length > 0 AND idx <= run_end + 1"), "following") \
        .filter("idx < run_beg")
    # a run of one frame: the frame on its other side counts only when it is good itself
    known = (F.col("idx") + 2 <= F.col("run_end")) | F.coalesce("q_good", F.lit(False)) \
        | (F.col("idx") + 2 < F.col("run_beg"))
    below = steps(below, known).withColumns({"_arm": F.col("run_beg") - F.col("idx"),
                                             "_start": F.lit(0)})
    below = state_scan(checkpointed(below), ["scene_id"], "_arm", tables, "_start", "_state") \
        .select("scene_id", "idx", F.floor(F.col("_state") / 2).cast("int").alias("choice"))
    below = checkpointed(below)

    above = neighbours(base.filter("run_length > 0"), "prev").filter("idx > run_end")
    inner = run.select("scene_id", (F.col("run_beg") - 1).alias("idx")).join(
        below, ["scene_id", "idx"]).select("scene_id", F.col("choice").alias("_inner"),
                                           F.lit(1).alias("_m"))
    above = attach(above, inner, "scene_id", how="left").drop("_m").withColumn(
        "_start", F.when(F.col("run_beg") == F.col("run_end"), F.coalesce("_inner", F.lit(0)))
        .otherwise(F.lit(0)))
    above = steps(above, F.lit(True)).withColumn("_arm", F.col("idx") - F.col("run_end"))
    above = state_scan(checkpointed(above), ["scene_id"], "_arm", tables, "_start", "_state") \
        .select("scene_id", "idx", F.floor(F.col("_state") / 2).cast("int").alias("choice"))
    return base.join(below.unionByName(above), ["scene_id", "idx"], "left")


# ------------------------------------------------------------------ footprints and steps

def step_length(poses: DataFrame, order: str = "pose_key", axes: Sequence[str] = L.AXES,
                keys: Sequence[str] = ("scene_id",), out: str = "step",
                width: float = 1 << 20) -> DataFrame:
    """Distance to the next pose; the last pose repeats the step before it. ``poses`` has
    ``x, y, z``; ``axes=('x', 'z')`` measures on the ground plane."""
    rows = ordered(poses, line(keys, order, width),
                   following={f"_n{a}": a for a in axes}, prev={f"_p{a}": a for a in axes})

    def length(other: str, flip: int) -> Column:
        return F.sqrt(sum((F.pow((F.col(f"{other}{a}") - F.col(a)) * flip, 2) for a in axes[1:]),
                          F.pow((F.col(f"{other}{axes[0]}") - F.col(axes[0])) * flip, 2)))

    return rows.withColumn(out, F.coalesce(length("_n", 1), length("_p", -1))) \
        .select(*poses.columns, out)


def step_anchor(poses: DataFrame, factor: float | Column = STEP_FACTOR, order: str = "pose_key",
                axes: Sequence[str] = L.AXES, keys: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Synthetic footprint below the camera: centre plus ``factor`` steps along the camera's down
    direction. ``poses``: keys, order, ``center``, ``rotation``."""
    flat = poses.drop("footprint").withColumns({a: F.col("center")[a] for a in L.AXES})
    k = factor if isinstance(factor, Column) else F.lit(float(factor))
    stepped = step_length(flat, order, axes, keys)
    return stepped.withColumn("footprint", L.add(
        "center", L.times(L.down_direction("rotation"), F.col("step") * k))) \
        .drop("x", "y", "z")


def clamp_footprints(poses: DataFrame, hits: DataFrame) -> DataFrame:
    """Footprints from ray hits: distances below the 30th or above the 70th nearest-rank percentile
    are clamped, misses get the median, scenes without hits keep the centre.

    ``poses``: ``scene_id, pose_key, center, rotation``; ``hits``: ``scene_id, pose_key,
    hit point``.
    """
    joined = checkpointed(poses.join(hits, ["scene_id", "pose_key"], "left")
                          .withColumn("_dist", L.dist("center", "hit")))
    down = joined.withColumn("_d", L.down_direction("rotation"))
    mean = down.groupBy("scene_id").agg(L.vec(*[F.avg(F.col("_d")[a]) for a in L.AXES])
                                        .alias("_dir"), F.count(F.lit(1)).alias("n"))
    stats = order_stats(joined, "scene_id", "_dist", {"p30": 0.3, "p50": 0.5, "p70": 0.7}) \
        .drop("n")
    joined = attach(joined, mean.join(stats, "scene_id", "left"), "scene_id")
    along = lambda k: L.add("center", L.times("_dir", F.col(k)))
    footprint = (F.when(F.col("p50").isNull(), F.col("center"))
                 .when(F.col("hit").isNull(), along("p50"))
                 .when(F.col("_dist") < F.col("p30"), along("p30"))
                 .when(F.col("_dist") > F.col("p70"), along("p70"))
                 .otherwise(F.col("hit")))
    return joined.withColumn("footprint", footprint).select(
        *[c for c in poses.columns if c != "footprint"], "footprint")


# ------------------------------------------------------------------ transforms and route table

def transform_poses(poses: DataFrame, transforms: DataFrame, keys: Sequence[str] = ("scene_id",)
                    ) -> DataFrame:
    """Move centre, rotation and footprint by each scene's 4x4 ``matrix``."""
    return move_poses(attach_matrix(poses, transforms, keys)).drop("matrix")


def attach_matrix(poses: DataFrame, transforms: DataFrame, keys: Sequence[str]) -> DataFrame:
    from posegrid.scale import attach
    return attach(poses, transforms.select(*keys, "matrix"), keys)


def move_poses(df: DataFrame, matrix: str = "matrix") -> DataFrame:
    staged = df.withColumn("_turn", L.mat4_rotation(matrix))
    cols = {"center": L.mat4_apply(matrix, "center"),
            "rotation": L.matmul("rotation", L.transpose("_turn"))}
    if "footprint" in df.columns:
        cols["footprint"] = F.when(F.col("footprint").isNotNull(),
                                   L.mat4_apply(matrix, "footprint"))
    return staged.withColumns(cols).drop("_turn")


def zeroing_matrix(poses: DataFrame) -> DataFrame:
    """Per scene, the 4x4 that turns the world by the first pose's rotation."""
    first = poses.groupBy("scene_id").agg(F.min_by("rotation", "pose_key").alias("rotation"))
    return first.select("scene_id", L.to_mat4(1.0, "rotation", L.vec(0, 0, 0)).alias("matrix"))


def object_pose(transforms: DataFrame) -> DataFrame:
    """Pose of an object model from its transform: offset and rotation, identity when the angle
    vanishes."""
    eps = 1.1920929e-07
    turned = L.with_decomposition(transforms, "matrix", "_d").withColumn(
        "_r", L.mat4_rotation("matrix"))
    return turned.withColumns({
        "position": F.col("_d.offset"),
        "rotation": F.when(F.abs(F.col("_d.angle_deg")) > eps, F.col("_r"))
        .otherwise(L.identity3())}).drop("_d", "_r")


def route_table(frame_lens: DataFrame, views: DataFrame, poses: DataFrame,
                rotation_lens: int = 0) -> DataFrame:
    """Filled route frames: look up lens poses, merge lenses, drop incomplete frames.
    ``frame_lens``: ``scene_id, frame_idx, lens, filename, fps, ss``."""
    lenses = lens_poses(frame_lens, views, poses)
    if "footprint" not in lenses.columns:
        lenses = lenses.withColumn("footprint", F.lit(None).cast("struct<x:double,y:double,z:double>"))
    merged = merge_lenses(lenses.withColumn(
        "timestamp", N.frame_seconds("frame_idx", "fps", "ss")), rotation_lens,
        ("scene_id", "frame_idx", "timestamp"))
    return merged
