"""Frame manifests, sampling, slicing and capture tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate, chain, repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.functions import names as N
from posegrid.scale import attach, bracket, line, name_blocks, ordered

GRID_BLOCK = 1 << 16
RIG_CAMERAS = 6
#: order in which eight dense cube faces are placed around the ring (fixed value)
DENSE_RING_ORDER = (0, 4, 1, 5, 2, 6, 3, 7)


# ------------------------------------------------------------------ sources of frames

def capture_grid(captures: DataFrame, kind: str) -> DataFrame:
    """Frames of each capture window: ``capture_id, ss, to, fps`` to one row per frame (and camera).

    ``kind``: ``single`` and ``equirect`` name frames ``00000.jpg``; ``list`` prefixes the capture;
    ``rig`` has six cameras ``00000_1.jpg``. Frame numbers are generated block by block, so a long
    capture is spread over tasks.
    """
    n = F.floor((F.col("to") - F.col("ss")) * F.col("fps"))
    blocks = captures.withColumn("n_frames", n).filter("n_frames > 0") \
        .withColumn("_blk", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.floor((F.col("n_frames") - 1) / GRID_BLOCK))))
    start = F.col("_blk") * GRID_BLOCK
    rows = blocks.repartition("capture_id", "_blk").withColumn("frame_idx", F.explode(F.sequence(
        start, F.least(start + GRID_BLOCK, F.col("n_frames")) - 1))).drop("_blk")
    if kind in ("single", "equirect"):
        rows = rows.withColumn("cam_id", F.lit(None).cast("int"))
        name = F.format_string("%05d.jpg", "frame_idx")
    elif kind == "list":
        rows = rows.withColumn("cam_id", F.lit(None).cast("int"))
        name = F.format_string("%d_%05d.jpg", "capture_id", "frame_idx")
    elif kind == "rig":
        rows = rows.withColumn("cam_id", F.explode(F.sequence(F.lit(1), F.lit(RIG_CAMERAS))))
        name = F.format_string("%05d_%d.jpg", "frame_idx", "cam_id")
    else:
        raise ValueError(f"unknown capture kind {kind!r}")
    return rows.withColumn("filename", name).withColumn(
        "seconds", N.frame_seconds("frame_idx", "fps", "ss"))


def manifest(listing: DataFrame, filename: str = "filename") -> DataFrame:
    """Key index (first name field), camera field and mask flag of listed image files."""
    return listing.withColumns({"key_idx": N.frame_index(filename),
                                "is_mask": N.is_mask(filename)})


def files_per_key(files: DataFrame, keys: Sequence[str], digits: int = 3) -> DataFrame:
    """Number the files of each key in name order. A key can be a whole video, so the files stay
    rows instead of being collected."""
    return ordered(name_blocks(files, keys, "filename", digits),
                   line([*keys], "filename", blocks=(F.col("_block"),)),
                   position="file_no", size="n_files").drop("_block")


# ------------------------------------------------------------------ sampling

def all_frames(frames: DataFrame) -> DataFrame:
    """Take every frame."""
    return frames


def uniform_video_sample(files: DataFrame, step: int, keys: Sequence[str] = ("scene_id",),
                         order: str = "frame_idx") -> DataFrame:
    """Every ``step``-th file of each video, from the first."""
    return ordered(files, line(keys, order), position="_pos") \
        .filter(F.col("_pos") % step == 0).drop("_pos")


def uniform_rig_sample(images: DataFrame, step: int, keys: Sequence[str] = ("scene_id",),
                       frame: str = "frame_idx") -> DataFrame:
    """Every ``step``-th rig frame starting at ``step // 2``, with all its cameras."""
    frames = images.select(*keys, frame).distinct()
    off = step // 2
    kept = ordered(frames, line(keys, frame), position="_pos") \
        .filter((F.col("_pos") >= off) & (F.pmod(F.col("_pos") - off, F.lit(step)) == 0))
    return images.join(kept.select(*keys, frame), [*keys, frame], "left_semi")


def keep_key_frames(frames: DataFrame, key_frames: DataFrame, on: Sequence[str]) -> DataFrame:
    return frames.join(key_frames, list(on), "left_semi")


# ------------------------------------------------------------------ slices

def halo_offsets(overlap: Sequence[tuple[int, int]]) -> list[int]:
    """Distances of the halo frames from a slice's edge, for ``[(step, count), ...]``."""
    return list(accumulate(chain.from_iterable(repeat(step, count) for step, count in overlap)))


def _numbered(frames: DataFrame, length: int, order: str = "frame_idx") -> DataFrame:
    return ordered(frames, line("scene_id", order), position="pos", size="n").withColumn(
        "n_slices", F.greatest(F.lit(1), F.ceil(F.col("n") / length)))


def slice_frames(frames: DataFrame, length: int, overlap: Sequence[tuple[int, int]] = (),
                 order: str = "frame_idx") -> DataFrame:
    """Assign frames to overlapping slices: one row per (slice, frame) with role body or halo.

    Bodies have ``length`` frames, the last one is aligned to the end. Membership is decided per
    row from its dense position, so there is no join with the slice list.
    """
    rows = _numbered(frames, length, order)
    pos, n, k = F.col("pos"), F.col("n"), F.col("n_slices")
    own = F.floor(pos / length)
    last_beg = F.greatest(F.lit(0), n - length)

    def member(cond: Column, slice_no: Column, role: str) -> Column:
        return F.when(cond, F.struct(slice_no.cast("bigint").alias("slice"),
                                     F.lit(role).alias("role")))

    options = [member(own < k - 1, own, "body"), member(pos >= last_beg, k - 1, "body")]
    for o in halo_offsets(overlap):
        before = pos + o
        options.append(member((before % length == 0) & (F.floor(before / length) < k - 1),
                              F.floor(before / length), "halo"))
        options.append(member((before == last_beg), k - 1, "halo"))
        end = pos - o + 1
        options.append(member((end > 0) & (end % length == 0) & (F.floor(end / length) < k),
                              F.floor(end / length) - 1, "halo"))
    picked = F.explode(F.filter(F.array(*options), lambda m: m.isNotNull()))
    return rows.withColumn("_m", picked).select(
        "*", F.col("_m.slice").alias("slice"), F.col("_m.role").alias("role")) \
        .drop("_m")


def slice_bounds(frames: DataFrame, length: int, order: str = "frame_idx") -> DataFrame:
    """``scene_id, slice, slice_beg, slice_end`` in seconds. Frames carry ``fps, ss, to``."""
    starts = _numbered(frames, length, order).filter(F.col("pos") % length == 0).select(
        "scene_id", F.floor(F.col("pos") / length).alias("slice"), "ss", "to",
        N.frame_seconds(order, "fps", "ss").alias("_t"))
    out = ordered(starts, line("scene_id", "slice"), following={"_next": "_t"})
    return out.select("scene_id", "slice",
                      F.when(F.col("slice") == 0, F.col("ss")).otherwise(F.col("_t"))
                      .alias("slice_beg"), F.coalesce("_next", "to").alias("slice_end"))


def assign_dense_frames(dense: DataFrame, bounds: DataFrame, width: float = 3600.0) -> DataFrame:
    """Slice of each densely sampled frame: the slice whose ``[beg, end)`` holds its ``seconds``;
    the first slice takes everything earlier, the last everything later."""
    knots = bounds.filter("slice > 0").select("scene_id", F.col("slice_beg").alias("seconds"),
                                              "slice")
    hit = bracket(dense, knots, ["scene_id"], "seconds", ["slice"], width)
    return hit.withColumn("slice", F.coalesce("prev_slice", F.lit(0))) \
        .select(*dense.columns, "slice")


def key_frame_bounds(key_frames: DataFrame, counts: DataFrame, length: int) -> DataFrame:
    """Slice bounds on given key frames, as fractions of the dense frame count ``n_dense``.

    A bound lies midway between the first key frame of the next slice and the one after it (or on
    that key frame when it is the last).
    """
    numbered = ordered(_numbered(key_frames, length), line("scene_id", "frame_idx"),
                       following={"_after": "frame_idx"})
    starts = numbered.filter(F.col("pos") % length == 0).select(
        "scene_id", F.floor(F.col("pos") / length).alias("slice"), "n",
        ((F.col("frame_idx") + F.coalesce("_after", "frame_idx")) / 2.0).alias("_mid"))
    starts = attach(starts, counts.withColumn("_m", F.lit(1)), "scene_id").drop("_m")
    starts = starts.withColumn("_frac", F.col("_mid") / F.col("n_dense"))
    out = ordered(starts, line("scene_id", "slice"), following={"_next": "_frac"})
    return out.select("scene_id", "slice",
                      F.when(F.col("slice") == 0, F.lit(0.0)).otherwise(F.col("_frac"))
                      .alias("slice_beg"), F.coalesce("_next", F.lit(1.0)).alias("slice_end"))


def assign_by_fraction(dense: DataFrame, counts: DataFrame, bounds: DataFrame) -> DataFrame:
    """Slice of each dense frame by its fraction ``frame_idx / n_dense`` of the whole."""
    with_n = attach(dense, counts.withColumn("_m", F.col("n_dense")), "scene_id") \
        .drop("_m").withColumn("seconds", F.col("frame_idx") / F.col("n_dense"))
    return assign_dense_frames(with_n, bounds, width=2.0 ** -10).drop("seconds")


# ------------------------------------------------------------------ order checks and keys

def rekey(df: DataFrame, order: Sequence[str] | str, out: str = "new_key",
          keys: Sequence[str] = ("scene_id",), blocks=None) -> DataFrame:
    """Dense 0-based keys in the given order."""
    return ordered(df, line(keys, order, blocks=blocks), position=out)


def timestamp_violations(frames: DataFrame, order: str = "frame_idx", ts: str = "timestamp",
                         keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Count of frames whose time does not increase over the previous frame, per route."""
    rows = ordered(frames, line(keys, order), prev={"_before": ts})
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.count_if(F.col(ts) <= F.col("_before")).alias("n_violations"))



# ------------------------------------------------------------------ captures

def downsized(captures: DataFrame, power: int) -> DataFrame:
    return captures.withColumns({"focal_length": F.col("focal_length") / float(2 ** power),
                                 "downsize_power_factor": F.lit(power)})


def cube_face_capture(captures: DataFrame, frame_size: int = 1024) -> DataFrame:
    return captures.withColumns({"camera_model": F.lit(3),
                                 "focal_length": F.lit(frame_size / 2.0)})


def undistorted_capture(captures: DataFrame, fx: str, scale: float = 0.8) -> DataFrame:
    """Fisheye frames after undistortion: pinhole model with a scaled focal length."""
    return captures.withColumns({"camera_model": F.lit(3), "defisheye": F.lit(True),
                                 "focal_length": F.col(fx) * scale})


def face_views(frames: DataFrame, dense: bool = False) -> DataFrame:
    """One row per cube face of each frame: 4 faces, or 8 in ring order."""
    n = len(DENSE_RING_ORDER) if dense else 4
    rows = frames.withColumn("face", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    if dense:
        ring = F.array(*[F.lit(v) for v in DENSE_RING_ORDER])
        rows = rows.withColumn("face", F.element_at(ring, F.col("face") + 1))
    return rows.withColumn("face_filename", F.concat(
        F.regexp_replace("filename", r"\.[^.]*$", ""), F.lit("_"), F.col("face").cast("string"),
        F.lit(".jpg")))


def window_violations(captures: DataFrame) -> DataFrame:
    """Captures whose window is not ``0 <= ss <= to <= length``, with the reason."""
    reason = (F.when(F.col("ss") > F.col("to"), "ss is after to")
              .when(F.col("ss") < 0, "ss is negative")
              .when(F.col("to") > F.col("length"), "to is after the end"))
    return captures.withColumn("reason", reason).filter("reason IS NOT NULL")


def adjacent_slice_pairs(slices: DataFrame) -> DataFrame:
    """Neighbouring slices of the same video, which share poses and need no matching.
    ``slices``: ``video, slice, is_scene``."""
    nxt = slices.select("video", (F.col("slice") - 1).alias("slice"),
                        F.col("slice").alias("sub_slice"), F.col("is_scene").alias("_sub_scene"))
    return slices.filter("is_scene").join(nxt.filter("_sub_scene"), ["video", "slice"]) \
        .select("video", F.col("slice").alias("main_slice"), "sub_slice")


def needs_matching(main_video, main_slice, main_is_scene, sub_video, sub_slice,
                   sub_is_scene) -> Column:
    """Whether a sub model must be matched to the main one; NULL when main is not a scene."""
    c = L._c
    adjacent = (c(main_video) == c(sub_video)) & (F.abs(c(main_slice) - c(sub_slice)) == 1)
    return F.when(c(main_is_scene), ~(c(sub_is_scene) & adjacent))


def stationary_trajectory(captures: DataFrame) -> DataFrame:
    """Two identity poses, at 0 and at the end, for captures flagged stationary."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return captures.filter("movement_type = 'stationary'").select(
        "capture_id", F.explode(F.array(zero, F.col("duration_ms").cast("double"))).alias("t_ms"),
        zero.alias("x"), zero.alias("y"), zero.alias("z"), zero.alias("qx"), zero.alias("qy"),
        zero.alias("qz"), one.alias("qw"))


# ------------------------------------------------------------------ markers

def marker_times(markers: DataFrame) -> DataFrame:
    """Node crossings of each route in seconds with the route's start and end."""
    ms = F.col("begin_ms").cast("bigint") / 1000.0
    span = markers.filter(F.col("name").startswith("start_end")).groupBy("route_id").agg(
        F.max(ms).alias("ss"), F.max(F.col("end_ms").cast("bigint") / 1000.0).alias("to"),
        F.count(F.lit(1)).alias("n"))
    nodes = markers.filter(F.col("name").startswith("node")).select(
        "route_id", F.split("name", "_").getItem(1).alias("node_id"), ms.alias("node_s"))
    return attach(nodes, span, "route_id").select("route_id", "node_id", "node_s", "ss", "to")
