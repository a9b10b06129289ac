"""View pairs handed to the matcher.

Pair kinds whose number grows with the square of the scene (backbone against everything, far rig
frames) are kept as *runs*: one row per view with a contiguous range of partner positions. A run
list is the complete result in linear space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.scale import line, ordered


def positions(views: DataFrame, order: str = "pos") -> DataFrame:
    """``scene_id, id_view, p, n`` with dense positions in listing order."""
    return ordered(views.select("scene_id", F.col(order).alias("_o"), "id_view"),
                   line("scene_id", "_o"), position="p", size="n").drop("_o")


def window_pairs(views: DataFrame, window: int, order: str = "pos") -> DataFrame:
    """All pairs ``i < j <= i + window`` of listing positions."""
    p = positions(views, order)
    left = p.withColumn("q", F.explode(F.sequence(F.col("p") + 1, F.col("p") + window))) \
        .filter(F.col("q") < F.col("n")).select("scene_id", F.col("id_view").alias("view_a"), "q")
    right = p.select("scene_id", F.col("p").alias("q"), F.col("id_view").alias("view_b"))
    return left.join(right, ["scene_id", "q"]).select("scene_id", "view_a", "view_b")


def backbone_runs(views: DataFrame, gap: int, order: str = "pos") -> DataFrame:
    """Each ``gap``-th view against every other view of its scene, as position runs."""
    bones = positions(views, order).filter(F.col("p") % gap == 0)
    runs = F.array(F.struct(F.lit(0).cast("bigint").alias("lo"), (F.col("p") - 1).alias("hi")),
                   F.struct((F.col("p") + 1).alias("lo"), (F.col("n") - 1).alias("hi")))
    return bones.withColumn("_r", F.explode(runs)).filter("_r.lo <= _r.hi").select(
        "scene_id", F.col("id_view").alias("view_a"), F.col("_r.lo").alias("from_pos"),
        F.col("_r.hi").alias("to_pos"))


def rig_positions(views: DataFrame, n_cams: int, order: str = "pos") -> DataFrame:
    """Listing positions folded into (frame, cam) of a rig."""
    return positions(views, order).withColumns({
        "frame": F.floor(F.col("p") / n_cams), "cam": (F.col("p") % n_cams).cast("int")})


def _join_positions(wanted: DataFrame, p: DataFrame) -> DataFrame:
    first = p.select("scene_id", F.col("p").alias("a_pos"), F.col("id_view").alias("view_a"))
    return wanted.join(first, ["scene_id", "a_pos"]).select("scene_id", "view_a", "view_b")


def rig_ring_pairs(views: DataFrame, n_cams: int, order: str = "pos") -> DataFrame:
    """Neighbouring cameras inside each rig frame, wrapping around; a last frame that lacks cameras
    wraps around those it has."""
    p = rig_positions(views, n_cams, order)
    held = F.least(F.lit(n_cams), F.col("n") - F.col("frame") * n_cams)
    wanted = p.where(held > 1).select(
        "scene_id", F.col("id_view").alias("view_b"),
        (F.col("frame") * n_cams + F.pmod(F.col("cam") - 1, held)).alias("a_pos"))
    return _join_positions(wanted, p)


def rig_near_pairs(views: DataFrame, n_cams: int, near: int, order: str = "pos") -> DataFrame:
    """Camera i of a frame with cameras i-1, i, i+1 of each of the ``near`` previous frames."""
    p = rig_positions(views, n_cams, order)
    steps = F.array(*[F.struct(F.lit(df).alias("df"), F.lit(dc).alias("dc"))
                      for df in range(1, near + 1) for dc in (-1, 0, 1)])
    wanted = p.withColumn("_s", F.explode(steps)).filter(F.col("frame") >= F.col("_s.df")).select(
        "scene_id", F.col("id_view").alias("view_b"),
        ((F.col("frame") - F.col("_s.df")) * n_cams
         + F.pmod(F.col("cam") + F.col("_s.dc"), F.lit(n_cams))).alias("a_pos"))
    return _join_positions(wanted, p)


def rig_far_runs(views: DataFrame, n_cams: int, near: int, rig_type: str = "ring",
                 order: str = "pos") -> DataFrame:
    """Every camera of frame a with every camera of all frames beyond ``a + near``, as runs.
    ``ring_window`` rigs have none."""
    if rig_type not in ("ring", "ring_window"):
        raise ValueError(f"unknown rig type {rig_type!r}")
    p = rig_positions(views, n_cams, order)
    runs = p.select("scene_id", F.col("id_view").alias("view_a"),
                    ((F.col("frame") + near + 1) * n_cams).alias("from_pos"),
                    (F.col("n") - 1).alias("to_pos")).filter("from_pos <= to_pos")
    return runs if rig_type == "ring" else runs.filter(F.lit(False))


def rig_pairs(views: DataFrame, n_cams: int, near: int, order: str = "pos") -> DataFrame:
    """In-frame and near pairs of a rig; with ``rig_far_runs`` this is the whole pair list."""
    return rig_ring_pairs(views, n_cams, order).unionByName(
        rig_near_pairs(views, n_cams, near, order))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """``value`` lines ``a b`` of a pair list file."""
    return pairs.select("scene_id", F.concat_ws(" ", F.col("view_a").cast("string"),
                                                F.col("view_b").cast("string")).alias("value"))
