"""Interpolation, resampling and gap filling on time lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.scale import attach, bracket, checkpointed, line, order_stats, ordered

QUAT = L.QUAT
GRID_BLOCK = 1 << 16


def crop(targets: DataFrame, reference: DataFrame, time: str,
         keys: Sequence[str] = ("route_id",), ref_time: str | None = None) -> DataFrame:
    """Targets within the closed time range of ``reference``."""
    span = reference.groupBy(*keys).agg(F.min(ref_time or time).alias("_lo"),
                                        F.max(ref_time or time).alias("_hi"))
    counts = targets.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return attach(targets, span.join(counts, list(keys)), keys) \
        .filter(F.col(time).between(F.col("_lo"), F.col("_hi"))).select(*targets.columns)


def time_step(frames: DataFrame, idx: str = "frame_idx", ts: str = "timestamp",
              keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """Median time step between frames with consecutive indices: ``time_step`` per route."""
    rows = ordered(frames.select(*keys, idx, ts), line(keys, idx),
                   prev={"_pi": idx, "_pt": ts})
    steps = rows.filter(F.col(idx) - F.col("_pi") == 1) \
        .withColumn("_d", F.col(ts) - F.col("_pt"))
    return order_stats(steps, list(keys), "_d", {"time_step": 0.5}, mode="linear")


def interpolate(targets: DataFrame, knots: DataFrame, time: str, values: Sequence[str],
                keys: Sequence[str] = ("route_id",), rotation: str | None = None,
                width: float = 3600.0) -> DataFrame:
    """Values (and a rotation, by slerp) of ``knots`` at the target times; held constant outside.

    ``knots``: keys, ``time``, scalar ``values`` and optionally a 3x3 ``rotation``. Of knots of equal
    time one whole row counts, the smallest by its values in the order given.
    """
    cols = list(values)
    k = knots
    if rotation:
        k = k.withColumn("_q", L.quaternion(rotation)) \
            .withColumns({q: F.col("_q")[q] for q in QUAT})
        cols += list(QUAT)
    k = k.groupBy(*keys, time).agg(F.min(F.struct(*cols)).alias("_k")).select(
        *keys, time, *[F.col(f"_k.{c}").alias(c) for c in cols])
    b = bracket(targets, k, keys, time, cols, width)
    t0, t1 = F.col(f"prev_{time}"), F.col(f"next_{time}")
    share = F.when(t1 > t0, (F.col(time) - t0) / (t1 - t0)).otherwise(F.lit(0.0))
    b = b.withColumn("_f", share)
    out = {}
    for c in values:
        p, n = F.col(f"prev_{c}"), F.col(f"next_{c}")
        out[c] = F.when(p.isNull(), n).when(n.isNull(), p).otherwise(p + (n - p) * F.col("_f"))
    keep = [c for c in targets.columns if c not in out]
    b = b.withColumns(out)
    if rotation:
        side = lambda s: F.when(F.col(f"{s}_qw").isNotNull(),
                                F.struct(*[F.col(f"{s}_{q}").alias(q) for q in QUAT]))
        b = b.withColumns({"_q0": F.coalesce(side("prev"), side("next")),
                           "_q1": F.coalesce(side("next"), side("prev"))}) \
            .withColumn("_q", L.slerp("_q0", "_q1", "_f")) \
            .withColumn(rotation, L.quaternion_matrix("_q"))
        keep = [c for c in keep if c != rotation]
    return b.select(*keep, *out, *([rotation] if rotation else []))


def densify(track: DataFrame, values: Sequence[str], num: int = 10, time: str = "ms",
            keys: Sequence[str] = ("route_id",)) -> DataFrame:
    """``num`` evenly spaced times between a track's first and last, values interpolated."""
    span = track.groupBy(*keys).agg(F.min(time).cast("double").alias("_lo"),
                                    F.max(time).cast("double").alias("_hi"))
    i = F.col("seq")
    grid = span.withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(num - 1)))).select(
        *keys, "seq", F.when(i == num - 1, F.col("_hi")).otherwise(
            F.col("_lo") + (F.col("_hi") - F.col("_lo")) * i / (num - 1)).alias(time))
    knots = track.withColumn(time, F.col(time).cast("double"))
    return interpolate(grid, knots, time, values, keys, width=3.6e6)


def path_at_fixes(path: DataFrame, fixes: DataFrame, keys: Sequence[str] = ("route_id",)
                  ) -> DataFrame:
    """Camera path at the track's times (relative to its first fix, cropped to the path).

    ``path``: ``timestamp`` seconds, ``x, y, z``, ``rotation``; ``fixes``: ``seq, ms``.
    """
    first = fixes.groupBy(*keys).agg(F.min("ms").alias("_start"), F.count(F.lit(1)).alias("n"))
    at = attach(fixes.select(*keys, "seq", "ms"), first, keys).withColumn(
        "timestamp", (F.col("ms") - F.col("_start")) * 1e-3).drop("_start", "n")
    inside = checkpointed(crop(at, path, "timestamp", keys))
    return interpolate(inside, path, "timestamp", L.AXES, keys, rotation="rotation")


def fill_route(frames: DataFrame, totals: DataFrame, values: Sequence[str] = L.AXES,
               keys: Sequence[str] = ("route_id",), rotation: str | None = "rotation"
               ) -> DataFrame:
    """Every frame ``0 .. n_total - 1`` of each route on a regular time grid.

    Missing frames inside are interpolated, missing heads and tails hold the first and last pose.
    ``totals``: keys and ``n_total``.
    """
    step = time_step(frames, keys=keys).drop("n")
    blocks = totals.join(step, list(keys)).withColumn("_blk", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("n_total") - 1) / GRID_BLOCK))))
    start = F.col("_blk") * GRID_BLOCK
    grid = blocks.repartition(*keys, "_blk").select(*keys, "time_step", F.explode(F.sequence(
        start, F.least(start + GRID_BLOCK, F.col("n_total")) - 1)).alias("frame_idx")) \
        .select(*keys, "frame_idx", (F.col("frame_idx") * F.col("time_step")).alias("timestamp"))
    return interpolate(grid, frames, "timestamp", values, keys, rotation)
