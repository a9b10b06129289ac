"""Matching camera poses to GPS fixes.

``frames``: ``route_id, pose_key, ms`` (epoch) with ``center, rotation, footprint``;
``fixes``: ``route_id, seq, ms, lon, lat, elev, height`` and optionally ``foot_elev``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.functions import geo as G
from posegrid.functions import linalg as L
from posegrid.operators.poses import step_length
from posegrid.operators.resample import densify
from posegrid.scale import attach, bracket, line, ordered

TOLERANCE_MS = 100
KEY = ("route_id",)


def absolute_times(frames: DataFrame, fixes: DataFrame, seconds: str = "timestamp") -> DataFrame:
    """Epoch ``ms`` of frames from their seconds and the first fix of their route."""
    start = fixes.groupBy(*KEY).agg(F.min_by("ms", "seq").alias("start_ms"))
    counts = frames.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return attach(frames, start.join(counts, list(KEY)), KEY).withColumn(
        "ms", F.col("start_ms") + F.col(seconds) * 1000.0).drop("n")


def anchor_frames(frames: DataFrame, count: int, order: str = "pose_key",
                  keys: Sequence[str] = KEY) -> DataFrame:
    """First and last ``count`` frames of each route, labelled ``start`` and ``end``; routes with
    fewer than ``2 * count`` frames are all ``start``."""
    rows = ordered(frames, line(keys, order), position="_p", size="_n")
    p, n = F.col("_p"), F.col("_n")
    label = (F.when((n < 2 * count) | (p < count), "start").when(p >= n - count, "end"))
    return rows.withColumn("anchor_group", label).filter("anchor_group IS NOT NULL") \
        .drop("_p", "_n")


def nearest_fix(frames: DataFrame, fixes: DataFrame, tolerance_ms: float = TOLERANCE_MS,
                keys: Sequence[str] = KEY, width_ms: float = 1 << 20) -> DataFrame:
    """The fix nearest in time to each frame, if closer than the tolerance; the earlier ``seq``
    wins ties. Adds ``gps_seq, gps_ms, dt``.

    Fixes sharing a millisecond are reduced to the first; frames then see only the fix before and
    the fix after them on a merged time line, so nothing grows with frames times fixes.
    """
    unique = fixes.groupBy(*keys, "ms").agg(F.min("seq").alias("seq"))
    unique = unique.withColumn("ms", F.col("ms").cast(frames.schema["ms"].dataType))
    b = bracket(frames, unique, keys, "ms", ["seq"], width_ms)
    before = F.col("ms") - F.col("prev_ms")
    after = F.col("next_ms") - F.col("ms")
    take_next = before.isNull() | (after < before) | \
        ((after == before) & (F.col("next_seq") < F.col("prev_seq")))
    out = b.withColumns({
        "gps_seq": F.when(take_next, F.col("next_seq")).otherwise(F.col("prev_seq")),
        "gps_ms": F.when(take_next, F.col("next_ms")).otherwise(F.col("prev_ms")),
        "dt": F.when(take_next, after).otherwise(before)})
    return out.filter(F.col("dt") < tolerance_ms).select(*frames.columns, "gps_seq", "gps_ms", "dt")


def one_to_one(matches: DataFrame, order: str = "pose_key", keys: Sequence[str] = KEY
               ) -> DataFrame:
    """The best frame per fix: smallest time difference, then the earlier frame."""
    best = matches.groupBy(*keys, "gps_seq").agg(
        F.min(F.struct("dt", order)).alias("_b")).select(
        *keys, "gps_seq", F.col("_b")[order].alias(order))
    return matches.join(best, [*keys, "gps_seq", order], "left_semi")


def anchor_range(matches: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return matches.groupBy(*keys).agg(F.min("gps_seq").alias("first_seq"),
                                      F.max("gps_seq").alias("last_seq"),
                                      F.count(F.lit(1)).alias("n"))


def smooth_anchors(matches: DataFrame, columns: Sequence[str], mode: str = "anchor",
                   keys: Sequence[str] = KEY) -> DataFrame:
    """Replace elevations and heights by their mean per anchor group, or over all anchors."""
    if mode not in ("anchor", "full"):
        raise ValueError(f"unknown smoothing mode {mode!r}")
    group = [*keys, "anchor_group"] if mode == "anchor" else list(keys)
    means = matches.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                        *[F.avg(c).alias(f"_m_{c}") for c in columns])
    return attach(matches, means, group).withColumns(
        {c: F.col(f"_m_{c}") for c in columns}).select(*matches.columns)


def track_footprints(fixes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Footprint elevation from the camera height."""
    return fixes.withColumn("foot_elev", F.col("elev") - F.col("height"))


def track_steps(fixes: DataFrame, keys: Sequence[str] = KEY, order: str = "seq") -> DataFrame:
    """Ground-plane step length of a track in metres, on the UTM grid of its first fix."""
    first = grid_of_first(fixes, order, keys)
    at = attach(fixes, first, keys).withColumn(
        "_u", G.utm_to_sfm(G.to_utm("lon", "lat", "elev", F.col("_zone"), F.col("_south")))).drop("_zone", "_south")
    flat = at.withColumns({a: F.col("_u")[a] for a in L.AXES}).drop("_u")
    return step_length(flat, order, ("x", "z"), keys).drop(*L.AXES)


def step_factor(stepped: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Mean step and the factor that makes it the default camera height."""
    return stepped.groupBy(*keys).agg(
        F.avg("step").alias("mean_step"), F.try_divide(F.lit(G.DEFAULT_HEIGHT), F.avg("step")).alias("step_factor"),
        F.count(F.lit(1)).alias("n"))


def track_step_footprints(fixes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Footprint elevation from scaled step lengths, with the track's ``step_factor``."""
    stepped = track_steps(fixes, keys)
    out = attach(stepped, step_factor(stepped, keys), keys)
    return out.withColumn("foot_elev", F.col("elev") - F.col("step") * F.col("step_factor")) \
        .drop("step", "mean_step", "n")


def long_enough(fixes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Tracks with at least two fixes; those with two or three are densified to ten."""
    counts = fixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = attach(fixes, counts, keys)
    values = [c for c in ("lon", "lat", "elev", "height", "foot_elev") if c in fixes.columns]
    short = rows.filter("n BETWEEN 2 AND 3")
    cols = [*keys, "seq", "ms", *values]
    dense = densify(short, values, keys=keys).select(*cols)
    whole = rows.filter("n > 3").withColumn("ms", F.col("ms").cast("double")).select(*cols)
    return whole.unionByName(dense.withColumn("seq", F.col("seq").cast(
        fixes.schema["seq"].dataType)))


def with_fix(matches: DataFrame, fixes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Add the coordinates of each match's fix."""
    cols = [c for c in ("lon", "lat", "elev", "height", "foot_elev") if c in fixes.columns]
    return matches.join(fixes.select(*keys, F.col("seq").alias("gps_seq"), *cols),
                        [*keys, "gps_seq"])


def match_points(matches: DataFrame, footprint: bool = True, keys: Sequence[str] = KEY
                 ) -> DataFrame:
    """Point pairs of matches: camera to fix and, stacked below, footprint to ground point."""
    pair = lambda kind, own, elev: F.struct(F.lit(kind).alias("kind"),
                                            own.alias("point"), elev.alias("elev"))
    kinds = [pair("camera", F.col("center"), F.col("elev"))]
    if footprint:
        kinds.append(pair("footprint", F.col("footprint"), F.col("foot_elev")))
    return matches.withColumn("_k", F.explode(F.array(*kinds))).select(
        *keys, "pose_key", "gps_seq", "lon", "lat", F.col("_k.kind").alias("kind"),
        F.col("_k.point").alias("point"), F.col("_k.elev").alias("elev"))


def grid_of_first(rows: DataFrame, order: str, keys: Sequence[str] = KEY) -> DataFrame:
    """UTM zone (``_zone``) and hemisphere (``_south``) of the first row of each group; of several first
    rows the one with the smallest coordinates."""
    first = rows.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).groupBy(*keys).agg(
        F.min(F.struct(order, "lon", "lat")).alias("_f"))
    return first.select(*keys, G.utm_zone(F.col("_f.lon"), F.col("_f.lat")).alias("_zone"),
                        (F.col("_f.lat") < 0).alias("_south"))


def match_xyz(points: DataFrame, keys: Sequence[str] = KEY, grid_keys: Sequence[str] | None = None
              ) -> DataFrame:
    """Matched points as fit pairs: own coordinates to UTM in the camera axes. All points of a group
    (``grid_keys``, as a rule the group that is fitted) are on the grid of its first matched fix."""
    grid_keys = list(grid_keys or keys)
    first = grid_of_first(points, "gps_seq", grid_keys)
    u = attach(points, first, grid_keys).withColumn(
        "_utm", G.to_utm("lon", "lat", "elev", F.col("_zone"), F.col("_south"))).withColumn(
        "_to", G.utm_to_sfm("_utm"))
    return u.select(*keys, "pose_key", "gps_seq", "kind",
                    *[F.col("point")[a].alias(f"f{a}") for a in L.AXES],
                    *[F.col("_to")[a].alias(f"t{a}") for a in L.AXES],
                    F.col("_utm.zone").alias("zone"), F.col("_utm.south").alias("south"))


def first_zone(xyz: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Zone and hemisphere of each route's first matched fix."""
    return xyz.groupBy(*keys).agg(F.min(F.struct("gps_seq", "zone", "south")).alias("_z")).select(
        *keys, F.col("_z.zone").alias("zone"), F.col("_z.south").alias("south"))


def splice(path: DataFrame, fixes: DataFrame, matches: DataFrame, keys: Sequence[str] = KEY
           ) -> DataFrame:
    """Track before the first anchor, camera path, track after the last anchor.

    ``path`` and ``fixes`` have ``seq`` and ``entry``; the result is ordered by ``part, seq``.
    """
    span = anchor_range(matches, keys).select(*keys, "first_seq", "last_seq")
    counts = fixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ends = attach(fixes, span.join(counts, list(keys)), keys)
    part = F.when(F.col("seq") < F.col("first_seq"), 0).when(F.col("seq") > F.col("last_seq"), 2)
    tails = ends.withColumn("part", part).filter("part IS NOT NULL") \
        .select(*keys, "part", "seq", "entry")
    return tails.unionByName(path.select(*keys, F.lit(1).alias("part"), "seq", "entry"))
