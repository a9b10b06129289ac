"""Georeferencing jobs: one route by its own anchors, a whole site by all anchors, or by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.functions import geo as G
from posegrid.functions import linalg as L
from posegrid.operators import anchor as A
from posegrid.operators import fit
from posegrid.operators.outliers import curve_filter
from posegrid.scale import BLOCK, attach, checkpointed, line, ordered

ANCHORS_PER_END = 1000


def clean_frames(frames: DataFrame, degree: int = 5, max_iter: int = 10, num_sigma: float = 3.0
                 ) -> DataFrame:
    """Frames on a smooth parametric curve per route."""
    flat = frames.withColumns({a: F.col("center")[a] for a in L.AXES})
    return curve_filter(flat, degree, max_iter, num_sigma=num_sigma, order="pose_key") \
        .drop(*L.AXES)


def anchor_matches(frames: DataFrame, fixes: DataFrame, anchors: int = ANCHORS_PER_END,
                   tolerance_ms: float = A.TOLERANCE_MS, smooth: str | None = None) -> DataFrame:
    """One-to-one anchor matches with the coordinates of their fix."""
    near = A.nearest_fix(A.anchor_frames(frames, anchors), fixes, tolerance_ms)
    matched = A.with_fix(A.one_to_one(near), fixes)
    if smooth is None:
        return matched
    flat = matched.withColumns({"_cy": F.col("center")["y"], "_fy": F.col("footprint")["y"]})
    even = A.smooth_anchors(flat, ["_cy", "_fy", "elev", "foot_elev"], smooth)
    return even.withColumns({
        "center": L.vec(F.col("center")["x"], "_cy", F.col("center")["z"]),
        "footprint": L.vec(F.col("footprint")["x"], "_fy", F.col("footprint")["z"])}) \
        .drop("_cy", "_fy")


def to_entries(moved: DataFrame) -> DataFrame:
    """Geographic position, height, viewer angles and the eight-number entry of moved frames.
    ``moved``: ``center, rotation, footprint`` in metres (camera axes), ``zone, south, ms``."""
    e, n, z = L.xyz(G.sfm_to_utm("center"))
    geo = moved.withColumn("geo", G.from_utm(e, n, z, "zone", "south"))
    full = geo.withColumns({"height": G.camera_height("center", "footprint"),
                            "angles": G.viewer_angles("rotation")})
    return full.withColumn("entry", G.geo_entry("geo", "ms", "height", "angles"))


def apply_fit(frames: DataFrame, fits: DataFrame, keys: list[str]) -> DataFrame:
    """Move frames by ``scale, rotation, t`` of their group."""
    rows = attach(frames, fits.select(*keys, "scale", F.col("rotation").alias("_turn"), "t",
                                             "zone", "south"), keys)
    move = lambda c: L.similarity(c, "scale", "_turn", "t")
    return rows.withColumns({
        "center": move("center"), "rotation": L.matmul("rotation", L.transpose("_turn")),
        "footprint": F.when(F.col("footprint").isNotNull(), move("footprint"))}) \
        .drop("scale", "_turn", "t")


def _solve(xyz: DataFrame, keys: list[str], mode: str, refit_offset: bool) -> DataFrame:
    """Fit per group: ``full`` takes scale and offset from the 3-D fit and the rotation from the
    yaw fit; ``planar`` takes all three from the yaw fit. ``refit_offset`` re-centres the offset for
    the yaw rotation."""
    zones = A.first_zone(xyz, keys)
    moments = checkpointed(fit.pair_moments(xyz, keys))
    yaw = fit.planar_solution(moments, keys)
    if mode == "planar":
        fits = yaw.select(*keys, F.col("yaw_scale").alias("scale"),
                          F.col("yaw_rotation").alias("rotation"), F.col("yaw_t").alias("t")) \
            .filter("scale IS NOT NULL")
    elif mode == "full":
        both = fit.solve_moments(moments, keys).filter("reason IS NULL").join(yaw.drop("n"), keys)
        if refit_offset:
            means = moments.select(*keys, L.vec("m_fx", "m_fy", "m_fz").alias("_mf"),
                                   L.vec("m_tx", "m_ty", "m_tz").alias("_mt"))
            both = both.join(means, keys).withColumn("t", L.sub("_mt", L.times(
                L.matvec("yaw_rotation", "_mf"), "scale")))
        fits = both.select(*keys, "scale", F.col("yaw_rotation").alias("rotation"), "t")
    else:
        raise ValueError(f"unknown fit mode {mode!r}")
    return fits.join(zones, keys)


def georeference_route(frames: DataFrame, fixes: DataFrame, *, anchors: int = ANCHORS_PER_END,
                       tolerance_ms: float = A.TOLERANCE_MS, clean: bool = True,
                       footprint: bool = True, smooth: str | None = None, mode: str = "full",
                       refit_offset: bool = False) -> DataFrame:
    """Geographic entries of every frame, each route fitted on its own anchors.

    ``frames``: ``route_id, pose_key, ms, center, rotation, footprint``; ``fixes``: ``route_id,
    seq, ms, lon, lat, elev, height, foot_elev``. Tracks with fewer than two fixes are left out,
    very short ones are densified.
    """
    return _fitted_route(frames, fixes, anchors, tolerance_ms, clean, footprint, smooth, mode, refit_offset)[0]


def _fitted_route(frames, fixes, anchors, tolerance_ms, clean, footprint, smooth, mode, refit_offset
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entries of the frames, the usable fixes and the anchor matches."""
    fr = clean_frames(frames) if clean else frames
    fx = A.long_enough(fixes)
    # points, zones, moments and the splice read the matches: at most two ends of anchors a route, written once
    matched = checkpointed(anchor_matches(fr, fx, anchors, tolerance_ms, smooth))
    xyz = A.match_xyz(A.match_points(matched, footprint))
    fits = _solve(xyz, ["route_id"], mode, refit_offset)
    return to_entries(apply_fit(fr, fits, ["route_id"])), fx, matched


def georeferenced_track(frames: DataFrame, fixes: DataFrame, *, anchors: int = ANCHORS_PER_END,
                        tolerance_ms: float = A.TOLERANCE_MS, clean: bool = True,
                        footprint: bool = True, smooth: str | None = None, mode: str = "full",
                        refit_offset: bool = False) -> DataFrame:
    """One track per route that could be fitted: the fixes before its first anchor, its georeferenced frames,
    the fixes after its last anchor. ``route_id, seq, part`` (0 head, 1 path, 2 tail), ``lon, lat, elev,
    ms``."""
    path, fx, matched = _fitted_route(frames, fixes, anchors, tolerance_ms, clean, footprint, smooth, mode,
                                      refit_offset)
    entry = lambda lon, lat, elev, ms: F.struct(
        F.col(lon).alias("lon"), F.col(lat).alias("lat"), F.col(elev).alias("elev"),
        F.col(ms).cast("double").alias("ms")).alias("entry")
    own = path.select("route_id", F.col("pose_key").alias("seq"), entry("geo.lon", "geo.lat", "geo.elev", "ms"))
    fitted = path.select("route_id").distinct()
    around = fx.join(fitted, "route_id", "left_semi").select("route_id", "seq", entry("lon", "lat", "elev", "ms"))
    joined = A.splice(own, around, matched)
    numbered = ordered(joined, line("route_id", ("part", "seq"), blocks=(
        F.col("part"), F.floor(F.col("seq") / BLOCK))), position="_no")
    return numbered.select("route_id", F.col("_no").alias("seq"), "part", "entry.*")


def georeference_site(frames: DataFrame, fixes: DataFrame, *, site: str = "site_id",
                      anchors: int = ANCHORS_PER_END, tolerance_ms: float = A.TOLERANCE_MS,
                      clean: bool = True, footprint: bool = True, mode: str = "full") -> DataFrame:
    """One fit per site on the pairs of all its anchored routes, applied to every route."""
    fr = clean_frames(frames) if clean else frames
    fx = A.long_enough(fixes)
    matched = checkpointed(anchor_matches(fr.drop(site), fx, anchors, tolerance_ms))
    homes = fr.groupBy("route_id").agg(F.min(site).alias(site))
    points = attach(A.match_points(matched, footprint), homes, "route_id")
    xyz = A.match_xyz(points, ["route_id", site], [site])
    fits = _solve(xyz, [site], mode, False)
    return to_entries(apply_fit(fr, fits, [site]))


def georeference_by_hand(frames: DataFrame, scale: float, yaw_deg: float,
                         north_east: tuple[float, float], origin: tuple[float, float, float],
                         start_ms: float) -> DataFrame:
    """Entries of frames moved by a manual transform around a known origin (lat, lon, elevation).
    ``frames``: ``video, slice, frame_idx, timestamp, position, rotation, footprint``."""
    lat, lon, elev = origin
    pos, rot, foot = G.manual_transform("position", "rotation", "footprint", scale, yaw_deg,
                                        north_east)
    moved = frames.withColumns({"_p": pos, "_r": rot, "_f": foot})
    geo = G.with_local_geo(moved, "_p", lon, lat, elev, "geo").withColumns({
        "height": L.dist("_f", "_p"), "angles": G.viewer_angles("_r"),
        "ms": F.lit(float(start_ms)) + F.col("timestamp") * 1000})
    return geo.withColumn("entry", G.geo_entry("geo", "ms", "height", "angles")) \
        .drop("_p", "_r", "_f")
