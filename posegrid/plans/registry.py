"""Named implementations behind configuration strings."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from posegrid.operators import frames, outliers, pairs, poses, quality

_KINDS: dict[str, dict[str, Callable]] = {"filter": {}, "pairing": {}, "refiner": {},
                                          "sampler": {}, "rule": {}}


def register(kind: str, name: str, fn: Callable) -> None:
    """Add an implementation: a function from DataFrames and options to a DataFrame."""
    _table(kind)[name] = fn


def lookup(kind: str, name: str) -> Callable:
    table = _table(kind)
    if name not in table:
        raise ValueError(f"unknown {kind} {name!r}; known: {sorted(table)}")
    return table[name]


def _table(kind: str) -> dict[str, Callable]:
    if kind not in _KINDS:
        raise ValueError(f"unknown kind {kind!r}; known: {sorted(_KINDS)}")
    return _KINDS[kind]


register("filter", "covariance", outliers.robust_covariance_filter)
register("filter", "curve", outliers.curve_filter)
register("pairing", "window", pairs.window_pairs)
register("pairing", "backbone_detail", pairs.backbone_runs)
register("pairing", "slice_rig", pairs.rig_pairs)
register("refiner", "rig_mean", poses.rig_mean)
register("refiner", "rig_center", poses.rig_center)
register("sampler", "all", frames.all_frames)
register("sampler", "uniform_video", frames.uniform_video_sample)
register("sampler", "uniform_rig", frames.uniform_rig_sample)
register("rule", "marker_span", quality.marker_span)
register("rule", "count_mismatches", quality.count_mismatches)
register("rule", "not_exactly_one", quality.not_exactly_one)
register("rule", "capture_window", frames.window_violations)
register("rule", "increasing_time", frames.timestamp_violations)


def run_named_rules(tables: Mapping[str, DataFrame], paths: Mapping[str, Column]) -> DataFrame | None:
    """Apply the rules registered under the names of ``tables`` and report the first failing path of each.

    ``paths`` says what of a rule's result names the failing item; rows where it is NULL do not fail."""
    def failing(name: str) -> Callable[[DataFrame], DataFrame]:
        rule = lookup("rule", name)
        return lambda t: rule(t).select(paths[name].alias("path")).where("path IS NOT NULL")

    return quality.run_rules(tables, {name: failing(name) for name in tables})
