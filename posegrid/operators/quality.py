"""Completeness and validity rules; each yields violation rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posegrid.operators.frames import marker_times


def marker_span(markers: DataFrame) -> DataFrame:
    """Per route, whether every node time lies inside its start and end."""
    t = marker_times(markers)
    return t.groupBy("route_id").agg(
        F.bool_and(F.col("node_s").between(F.col("ss"), F.col("to"))).alias("is_valid"))


def count_mismatches(required: DataFrame, listing: DataFrame) -> DataFrame:
    """Requirements ``tag, label, expected`` whose number of listed files differs."""
    found = listing.groupBy("tag", "label").agg(F.count(F.lit(1)).alias("found"))
    out = required.join(found, ["tag", "label"], "left").withColumn(
        "found", F.coalesce("found", F.lit(0)))
    return out.filter(F.col("found") != F.col("expected"))


def not_exactly_one(listing: DataFrame, label: str, repositories: DataFrame) -> DataFrame:
    """Repositories that do not have exactly one file with the label.
    ``listing``: ``repository, path, labels array<string>``."""
    hits = listing.filter(F.array_contains("labels", label)).groupBy("repository").agg(
        F.count(F.lit(1)).alias("n_files"))
    return repositories.join(hits, "repository", "left").withColumn(
        "n_files", F.coalesce("n_files", F.lit(0))).filter("n_files <> 1")


def labelled_file(listing: DataFrame, label: str) -> DataFrame:
    """The file with the label, for repositories that have exactly one."""
    return listing.filter(F.array_contains("labels", label)).groupBy("repository").agg(
        F.min("path").alias("path"), F.count(F.lit(1)).alias("n_files")) \
        .filter("n_files = 1").drop("n_files")


def pick_by_pattern(listing: DataFrame, patterns: list[str], key: str = "repository",
                    path: str = "path") -> DataFrame:
    """First file by pattern priority, then by name; keys without any match are absent."""
    rank: Column | None = None
    for i, p in enumerate(patterns):
        rank = F.when(F.col(path).rlike(p), i) if rank is None else \
            rank.when(F.col(path).rlike(p), i)
    return listing.withColumn("_rank", rank).filter("_rank IS NOT NULL").groupBy(key).agg(
        F.min(F.struct("_rank", path)).alias("_m")).select(key, F.col(f"_m.{path}").alias(path))


def run_rules(tables: Mapping[str, DataFrame],
              rules: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame | None:
    """Apply each label's rule to its files; a rule returns violations with a ``path`` column.
    The first failing path per label is reported."""
    out: DataFrame | None = None
    for label, rule in rules.items():
        bad = rule(tables[label]).select(F.lit(label).alias("label"), "path")
        out = bad if out is None else out.unionByName(bad)
    return None if out is None else out.groupBy("label").agg(
        F.min("path").alias("first_failing"), F.count(F.lit(1)).alias("n_failing"))


def completion_status(nodes: DataFrame, failed: DataFrame) -> DataFrame:
    """``node, status, reason`` of all nodes."""
    return nodes.join(failed.select("node", "reason"), "node", "left").withColumn(
        "status", F.when(F.col("reason").isNull(), "complete").otherwise("failed")) \
        .select("node", "status", "reason")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")


def set_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_semi")
