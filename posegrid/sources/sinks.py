"""Document and table sinks.

A document (scene or route JSON, GeoJSON, PLY, tree) is written as text lines that are
range-partitioned by document, section and row. Its folder holds part files whose contents in name
order are the document, so a document of any size is written by many tasks. Many small JSON documents
are bundled instead: each task writes one file of JSON text sequences (``json_sequences``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posegrid.functions import linalg as L
from posegrid.functions import names as N
from posegrid.scale import attach, line, ordered

ORDER = ("section", "ord")
#: what begins a document in a bundle (RFC 7464), and the name of a folder without a document id
RECORD = "\x1e"
NO_ID = "__HIVE_DEFAULT_PARTITION__"


def text_documents(lines: DataFrame, path: str, order: Sequence[str] = ORDER,
                   mode: str = "overwrite") -> None:
    """Write ``doc_id, *order, value`` lines as one folder ``doc_id=<id>`` per document."""
    lines.repartitionByRange("doc_id", *order).sortWithinPartitions("doc_id", *order) \
        .select("doc_id", "value").write.mode(mode).partitionBy("doc_id").text(path)


def json_sequences(lines: DataFrame, path: str, order: Sequence[str] = ORDER, mode: str = "overwrite") -> None:
    """Write ``doc_id, *order, value`` lines as bundles: files of many JSON documents, each a record separator, the
    id as a line of JSON and the document's lines. The number of files follows the size of the data, not the number
    of documents. Documents are not cut between files, as a reader takes them whole."""
    # in JSON a separator can stand in a string only, where its escape means the same
    value = F.replace("value", F.lit(RECORD), F.lit("\\u001e"))
    doc_id = F.col("doc_id").cast("string")
    head = F.concat(F.lit(RECORD), F.to_json(F.struct(F.when(doc_id != "", doc_id).otherwise(NO_ID).alias("doc_id"))),
                    F.lit("\n"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)) == 1
    lines.select("doc_id", *order, value.alias("value"), first.alias("_first")).select(
        F.concat(F.when(F.col("_first"), head).otherwise(""), "value").alias("value")).write.mode(mode).text(path)


def _literal(docs: DataFrame, section: int, value: Column) -> DataFrame:
    return docs.select("doc_id", F.lit(section).alias("section"),
                       F.lit(0).cast("bigint").alias("ord"), value.alias("value"))


def _elements(rows: DataFrame, section: int, order: str, value: Column) -> DataFrame:
    """JSON array elements, one line each, with a comma before all but the first."""
    first = rows.groupBy("doc_id").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("n"))
    return attach(rows, first, "doc_id").select(
        "doc_id", F.lit(section).alias("section"), F.col(order).cast("bigint").alias("ord"),
        F.concat(F.when(F.col(order) == F.col("_first"), "").otherwise(","), value)
        .alias("value"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ JSON documents

def scene_lines(scenes: DataFrame, views: DataFrame, poses: DataFrame,
                intrinsics: DataFrame | None = None, points: DataFrame | None = None) -> DataFrame:
    """Scene documents from flat tables. ``scenes``: ``scene_id, sfm_data_version, root_path``."""
    docs = scenes.withColumnRenamed("scene_id", "doc_id")
    as_doc = lambda df: df.withColumnRenamed("scene_id", "doc_id")
    data = F.struct(F.lit("").alias("local_path"), "filename", "width", "height", "id_view",
                    "id_intrinsic", "id_pose")
    view = F.to_json(F.struct(F.col("view_key").alias("key"), F.struct(
        F.lit(1073741824).alias("polymorphic_id"), F.struct(
            (F.col("view_key") + 2147483649).alias("id"), data.alias("data"))
        .alias("ptr_wrapper")).alias("value")))
    pose_cols = [L.flat_to_rows("rotation").alias("rotation"),
                 L.point_to_array("center").alias("center")]
    if "footprint" in poses.columns:
        pose_cols.append(L.point_to_array("footprint").alias("footprint"))
    pose = F.to_json(F.struct(F.col("pose_key").alias("key"), F.struct(*pose_cols).alias("value")))
    parts = [
        _literal(docs, 0, F.concat(F.lit('{"sfm_data_version":"'), "sfm_data_version",
                                   F.lit('","root_path":"'), "root_path", F.lit('","views":['))),
        _elements(as_doc(views), 1, "view_key", view),
        _literal(docs, 2, F.lit('],"intrinsics":[')),
        _literal(docs, 4, F.lit('],"extrinsics":[')),
        _elements(as_doc(poses), 5, "pose_key", pose),
        _literal(docs, 6, F.lit('],"structure":[')),
        _literal(docs, 8, F.lit('],"control_points":[]}'))]
    if intrinsics is not None:
        size = F.struct("width", "height")
        cam = F.to_json(F.struct(F.col("id_intrinsic").alias("key"), F.struct(
            F.lit(2147483649).alias("polymorphic_id"), F.col("camera").alias("polymorphic_name"),
            F.struct(F.lit(2147483649).alias("id"), F.struct(size.alias("value0")).alias("data"))
            .alias("ptr_wrapper")).alias("value")))
        parts.append(_elements(as_doc(intrinsics), 3, "id_intrinsic", cam))
    if points is not None:
        pt = F.to_json(F.struct(F.col("point_id").alias("key"),
                                F.struct(F.array("x", "y", "z").alias("X")).alias("value")))
        parts.append(_elements(as_doc(points), 7, "point_id", pt))
    return _union(parts)


def route_lines(headers: DataFrame, frames: DataFrame) -> DataFrame:
    """Route documents from headers (``route_id, video, slice_beg_timestamp,
    slice_end_timestamp, last_overwritten``) and frames with arrays per lens. Frames are ordered by
    ``frame_idx``."""
    docs = headers.withColumnRenamed("route_id", "doc_id")
    head = F.to_json(F.struct(F.lit(True).alias("is_scene"), "video", "slice_beg_timestamp",
                              "slice_end_timestamp", "last_overwritten"))
    frame_cols = [c for c in ("dir", "slice", "frame_idx", "timestamp", "filenames",
                              "lense_positions", "lense_rotations", "lense_footprints")
                  if c in frames.columns]
    frame = F.to_json(F.struct(*frame_cols, L.point_to_array("position").alias("position"),
                               F.when(F.col("rotation").isNotNull(), L.flat_to_rows("rotation"))
                               .alias("rotation"),
                               L.point_to_array("footprint").alias("footprint")),
                      {"ignoreNullFields": "false"})
    return _union([
        _literal(docs.withColumn("_h", head), 0, F.concat(
            F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"frames":['))),
        _elements(frames.withColumnRenamed("route_id", "doc_id"), 1, "frame_idx", frame),
        _literal(docs, 2, F.lit("]}"))])


def geojson_lines(entries: DataFrame, order: str = "seq", key: str = "route_id",
                  properties: DataFrame | None = None) -> DataFrame:
    """``Feature`` / ``LineString`` documents of ``key, order, entry array<double>``.
    ``properties``: ``key, properties`` JSON text."""
    rows = entries.withColumnRenamed(key, "doc_id")
    docs = rows.select("doc_id").distinct()
    props = F.lit("{}")
    if properties is not None:
        docs = docs.join(properties.withColumnRenamed(key, "doc_id"), "doc_id", "left")
        props = F.coalesce("properties", F.lit("{}"))
    return _union([
        _literal(docs, 0, F.lit('{"type":"Feature","geometry":{"type":"LineString",'
                                '"coordinates":[')),
        _elements(rows, 1, order, F.to_json("entry")),
        _literal(docs, 2, F.concat(F.lit(']},"properties":'), props, F.lit("}")))])



# ------------------------------------------------------------------ coloured points

def coloured_path(points: DataFrame, order: str, key: str) -> DataFrame:
    """Vertices of a path painted with the rainbow by position among all rows, ready for the PLY
    sinks; rows without a point are left out. ``points``: ``key, order, point``."""
    rows = ordered(points, line(key, order), position="_i", size="_n")
    rows = rows.filter("point IS NOT NULL").withColumn("_c", N.rainbow("_i", "_n"))
    return rows.select(F.col(key).cast("string").alias("mesh_id"), F.col("_i").alias("vid"),
                       *[F.col("point")[a].alias(a) for a in L.AXES],
                       *[F.col("_c")[c].alias(c) for c in ("red", "green", "blue")])


def route_points(frames: DataFrame, column: str = "position") -> DataFrame:
    """Coloured vertices of a route's poses or footprints."""
    return coloured_path(frames.select("route_id", "frame_idx", F.col(column).alias("point")),
                         "frame_idx", "route_id")


def scene_pose_points(poses: DataFrame, column: str = "center") -> DataFrame:
    return coloured_path(poses.select("scene_id", "pose_key", F.col(column).alias("point")),
                         "pose_key", "scene_id")


# ------------------------------------------------------------------ other text and tables

def pair_list_documents(lines: DataFrame) -> DataFrame:
    """Pair lines as documents, ordered by a hash-free row key (``view_a, view_b``)."""
    return lines.select(F.col("scene_id").cast("string").alias("doc_id"),
                        F.split("value", " ")[0].cast("bigint").alias("section"),
                        F.split("value", " ")[1].cast("bigint").alias("ord"), "value")


def trajectory_lines(trajectory: DataFrame) -> DataFrame:
    """``[[t_ms, x, y, z, qx, qy, qz, qw], ...]`` per capture."""
    rows = trajectory.withColumn("doc_id", F.col("capture_id").cast("string"))
    docs = rows.select("doc_id").distinct()
    value = F.to_json(F.array("t_ms", "x", "y", "z", "qx", "qy", "qz", "qw"))
    return _union([_literal(docs, 0, F.lit("[")), _elements(rows, 1, "t_ms", value),
                   _literal(docs, 2, F.lit("]"))])


def marker_lines(markers: DataFrame) -> DataFrame:
    """Marker documents of ``route_id, pos, name, begin_ms, end_ms``."""
    rows = markers.withColumn("doc_id", F.col("route_id").cast("string"))
    docs = rows.select("doc_id").distinct()
    value = F.to_json(F.struct("name", F.col("begin_ms").alias("begin"), F.col("end_ms").alias("end")),
                      {"ignoreNullFields": "false"})
    return _union([_literal(docs, 0, F.lit("[")), _elements(rows, 1, "pos", value), _literal(docs, 2, F.lit("]"))])


def object_route_lines(routes: DataFrame) -> DataFrame:
    """Object route documents of ``route_id, dir, position, rotation``, a line each."""
    value = F.to_json(F.struct(F.lit(False).alias("is_scene"), "dir", L.point_to_array("position").alias("position"),
                               L.flat_to_rows("rotation").alias("rotation")))
    return _literal(routes.withColumn("doc_id", F.col("route_id").cast("string")).withColumn("_v", value), 0, F.col("_v"))


def tree_documents(tree_lines: DataFrame) -> DataFrame:
    """Lines of nested trees as documents, one per root."""
    return tree_lines.select(F.col("root").cast("string").alias("doc_id"), F.lit(0).alias("section"), "ord", "value")


def transform_log_lines(log: DataFrame, products: DataFrame) -> DataFrame:
    """Transform log documents: the product and the list of matrices."""
    rows = log.withColumnRenamed("scene_id", "doc_id")
    docs = products.withColumnRenamed("scene_id", "doc_id")
    item = F.to_json(F.struct(L.flat_to_rows("matrix", 4).alias("matrix"),
                              F.col("ts").alias("timestamp"), "note"))
    return _union([
        _literal(docs, 0, F.concat(F.lit('{"concatenated":'),
                                   F.to_json(L.flat_to_rows("matrix", 4)), F.lit(',"list":['))),
        _elements(rows, 1, "seq", item), _literal(docs, 2, F.lit("]}"))])


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] = ()) -> None:
    """Parquet table, partitioned by scene or route where wanted."""
    w = df.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
