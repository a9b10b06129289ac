"""Scans of scene, route, track, marker and transform documents into flat tables.

A document is read with its fixed schema and exploded; nothing is grouped or collected. The id of a
document is its folder name unless another pattern is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid import schemas as S
from posegrid.functions import geo as G
from posegrid.functions import linalg as L

FOLDER = r"([^/]+)/[^/]+$"
MARKER_NAME = r"([^/]+)_source_marker\.json$"


def _id(pattern: str) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def _exploded(docs: DataFrame, elements: str, pos: str, value: str, *kept: str) -> DataFrame:
    """``kept``, position and value of every element of an array column. For a plain explode Spark infers filters on the
    array, and each of them converts it once more where it is a field of a VARIANT."""
    return docs.select(*kept, F.posexplode_outer(elements).alias(pos, value)).where(F.col(pos).isNotNull())


# ------------------------------------------------------------------ scenes

def read_scenes(spark: SparkSession, paths, id_pattern: str = FOLDER) -> DataFrame:
    return spark.read.schema(S.SCENE_DOCUMENT).option("multiLine", True).json(paths) \
        .withColumn("scene_id", _id(id_pattern))


def scene_views(docs: DataFrame) -> DataFrame:
    """Views in document order, one row each."""
    data = F.col("_v.value.ptr_wrapper.data")
    return _exploded(docs, "views", "pos", "_v", "scene_id").select(
        "scene_id", F.col("_v.key").alias("view_key"), "pos",
        *[data[c].alias(c) for c in ("filename", "width", "height", "id_view", "id_intrinsic",
                                     "id_pose")])


def scene_poses(docs: DataFrame) -> DataFrame:
    """Poses with flat rotation and point centre; ``footprint`` is NULL where absent."""
    v = F.col("_e.value")
    return _exploded(docs, "extrinsics", "_pos", "_e", "scene_id").select(
        "scene_id", F.col("_e.key").alias("pose_key"), F.flatten(v["rotation"]).alias("rotation"),
        L.from_array(v["center"]).alias("center"), L.from_array(v["footprint"]).alias("footprint"))


def scene_points(docs: DataFrame) -> DataFrame:
    x = F.col("_s.value.X")
    return _exploded(docs, "structure", "_pos", "_s", "scene_id").select(
        "scene_id", F.col("_s.key").alias("point_id"), x[0].alias("x"), x[1].alias("y"),
        x[2].alias("z"))


def scene_intrinsics(docs: DataFrame) -> DataFrame:
    size = F.col("_i.value.ptr_wrapper.data.value0")
    return _exploded(docs, "intrinsics", "_pos", "_i", "scene_id").select(
        "scene_id", F.col("_i.key").alias("id_intrinsic"),
        F.col("_i.value.polymorphic_name").alias("camera"), size["width"].alias("width"),
        size["height"].alias("height"))


def view_ids(docs: DataFrame) -> DataFrame:
    """``scene_id, pos, id_view`` in document order."""
    return scene_views(docs).select("scene_id", "pos", "id_view")


# ------------------------------------------------------------------ routes

def read_routes(spark: SparkSession, paths, id_pattern: str = FOLDER) -> DataFrame:
    """Route documents of many slice folders; ``route_id`` is the folder."""
    return spark.read.schema(S.ROUTE_DOCUMENT).option("multiLine", True).json(paths) \
        .withColumn("route_id", _id(id_pattern))


def route_headers(docs: DataFrame) -> DataFrame:
    return docs.select("route_id", "is_scene", "video", "slice_beg_timestamp",
                       "slice_end_timestamp", "last_overwritten")


def object_routes(docs: DataFrame) -> DataFrame:
    return docs.filter("NOT is_scene").select(
        "route_id", "dir", L.from_array("position").alias("position"),
        F.flatten("rotation").alias("rotation"))


def route_frames(docs: DataFrame) -> DataFrame:
    """One row per frame of all slices; sort by ``timestamp`` only where a sink needs it."""
    f = F.col("_f")
    return _exploded(docs, "frames", "_pos", "_f", "route_id", "video").select(
        "route_id", "video", *[f[c].alias(c) for c in ("dir", "slice", "frame_idx", "timestamp",
                                                      "filenames")],
        L.from_array(f["position"]).alias("position"), F.flatten(f["rotation"]).alias("rotation"),
        L.from_array(f["footprint"]).alias("footprint"))


def route_lenses(docs: DataFrame) -> DataFrame:
    """One row per lens image of each frame."""
    f = F.col("_f")
    zipped = F.arrays_zip(f["filenames"].alias("filename"), f["lense_positions"].alias("p"),
                          f["lense_rotations"].alias("r"), f["lense_footprints"].alias("g"))
    return _exploded(docs, "frames", "_pos", "_f", "route_id").select(
        "route_id", f["slice"].alias("slice"), f["frame_idx"].alias("frame_idx"),
        f["timestamp"].alias("timestamp"), F.posexplode(zipped).alias("lens", "_l")).select(
        "route_id", "slice", "frame_idx", "timestamp", "lens",
        F.col("_l.filename").alias("filename"), L.from_array("_l.p").alias("center"),
        F.flatten("_l.r").alias("rotation"), L.from_array("_l.g").alias("footprint"))


# ------------------------------------------------------------------ tracks

def read_tracks(spark: SparkSession, paths, id_pattern: str = FOLDER) -> DataFrame:
    return spark.read.schema(S.TRACK_DOCUMENT).option("multiLine", True).json(paths) \
        .withColumn("route_id", _id(id_pattern))


def track_points(docs: DataFrame) -> DataFrame:
    """Both track formats as ``route_id, seq, lon, lat, elev, ms, height, alpha, beta, gamma``.

    Points with fewer than four numbers take their time from the properties and the default
    height.
    """
    coords = F.col("geometry.coordinates")
    times = F.col("properties.AbsoluteUtcMilliSec")
    plain = F.size(F.get(coords, F.lit(0))) < 4
    rows = docs.withColumn("_plain", plain).withColumn("_n", F.coalesce(F.when(
        plain, F.least(F.size(coords), F.size(times))).otherwise(F.size(coords)), F.lit(0)))
    # a point takes its own time along, not the list of all; outer for the reason given at _exploded, and the filter drops
    # what has no position
    timed = F.arrays_zip(coords.alias("c"), F.coalesce(times, F.array().cast("array<bigint>")).alias("t"))
    rows = rows.select("route_id", "_plain", "_n", F.posexplode_outer(timed).alias("seq", "_p")).filter(
        F.col("seq") < F.col("_n"))
    c = lambda i: F.try_element_at("_p.c", F.lit(i + 1))
    return rows.select(
        "route_id", F.col("seq").cast("bigint").alias("seq"), c(0).alias("lon"),
        c(1).alias("lat"), c(2).alias("elev"),
        F.when(F.col("_plain"), F.col("_p.t"))
        .otherwise(c(3).cast("bigint")).alias("ms"),
        F.when(F.col("_plain"), F.lit(G.DEFAULT_HEIGHT)).otherwise(c(4)).alias("height"),
        c(5).alias("alpha"), c(6).alias("beta"), c(7).alias("gamma"))


# ------------------------------------------------------------------ markers and logs

def read_markers(spark: SparkSession, paths, name_pattern: str = MARKER_NAME) -> DataFrame:
    """Marker entries in document order; the route name comes from the file name. ``mask`` entries
    are dropped."""
    return spark.read.text(paths, wholetext=True).withColumn("route_id", _id(name_pattern)) \
        .select("route_id", F.posexplode(F.from_json("value", f"array<{S.MARKER_ENTRY}>"))
                .alias("pos", "_m")).select(
            "route_id", "pos", F.col("_m.name").alias("name"), F.col("_m.begin").alias("begin_ms"),
            F.col("_m.end").alias("end_ms")).filter(~F.col("name").startswith("mask"))


def read_transform_logs(spark: SparkSession, paths, id_pattern: str = FOLDER) -> DataFrame:
    return spark.read.schema(S.TRANSFORM_LOG).option("multiLine", True).json(paths) \
        .withColumn("scene_id", _id(id_pattern))


def transform_entries(docs: DataFrame) -> DataFrame:
    return _exploded(docs, "list", "seq", "_t", "scene_id").select(
        "scene_id", "seq", F.flatten("_t.matrix").alias("matrix"),
        F.col("_t.timestamp").alias("ts"), F.col("_t.note").alias("note"))


def stored_products(docs: DataFrame) -> DataFrame:
    return docs.select("scene_id", F.flatten("concatenated").alias("matrix"))


# ------------------------------------------------------------------ listings

def list_images(spark: SparkSession, path: str, pattern: str = "*.{jpg,png}") -> DataFrame:
    """File listing of an image folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern) \
        .option("recursiveFileLookup", True).load(path).select("path", "length").withColumn(
        "filename", F.element_at(F.split("path", "/"), -1))


def hashed_images(spark: SparkSession, path: str, pattern: str = "*.{jpg,png}") -> DataFrame:
    """Image names with a content hash before the extension."""
    from posegrid.functions.names import hashed_name
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern) \
        .option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("filename"),
                        hashed_name(name, "content").alias("hashed_filename"))


def read_key_frames(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``scene_id, frame_idx`` of selected key frames."""
    reader = spark.read.schema("scene_id string, frame_idx bigint")
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_node_names(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Repository names with their base name."""
    from posegrid.functions.names import repository_base
    return spark.read.schema("name string").format(fmt).load(path).withColumn(
        "base_name", repository_base("name"))
