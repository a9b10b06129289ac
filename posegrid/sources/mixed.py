"""One scan over folders of documents of several formats.

Every document becomes a VARIANT value, and its format is told from what it holds, not from its name. Typed views of
one format then have the columns that the readers of ``documents`` give, so all flattening functions apply.
Documents that were written as text lines (``sinks.text_documents``) are several part files in a folder of their own;
their texts are put together in name order. Small documents lie many to a file, as JSON text sequences
(``sinks.json_sequences``), each read as a row of its own. A document is one value, of at most 128 MB (Spark's limit of
a VARIANT; larger ones end the job and are read with the readers of ``documents``).

Results for odd inputs: a text that is no JSON, or has no known format, keeps its row with kind NULL; an empty
folder has no rows; fields that a document lacks are NULL, fields that no view knows are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from posegrid import schemas as S
from posegrid.sources import sinks
from posegrid.sources.documents import MARKER_NAME


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, file, kind, doc`` of all documents below ``path``: kind is scene, route, object, track, log or markers.

    ``doc_id`` is the folder's name, ``file`` the file's (NULL for part files)."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.regexp_replace(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1), "^doc_id=", "").alias("doc_id"),
        F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]+$", 1).alias("folder"),
        F.col("_metadata.file_name").alias("name"), "value")
    own = F.when(~F.col("name").startswith("part-"), F.col("name"))
    # what one document consists of, and that must be one value to be parsed
    whole = files.groupBy("doc_id", "folder", own.alias("file")).agg(
        F.sort_array(F.collect_list(F.struct("name", "value"))).alias("parts"))
    docs = whole.select("doc_id", "file", F.try_parse_json(
        F.array_join(F.transform("parts", lambda p: p["value"]), "")).alias("doc"))
    return _told(docs)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Documents of all bundles below ``path``, as ``read_any`` gives them (``file`` is NULL)."""
    records = spark.read.option("recursiveFileLookup", True).text(path, lineSep=sinks.RECORD).where("value <> ''")
    # explode keeps filters on the parsed value from parsing the text again
    doc = F.explode(F.array(F.try_parse_json(F.substr("value", F.instr("value", "\n") + 1))))
    docs = records.select(F.get_json_object(F.substring_index("value", "\n", 1), "$.doc_id").alias("doc_id"),
                          F.lit(None).cast("string").alias("file"), doc.alias("doc"))
    return _told(docs)


def _told(docs: DataFrame) -> DataFrame:
    """``docs`` with the kind that their values tell."""
    # a field taken as a variant is copied as a whole; arrays and objects show without that
    as_type = lambda field, t: F.try_variant_get("doc", f"$.{field}", t).isNotNull()
    has = lambda field: (as_type(field, "array<boolean>") | as_type(field, "map<string, boolean>")
                         | as_type(field, "variant"))
    scene = F.try_variant_get("doc", "$.is_scene", "boolean")
    kind = (F.when(has("views"), "scene").when(scene, "route").when(~scene, "object").when(has("geometry"), "track")
            .when(has("concatenated"), "log").when(F.schema_of_variant("doc").startswith("ARRAY"), "markers"))
    return docs.withColumn("kind", kind).select("doc_id", "file", "kind", "doc")


def _typed(docs: DataFrame, kinds: tuple[str, ...], ddl: str, key: str) -> DataFrame:
    # field by field, so that fields which nothing reads are not converted
    fields = [F.variant_get("doc", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in StructType.fromDDL(ddl)]
    return docs.where(F.col("kind").isin(*kinds)).select(*fields, F.col("doc_id").alias(key))


def scenes(docs: DataFrame) -> DataFrame:
    return _typed(docs, ("scene",), S.SCENE_DOCUMENT, "scene_id")


def routes(docs: DataFrame) -> DataFrame:
    """Scene and object routes."""
    return _typed(docs, ("route", "object"), S.ROUTE_DOCUMENT, "route_id")


def tracks(docs: DataFrame) -> DataFrame:
    return _typed(docs, ("track",), S.TRACK_DOCUMENT, "route_id")


def transform_logs(docs: DataFrame) -> DataFrame:
    return _typed(docs, ("log",), S.TRANSFORM_LOG, "scene_id")


def markers(docs: DataFrame) -> DataFrame:
    """Marker entries in document order; the route is named by the file, or by the folder of part files."""
    return docs.sparkSession.sql("""
        SELECT coalesce(nullif(regexp_extract(d.file, {name}, 1), ''), d.doc_id) AS route_id, CAST(e.pos AS INT) AS pos,
          variant_get(e.value, '$.name', 'string') AS name, variant_get(e.value, '$.begin', 'bigint') AS begin_ms,
          variant_get(e.value, '$.end', 'bigint') AS end_ms
        FROM {docs} d, LATERAL variant_explode(d.doc) e
        WHERE d.kind = 'markers'""", docs=docs, name=MARKER_NAME.replace("\\", "\\\\")).where(
        F.coalesce(~F.col("name").startswith("mask"), F.lit(True)))
