"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid.llm import (html_cut, itq, licenses, line_templates, merkle, packing, pieces, quality_zstd,
                          risk_rules, secrets, simhash, sql_twins, urls, whitening)
from posegrid.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return add


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secrets.spans("text").alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s.startswith(f"{kind}:"))).cast("long")
    base = F.filter("found", lambda s: ~s.startswith("entropy:"))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join("found", ",").alias("spans"))


@query("op7_compression_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality_zstd.fold() == 1
    model = quality_zstd.fit_if_possible(docs, table(spark, sf_dir, "labels"), usable=~held_out)
    scored = quality_zstd.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = pieces.decode(pieces.encode(docs))
    return back.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("op8_html_min_cut")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_cut.extract(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op1_quality_rules", sql_twins.quality_rules())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = risk_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


# Host, path and verdict of the rules that the query applies.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query("op2_url_filter", f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
 u AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN instr(url, '://') > 0
       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
 p AS (SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
 hit AS (SELECT n, arg_max(r.host || r.path, len(r.host) * 100000 + len(r.path)) AS rule,
       arg_max(r.verdict, len(r.host) * 100000 + len(r.path)) AS verdict
       FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
       GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN hit USING (n)""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op9_line_templates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_templates.drop_templates(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op5_embedding_itq")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.cluster(table(spark, sf_dir, "embeddings"))


@query("op11_merkle_manifest", sql_twins.merkle_manifest())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(docs, ["doc_id", "source", "lang", "n_chars", "text"], {"text": text})


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_license_scan")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("places")
