"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
next one's ``docs``; all but the last return the columns of ``documents``.

1. quality    documents that the compression classifier scores under one half go. The model is fitted on
              labelled documents outside the held-out third.
2. lines      lines of recurring templates go; every document stays, some of them shorter.
3. copies     one document of each group of copies and near copies stays, the one with the smallest id: SimHash links
               of the vantage-point trees, confirmed exactly, and what an exact join of shingles finds beside them.
4. secrets    every secret is replaced by a mark; every document stays.
5. packing    token ids in sequences of 2048, one row per piece.

``n_chars`` follows the text. A null text is scored like an empty one. The third stage takes near copies at a
similarity of 0.8 on five words. Fingerprints alone miss many of these, so the join of the first shingles of a common
order completes their links.
An empty table stays empty; without labels of both classes no document is rejected; repeated rows with one id keep one
row; very long texts are treated whole; columns beside those of ``documents`` pass through all stages but the last.

A stage's result has been written when the next one begins; the tables that it wrote on its way are deleted then.
Texts go to Python in batches of at most ``BATCH_BYTES``, unless the session has a limit of its own: a batch is held by
the executor, by Arrow and as Python objects at the same time, in each worker, and workers keep what they once had.
SQL can't express the first stage (zstandard) or the last (byte-pair tokens); tests compare the stages with
brute force.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posegrid.llm import line_templates, packing, quality_zstd, secrets, simhash
from posegrid.llm.common import drop_tables, noting, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, the number of characters set anew."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")
                         for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_zstd.keep_good(docs, table(spark, sf_dir, "labels"), usable=quality_zstd.fold() != 1)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_templates.drop_templates(docs), docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def secret_marks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


#: tables of the stage before
_LEFT: list[str] = []


def _small_batches(spark: SparkSession) -> None:
    """Limit the batches of ``spark``, whose plans are made when a stage's result is read."""
    if BATCH_LIMIT not in spark.conf.getAll:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def _clearing(stage: Stage, last: bool = False) -> Stage:
    """``stage`` with small batches that first deletes what the one before left. The tables of the last one stay, as its
    result is read after it."""
    @wraps(stage)
    def cleared(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _small_batches(spark)
        drop_tables(spark, _LEFT)
        with noting([] if last else _LEFT):
            return stage(spark, docs, sf_dir)
    return cleared


STAGES: list[tuple[str, Stage]] = [
    ("quality", _clearing(quality)), ("lines", _clearing(lines)), ("copies", _clearing(copies)),
    ("secrets", _clearing(secret_marks)), ("packing", _clearing(pack, last=True))]

#: the rows of ``run`` depend on zstandard and on a tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each intermediate result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    results: list[str] = []
    for _, stage in STAGES[:-1]:
        before, results = results, []
        with noting(results):
            out = stage(spark, docs, sf_dir)
            docs = written(out)
        drop_tables(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
