import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from posegrid.llm import quality_zstd, simhash
from posegrid.llm.common import table, written
from posegrid.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.01"


def sample(n=1500, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choices(["the", "and", "ing", "er", "on", "th", "ion", "ou"], k=r.randint(1, 4))) for _ in range(600)]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 300))]
        kind = i % 4
        if kind == 1:
            text = [w.upper() + "!!" for w in text]
        elif kind == 2 and i % 8 == 2:
            text = [w for w in text[:12] for _ in range(15)]
        rows.append((i, " ".join(text), int(not (kind == 1 or (kind == 2 and i % 8 == 2)))))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    rows = sample()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    return rows, docs, labels, quality_zstd.fit(docs, labels, usable=quality_zstd.fold() != 1)


def test_held_out_accuracy(learned):
    rows, docs, _, model = learned
    got = {r["doc_id"]: r["score"] for r in quality_zstd.score(docs, model).collect()}
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 300 and np.mean([(got[i] >= 0.5) == rows[i][2] for i in out]) > 0.98


def test_held_out_labels_are_not_read(spark, learned):
    rows, docs, labels, model = learned
    flipped = labels.withColumn("quality", F.when(quality_zstd.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_zstd.fit(docs, flipped, usable=quality_zstd.fold() != 1) == model


def test_whole_texts_are_scored():
    model = quality_zstd.fit_rows([t for _, t, _ in sample(400)], [q for _, _, q in sample(400)])
    sizes = quality_zstd.Sizes(model.good, model.bad, model.chunk, model.level)
    good, bad = sample(8)[0][1], sample(8)[1][1]
    head = good * 20
    assert sizes.features(head) != sizes.features(head + bad) and sizes.features(head) != sizes.features(bad + head)


def test_fold_is_crc32(spark):
    got = spark.range(50).select("id", quality_zstd.fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in got)


def test_odd_rows(learned, odd, nothing, labels):
    _, _, _, model = learned
    got = quality_zstd.score(odd, model)
    assert got.count() == odd.count() and got.schema["score"].dataType.typeName() == "double"
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    assert quality_zstd.score(nothing, model).count() == 0
    assert quality_zstd.keep_good(odd, labels).columns == odd.columns
    with pytest.raises(ValueError):
        quality_zstd.fit(odd, labels.where("quality = 1"))
    with pytest.raises(ValueError):
        quality_zstd.fit(nothing, labels)


# ------------------------------------------------------------------ pipeline

def test_stages_are_the_named_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "copies", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_over_the_small_tables(spark):
    docs = table(spark, SF_DIR, "documents")
    marks = table(spark, SF_DIR, "labels").where("quality = 1")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR))
        results[name] = docs
        assert name == "packing" or docs.columns == columns
        assert name == "packing" or docs.where("n_chars <> length(text)").count() == 0
    first = table(spark, SF_DIR, "documents").join(marks, "doc_id")
    assert results["quality"].join(marks, "doc_id").count() > 0.97 * first.count()
    assert results["lines"].count() == results["quality"].count()
    # one of each group: a second run finds nothing to drop
    assert simhash.keep_one(results["copies"]).count() == results["copies"].count()
    assert results["secrets"].count() == results["copies"].count()
    assert results["secrets"].where(r"text rlike 'token = \"[0-9a-f]{40}'").count() == 0
    assert results["copies"].where(r"text rlike 'token = \"[0-9a-f]{40}'").count() > 0
    packed = results["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert packed.count() == results["secrets"].count() and packed.where("n <> t").count() == 0


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    docs = spark.createDataFrame(odd.collect() + [], odd.schema)
    good = [(100 + i, t, "en", "s", len(t), *["x"] * 7) for i, t, q in sample(80)]
    docs = docs.union(spark.createDataFrame(good, odd.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, q) for i, _, q in sample(80)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)))
        assert name == "packing" or docs.columns == odd.columns
    assert docs.count() > 0


def test_queries_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_nothing_to_learn_from(spark, odd, nothing, labels):
    """No documents, no labels, or labels of one class: the score is one half and no document goes."""
    for docs, marks in ((odd, labels.where("quality = 1")), (odd, labels.limit(0)), (nothing, labels)):
        model = quality_zstd.fit_if_possible(docs, marks)
        assert model == quality_zstd.FLAT
        assert {r["score"] for r in quality_zstd.score(docs, model).collect()} <= {0.5}
        kept = quality_zstd.keep_good(docs, marks)
        assert kept.columns == docs.columns and kept.count() == docs.count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_batches_of_texts_are_small(spark, tmp_path):
    """What goes to Python at once is bounded in bytes, however long the texts; a limit of the session's own stays."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    for own in (None, "1m"):
        session = spark.newSession()
        if own:
            session.conf.set(corpus_pipeline.BATCH_LIMIT, own)
        docs = session.range(0, 3000, 1, 1).select(
            F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 900).alias("text"), F.lit("en").alias("lang"),
            F.lit("s").alias("source"), F.lit(9900).cast("long").alias("n_chars"))
        marks = session.createDataFrame([(1, 1)], "doc_id long, quality int")
        marks.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        kept = corpus_pipeline.STAGES[0][1](session, docs, str(tmp_path))
        got = kept.mapInArrow(sizes, "n long, bytes long").agg(F.sum("n"), F.max("bytes")).first()
        assert got[0] == 3000 and got[1] < (1_200_000 if own else 5_000_000)
