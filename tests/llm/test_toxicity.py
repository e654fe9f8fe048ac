"""Toxicity: the models against hand counts, and accuracy on documents held out."""

from __future__ import annotations

import math
import zlib

import pytest
from pyspark.sql import functions as F

from skyledger.llm import toxicity


def test_model_by_hand(spark):
    counts = spark.createDataFrame(
        [(None, 1000, 0, 0, 0, 0), ("vile", 12, 8, 0, 2, 0), ("the", 500, 10, 90, 5, 50), ("rare", 2, 1, 1, 0, 0)],
        "word string, documents bigint, toxic bigint, ordinary bigint, toxic_late bigint, ordinary_late bigint",
    )
    told, rest = toxicity.model(counts, late=False)
    free_toxic, free_ordinary = 1 - (5.5 + 7.5) / 19, 1 - 87.5 / 91
    assert set(told) == {"vile", "the"} and rest == pytest.approx(math.log(free_toxic / free_ordinary))
    assert told["vile"] == pytest.approx(math.log((5.5 / 19 + free_toxic * 0.012) / (free_ordinary * 0.012)))
    assert toxicity.model(counts, late=True)[0]["vile"] > told["vile"] - 1
    assert toxicity.model(counts.where("word is null"), late=True) == ({}, 0.0)


def _docs(spark, n=1200):
    """A tenth is toxic, by one of eight words among many ordinary ones; ids and sources tell nothing."""
    word = F.concat(F.lit("w"), F.pmod(F.xxhash64("id", "k"), F.lit(400)))
    texts = spark.range(n).select("id", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("k")).groupBy("id").agg(F.array_join(F.collect_list(word), " ").alias("text"))
    toxic = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(10)) == 0
    slur = F.concat(F.lit(" slur"), F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(8)), F.lit(" end"))
    docs = texts.select(F.col("id").alias("doc_id"), F.when(toxic, F.concat("text", slur)).otherwise(F.col("text")).alias("text"), F.lit("en").alias("lang"))
    labels = texts.select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), toxic.cast("int").alias("toxic"))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = _docs(spark)
    rows = toxicity.score(docs, labels).join(labels, "doc_id").toPandas()
    assert len(rows) == 1200 and rows.score.between(0, 1).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.toxic).mean() > 0.98 and ((rows.score >= 0.5).astype(int) == rows.predicted).all()


def test_held_out_labels_are_not_read(spark):
    docs, labels = _docs(spark, 400)
    other = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = toxicity.score(docs, labels).select("doc_id", "score")
    assert first.exceptAll(toxicity.score(docs, other).select("doc_id", "score")).count() == 0


def test_odd_rows(spark):
    docs, labels = _docs(spark, 300)
    extra = [(None, "slur1 end"), (5000, None), (5001, ""), (5001, ""), (5002, "w1 " * 50_000)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string")).withColumns({"score": F.lit("s"), "word": F.lit(1)})
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5000, 1, None), (7, 1, 1), (7, 0, 0)], "doc_id bigint, quality int, toxic int"))
    rows = toxicity.score(docs, labels)
    assert rows.count() == 305 and rows.where("score is null or held_out is null").count() == 0
    for few in (labels.limit(0), labels.where("toxic = 0")):
        assert toxicity.score(docs, few).where("predicted <> 0").count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0
    kept = toxicity.clean(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and 250 < kept.count() < 305


def test_sample_has_a_bound(spark):
    _, labels = _docs(spark, 500)
    assert len(toxicity.labelled(labels, 30)) == 60
