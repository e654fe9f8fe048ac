"""From raw documents to packed sequences: toxicity, near duplicates, benchmark leaks, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import order_minhash, packing, pii, tiling, toxicity
from skyledger.llm.common import folders, remove, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id."""
    return order_minhash.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it taken out; ``n_chars`` follows the text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place, read out of the sequences that were written."""
    return packing.places(stored(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2), "sequences"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: No stage is a SQL query over the given tables; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    last: list[str] = []
    for name, stage in STAGES[:-1]:
        known = set(folders())
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        *used, result = [folder for folder in folders() if folder not in known]
        # what the stage has written on its way, and the stage before it, are not read any more
        remove(spark, last + used)
        last = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
