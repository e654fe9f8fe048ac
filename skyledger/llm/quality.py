"""Quality rules, and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words, runs of punctuation and pairs of neighbours are hashed into ``BUCKETS`` buckets. Counts over all documents make
the raw multinomial, counts over trusted documents the target one. A document is scored by the mean log ratio of its
n-grams, counts(target) + SHRINK over expected(raw) + SHRINK, its own n-grams taken out of both: so rare n-grams say
little, a document is not held against itself, and clean texts lie around 0 for any size of corpus. It passes if the
score is at least ``THRESHOLD``, the same for every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import WORD, arrow_schema, batch_of, map_rows

BUCKET_BITS, SHRINK, THRESHOLD, WINDOW = 16, 16.0, -0.12, 5
#: Trusted rows that are used at most: those with the smallest hashes of their ids.
TRUSTED_ROWS = 32_768
_TOKEN = re.compile(r"\w+|[^\w\s]+")
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_SHARE = 10, 20
_COUNTED = "kind int, bucket int, n bigint"
_SCORED = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, llr double"


def buckets(text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of the words and runs of punctuation and of the pairs of neighbours, lower case."""
    tokens = _TOKEN.findall(text.lower())
    if not tokens:
        return np.empty(0, np.int64)
    codes = np.fromiter(map(crc32, map(str.encode, tokens)), np.uint64, len(tokens))
    pairs = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    both = np.concatenate([codes * np.uint64(0xD6E8FEB86659FD93), pairs ^ (pairs >> np.uint64(29))])
    return ((both * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) ** window < 1 << 62:
        code = ids[:n].copy()
        for k in range(1, window):
            code = code * len(numbers) + ids[k : n + k]
    else:  # exact numbers of ever longer runs
        code = ids
        for k in range(1, window):
            code = np.unique(code[: len(ids) - k] * len(numbers) + ids[k:], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    if not again.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[window : window + n] -= again
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def dup_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(lines) - len(set(lines))


@dataclass(frozen=True)
class Model:
    """Counts of all buckets, and the trusted documents that are in the target."""

    raw: np.ndarray
    target: np.ndarray
    trusted: frozenset[int]

    def score(self, doc: int | None, text: str) -> float:
        """Mean log ratio of a document that has been counted; 0 for a text without n-grams."""
        at = buckets(text)
        if not len(at):
            return 0.0
        used, own = np.unique(at, return_counts=True)
        mine = 1 if doc in self.trusted else 0
        share = max(0.0, self.target.sum() - mine * len(at)) / max(1.0, self.raw.sum() - len(at))
        expected = np.maximum(self.raw[used] - own, 0) * share
        ratios = np.log((np.maximum(self.target[used] - mine * own, 0) + SHRINK) / (expected + SHRINK))
        return float((ratios * own).sum() / len(at))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_ROWS) -> frozenset[int]:
    """Ids of trusted rows, at most ``limit``."""
    rows = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    return frozenset(row["doc_id"] for row in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect())


def fit(docs: DataFrame, trusted: frozenset[int]) -> Model:
    """Count n-grams of all documents and of the trusted ones; the driver gets one sum a bucket."""
    chosen = docs.sparkSession.sparkContext.broadcast(trusted)  # bounded by TRUSTED_ROWS
    size = 1 << BUCKET_BITS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = buckets(text or "")
                np.add.at(counts[0], at, 1)
                if doc in chosen.value:
                    np.add.at(counts[1], at, 1)
        for kind in (0, 1):
            used = np.flatnonzero(counts[kind])
            yield pa.record_batch({
                "kind": pa.array(np.full(len(used), kind), pa.int32()), "bucket": pa.array(used, pa.int32()), "n": pa.array(counts[kind][used], pa.int64()),
            })

    counts = np.zeros((2, size))
    sums = map_rows(docs.select("doc_id", "text"), _COUNTED, work).groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[sums["kind"].to_numpy(), sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return Model(counts[0], counts[1], trusted)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Base counts and the ratio of every document, where the rows lie."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers a bucket, and the trusted ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, names = arrow_schema(_SCORED), arrow_schema(_SCORED).names
        model = shared.value
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                words = text.encode().split()
                llr = model.score(doc, text)
                spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
                row = (doc, len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), dup_lines(text), repeat_words(words), llr)
                for name, value in zip(names, row):
                    out[name].append(value)
            yield batch_of(schema, out)

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), _SCORED, work)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr, threshold``.

    A null text is an empty one: no words, failed. Null ids and repeated rows are judged like any others. Where there
    are no trusted rows, the base rules alone decide.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, trusted_ids(labels))
    limit = F.lit(threshold)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    return scored(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ((F.col("llr") >= limit) | F.lit(not model.trusted))).alias("kept"), "llr", limit.alias("threshold"),
    )
