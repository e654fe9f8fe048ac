"""Ranked lexical search of few items in many documents, without an index of the documents.

The terms of the items make an automaton (Aho-Corasick) over plain text: every run of characters that belong to no term is
one guard, and every term stands between two guards, so a match is a whole term. One scan counts the documents and terms
of the corpus and the documents of each term, a second one counts the occurrences in each document and scores it; the
outputs of the automaton are numbers of terms, and lists of items hang at the terms. A task keeps the best documents of
each item only, and they meet in two steps.

What goes to the tasks is bounded: items come in blocks of at most ``BLOCK_CHARS`` characters, one block after the other.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import map_rows, stored

TOP, BLOCK_CHARS, SALTS = 20, 4_000_000, 32
_GUARD = " "
#: Bytes of plain text: A-Z become small, bytes below 128 that are no letter or digit become guards.
_PLAIN = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32 for code in range(256)
)
_HITS = "block int, item int, item_id bigint, doc_id bigint, score bigint"


def plain(text: str | None) -> str:
    """The terms of a text between single guards, one character for each byte; empty if there is none."""
    terms = (text or "").encode().translate(_PLAIN).split()
    return f" {b' '.join(terms).decode('latin-1')} " if terms else ""


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of items: their terms, and for each term the items that have it and how often."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [item_id for item_id, _ in rows]
        numbers: dict[str, int] = {}
        pairs = [(numbers.setdefault(term, len(numbers)), item) for item, (_, text) in enumerate(rows) for term in plain(text).split()]
        self.terms = list(numbers)
        found, self.times = np.unique(np.array(pairs, np.int64).reshape(-1, 2), axis=0, return_counts=True)
        self.items = found[:, 1]
        self.begin = np.searchsorted(found[:, 0], np.arange(len(self.terms) + 1))

    def __getstate__(self) -> dict:
        return {key: value for key, value in self.__dict__.items() if key != "automaton"}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Built once in each worker."""
        made = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            made.add_word(_GUARD + term + _GUARD, number)
        made.make_automaton()
        return made

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms of the items in a plain text and their occurrences."""
        if not self.terms or not text:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.unique(np.fromiter((number for _, number in self.automaton.iter(text)), np.int64), return_counts=True)

    def scores(self, terms: np.ndarray, tf: np.ndarray, m: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items with a score above 0 in a document, and the scores."""
        part = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
        size = self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(self.begin[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        found, place = np.unique(self.items[at], return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, np.repeat(part, size) * self.times[at])
        return found[total > 0], total[total > 0]


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of bounded size, through the driver one after the other."""
    rows: list[tuple] = []
    size = 0
    for item_id, text in benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).toLocalIterator():
        rows.append((item_id, text))
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield Items(rows)
            rows, size = [], 0
    if rows:
        yield Items(rows)


def _n_terms(text: str) -> int:
    return text.count(_GUARD) - 1 if text else 0


def _sums(docs: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the documents of each term of the items."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_CHARS characters

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        df, n_docs, n_terms = np.zeros(len(items.terms), np.int64), 0, 0
        for batch in batches:
            for body in batch.column(1):
                text = plain(body.as_py())
                n_docs += bool(text)
                n_terms += _n_terms(text)
                df[items.counts(text)[0]] += 1
        used = np.flatnonzero(df)
        numbers = np.concatenate([[-2, -1], used]).astype(np.int64)
        yield pa.record_batch({"number": pa.array(numbers), "n": pa.array(np.concatenate([[n_docs, n_terms], df[used]]).astype(np.int64))})

    # one sum a term of the block comes to the driver
    sums = map_rows(docs, "number bigint, n bigint", work).groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(sums["number"].to_pylist(), sums["n"].to_pylist()))
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(number, 0) for number in range(len(items.terms))], np.int64)


def _best(docs: DataFrame, items: Items, block: int, top: int) -> DataFrame:
    """The best documents of each task for each item of a block."""
    n_docs, all_terms, df = _sums(docs, items)
    weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((items, weights))  # at most BLOCK_CHARS characters

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        heaps: dict[int, list[tuple]] = {}
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = plain(body.as_py())
                terms, tf = items.counts(text)
                if not len(terms):
                    continue
                m = 75 + 25 * _n_terms(text) * n_docs // all_terms
                for item, score in zip(*(column.tolist() for column in items.scores(terms, tf, m, weights))):
                    # of two documents the one with the smaller id is better; one without an id is last
                    entry = (score, doc is not None, -doc if doc is not None else 0)
                    heap = heaps.setdefault(item, [])
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
        rows = [(item, score, -doc if known else None) for item, heap in heaps.items() for score, known, doc in heap]
        yield pa.record_batch({
            "block": pa.array([block] * len(rows), pa.int32()), "item": pa.array([row[0] for row in rows], pa.int32()),
            "item_id": pa.array([items.ids[row[0]] for row in rows], pa.int64()),
            "doc_id": pa.array([row[2] for row in rows], pa.int64()), "score": pa.array([row[1] for row in rows], pa.int64()),
        })

    return map_rows(docs, _HITS, work)


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest scores above 0 of each item.

    A null text has no terms, and an item without terms or matches no rows. Every row of ``docs`` is a document and every
    row of ``benchmark`` an item: rows that repeat are ranked each. Equal scores stand by ascending ``doc_id``, null last.
    Other columns are not read; empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for number, items in enumerate(_blocks(benchmark)):
        hits = stored(_best(docs, items, number, top), "hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame([], T.StructType.fromDDL(_HITS))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("block", "item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    some_best = found.withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= top)
    every = Window.partitionBy("block", "item").orderBy(*order)
    best = some_best.withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= top)
    return best.select("item_id", "rank", "doc_id", "score")
