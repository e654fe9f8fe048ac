"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents become words (lower case, punctuation aside). Running Karp-Rabin fingerprints of
``SEED`` words of the items are the seeds; a document is searched for them in one pass. Where seeds are shared, they
are joined: neighbouring seeds on one diagonal make a maximal match, and the longest match that overlaps nothing
marked yet is marked as a tile, again and again; what an earlier tile has cut is matched anew by its remaining part.
Tiles of an item may lie anywhere in the document and in any order, so reordered passages are caught. An item leaks
into a document if its tiles cover at least ``COVERAGE`` of its words.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows, stored

SEED, COVERAGE = 5, 0.6
#: Items are told to all tasks in blocks of about so many characters, one block at a time; each block is searched in
#: all documents.
BLOCK_CHARS = 16_000_000
BASE = 0x9E3779B97F4A7C15
#: Pairs of places with a shared seed that are listed for a text and an item; beyond it the tiles are found without a list.
PAIRS = 100_000
_WORD = re.compile(r"\w+")
_FOUND = "doc_id bigint, text string, item_ids array<bigint>, covered array<int>, lengths array<int>, tiles array<string>"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def fingerprints(numbers: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin fingerprints of all runs of ``width`` numbers, modulo 2^64."""
    n = max(0, len(numbers) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(BASE) + numbers[k : n + k]
    return out


@dataclass(frozen=True)
class Items:
    """A block of items: numbers of their words, and their seeds in order of the fingerprint."""

    ids: list[int | None]
    bodies: list[np.ndarray]
    vocabulary: dict[str, int]
    seeds: np.ndarray
    owners: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int | None, str]], seed: int = SEED) -> "Items":
        vocabulary: dict[str, int] = {}
        bodies = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)], np.uint64) for _, text in rows]
        marks = [fingerprints(body, min(seed, max(1, len(body)))) if len(body) >= seed else np.zeros(0, np.uint64) for body in bodies]
        seeds = np.concatenate([np.zeros(0, np.uint64), *marks])
        owners = np.concatenate([np.zeros(0, np.int64), *[np.full(len(m), i, np.int64) for i, m in enumerate(marks)]])
        places = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(m)) for m in marks]])
        order = np.argsort(seeds, kind="stable")
        return Items([i for i, _ in rows], bodies, vocabulary, seeds[order], owners[order], places[order])


def tile(matches: list[tuple[int, int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiles of (document place, item place, length) matches: longest first, none shorter than ``seed``."""
    queue = [(-length, at, place) for at, place, length in matches]
    heapq.heapify(queue)
    doc_used: set[int] = set()
    item_used: set[int] = set()
    tiles = []
    while queue:
        length, at, place = heapq.heappop(queue)
        length = -length
        free = [at + k not in doc_used and place + k not in item_used for k in range(length)]
        if all(free):
            tiles.append((at, place, length))
            doc_used.update(range(at, at + length))
            item_used.update(range(place, place + length))
            continue
        start = None
        for k, ok in enumerate([*free, False]):
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= seed:
                    heapq.heappush(queue, (-(k - start), at + start, place + start))
                start = None
    return tiles


def long_tiles(numbers: np.ndarray, body: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """The same tiles without a list of matches, for texts that repeat themselves: the lengths of all common runs of free
    words, item word by item word, in room for two rows of the text; a pass for each tile."""
    doc_free, item_free = np.ones(len(numbers), bool), np.ones(len(body), bool)
    tiles = []
    while True:
        best = (-seed + 1, 0, 0)
        run = np.zeros(len(numbers), np.int32)
        for place in range(len(body)):
            same = (numbers == body[place]) & doc_free if item_free[place] else np.zeros(len(numbers), bool)
            run[1:] = run[:-1] + 1
            run[0] = 1
            run *= same
            end = int(np.argmax(run))
            length = int(run[end])
            best = min(best, (-length, end - length + 1, place - length + 1))
        length, at, place = -best[0], *best[1:]
        if length < seed:
            return tiles
        tiles.append((at, place, length))
        doc_free[at : at + length] = False
        item_free[place : place + length] = False


def search(text: str, items: Items, seed: int = SEED) -> dict[int, list[tuple[int, int, int]]]:
    """Tiles of every item that shares a seed with the text."""
    get = items.vocabulary.get
    words = words_of(text)
    numbers = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    if len(numbers) < seed or not len(items.seeds):
        return {}
    known = numbers > 0
    if int(np.count_nonzero(known)) < seed:
        return {}
    marks, where = np.unique(fingerprints(numbers, seed), return_inverse=True)
    left, right = np.searchsorted(items.seeds, marks, "left"), np.searchsorted(items.seeds, marks, "right")
    # each seed that the text has, once, however often it stands there
    size = right - left
    shared = np.repeat(left - np.cumsum(size) + size, size) + np.arange(size.sum())
    mark_of = np.repeat(np.arange(len(marks)), size)
    times = np.bincount(where, minlength=len(marks))
    order = np.argsort(where, kind="stable")
    begin = np.searchsorted(where[order], np.arange(len(marks) + 1))
    found = {}
    for item in np.unique(items.owners[shared]).tolist():
        own = items.owners[shared] == item
        body = items.bodies[item]
        if times[mark_of[own]].sum() > PAIRS:
            found[item] = long_tiles(numbers, body, seed)
            continue
        pairs: dict[tuple[int, int], None] = {}
        for place, mark in zip(items.places[shared[own]].tolist(), mark_of[own].tolist()):
            for at in order[begin[mark] : begin[mark + 1]].tolist():
                if np.array_equal(body[place : place + seed], numbers[at : at + seed]):
                    pairs[at, place] = None
        matches = []
        for at, place in pairs:
            if (at - 1, place - 1) in pairs:
                continue
            length = seed
            while (at + length - seed + 1, place + length - seed + 1) in pairs:
                length += 1
            matches.append((at, place, length))
        if matches:
            found[item] = tile(matches, seed)
    return found


def _blocks(benchmark: DataFrame, text: str, item_id: str) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of bounded size, streamed to the driver one partition at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("bigint"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1]) + 64
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _told(docs: DataFrame, benchmark: DataFrame, seed: int) -> Iterator[tuple[Broadcast, bool]]:
    """Blocks of items, each sent to all tasks, and whether it is the last."""
    blocks, context = _blocks(benchmark, "text", "item_id"), docs.sparkSession.sparkContext
    block = next(blocks, None)
    while block is not None:
        following = next(blocks, None)
        yield context.broadcast(Items.of(block, seed)), following is None
        block = following


def _searcher(shared: Broadcast, seed: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds what one block of items has to what earlier blocks had; texts go no further than the last block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, items = arrow_schema(_FOUND), shared.value
        for batch in batches:
            out = dict(zip(schema.names, (column.to_pylist() for column in batch.columns)))
            for n, body in enumerate(out["text"]):
                for item, tiles in search(body or "", items, seed).items():
                    out["item_ids"][n].append(items.ids[item])
                    out["covered"][n].append(sum(length for _, _, length in tiles))
                    out["lengths"][n].append(len(items.bodies[item]))
                    out["tiles"][n] += [f"{items.ids[item]}:{at}:{place}:{length}" for at, place, length in sorted(tiles)]
            if last:
                out["text"] = [None] * len(out["text"])
            yield batch_of(schema, out)

    return work


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", id_column: str = "doc_id", seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, contaminated, item_ids, coverage, partial_ids, tiles`` of every document.

    ``item_ids`` are the items that leak (ascending) and ``coverage`` the share of the words of the best covered item.
    ``tiles`` lists item:document place:item place:length of all tiles, ``partial_ids`` the items with tiles below the
    threshold. Null texts are empty and clean; null ids stay; repeated rows are searched each. Items with fewer than
    ``seed`` words cannot be told from chance and never match. Without items every document is clean.
    """
    empty = {"item_ids": "bigint", "covered": "int", "lengths": "int", "tiles": "string"}
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
        *[F.array().cast(f"array<{kind}>").alias(name) for name, kind in empty.items()],
    )

    for shared, last_block in _told(docs, benchmark, seed):
        rows = map_rows(rows, _FOUND, _searcher(shared, seed, last_block))
        if not last_block:
            rows = stored(rows, "tiles")
    share = F.transform(F.arrays_zip("item_ids", "covered", "lengths"), lambda s: F.struct(s["item_ids"].alias("item"), (s["covered"] / s["lengths"]).alias("share")))
    leaked = F.filter("_share", lambda s: s["share"] >= coverage)
    partial = F.filter("_share", lambda s: s["share"] < coverage)
    return rows.withColumn("_share", share).select(
        "doc_id", (F.size(leaked) > 0).alias("contaminated"), F.array_sort(F.transform(leaked, lambda s: s["item"])).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("_share", lambda s: s["share"])), F.lit(0.0)).alias("coverage"),
        F.array_sort(F.transform(partial, lambda s: s["item"])).alias("partial_ids"), "tiles",
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without documents into which an item leaks; all columns stay, decided row by row where the rows lie."""
    at, ddl = docs.columns.index(text), ", ".join(f"`{n}` {kind}" for n, kind in docs.dtypes)

    def cleaner(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def is_clean(body: str | None) -> bool:
            items = shared.value
            found = search(body or "", items, seed)
            return all(sum(length for _, _, length in tiles) < coverage * len(items.bodies[item]) for item, tiles in found.items())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([is_clean(body) for body in batch.column(at).to_pylist()], pa.bool_()))

        return work

    for shared, last in _told(docs, benchmark, seed):
        docs = map_rows(docs, ddl, cleaner(shared))
        if not last:
            docs = stored(docs, "clean")
    return docs
