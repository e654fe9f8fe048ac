"""Bounded-space online best-fit packing of documents into sequences.

A packer keeps at most ``open_bins`` unfinished sequences. A bitset has one bit for each amount of free space that some
open sequence offers; a piece goes to the open sequence with the least free space that still holds it, found by
shifting the bitset. Where none fits, a new sequence opens, and where that would be one too many the fullest closes
first. Every task packs the documents of its rows as they come, where they lie, so ids are not shuffled and a task holds
its open sequences only; it leaves the last of them unfilled. What comes out are the sequences with the ids in them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows
from skyledger.llm.encode import encoder

CAPACITY, OPEN_BINS = 1024, 64
#: For pieces that are put into order before they are packed, which needs all sequences open that they fill.
SORTED_BINS, PIECES_PER_TASK = 1 << 16, 100_000
#: Finished sequences that a task sends on at once.
BATCH = 2048
_PARTS = {"doc_ids": pa.int64(), "pieces": pa.int32(), "starts": pa.int64(), "lengths": pa.int64(), "offsets": pa.int64()}
_SEQUENCES = "sequence_id bigint, ids binary, doc_ids array<bigint>, pieces array<int>, starts array<bigint>, lengths array<bigint>, offsets array<bigint>"
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def _cuts(n: int, capacity: int) -> list[int]:
    """Where a document of ``n`` ids is cut: it is whole if it fits, else the first piece may be shorter than the others."""
    return [0, *range(n % capacity or capacity, n + 1, capacity)]


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Sequences of at most ``capacity`` ids: ``sequence_id, ids`` (unsigned 32-bit little-endian) and, for each piece in it,
    ``doc_ids, pieces, starts, lengths, offsets``.

    A null text is empty and gives the end id alone. Null ids and repeated rows are documents like any other; other columns
    are not read. No documents, no sequences.
    """
    schema = pa.schema([("sequence_id", pa.int64()), ("ids", pa.binary()), *[(name, pa.list_(kind)) for name, kind in _PARTS.items()]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, packer, first = encoder(tokenizer, 4), BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        held: dict[int, list[tuple]] = {}

        def finished(numbers: list[int]) -> pa.RecordBatch:
            parts = [held.pop(number) for number in numbers]
            columns = [[[part[k] for part in sequence] for sequence in parts] for k in range(len(_PARTS))]
            ids = [b"".join([part[-1] for part in sequence]) for sequence in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n for n in numbers], pa.int64()), pa.array(ids, pa.binary()), *[pa.array(c, pa.list_(k)) for c, k in zip(columns, _PARTS.values())]], schema=schema)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = codec.ids(body.as_py() or "") + end
                cuts = _cuts(len(ids) // 4, capacity)
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    number, offset = packer.place(stop - start)
                    held.setdefault(number, []).append((doc, piece, start, stop - start, offset, ids[4 * start : 4 * stop]))
                    if len(packer.closed) >= BATCH:
                        yield finished(packer.closed)
                        packer.closed = []
        yield finished(list(held))

    return map_rows(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), _SEQUENCES, work)


def places(packed: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, read out of the sequences."""
    parts = F.arrays_zip(*_PARTS)
    rows = packed.select("sequence_id", "ids", F.explode(parts).alias("p"))
    ids = F.substring("ids", (4 * F.col("p.offsets") + 1).cast("int"), (4 * F.col("p.lengths")).cast("int"))
    return rows.select(
        F.col("p.doc_ids").alias("doc_id"), F.col("p.pieces").alias("piece"), F.col("p.starts").alias("start"), F.col("p.lengths").alias("length"),
        F.crc32(ids).alias("ids_crc32"), "sequence_id", F.col("p.offsets").alias("offset"),
    )


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Ids of every document with its end id, whole if they fit a sequence, else in pieces of ``capacity`` of
    which the first may be shorter: ``doc_id, piece, start, length, ids`` (unsigned 32-bit little-endian)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = encoder(tokenizer, 4), arrow_schema(_PIECES)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            held = 0
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = codec.ids(body or "") + end
                n = len(ids) // 4
                cuts = _cuts(n, capacity)
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    for name, value in (("doc_id", doc), ("piece", piece), ("start", start), ("length", stop - start), ("ids", ids[4 * start : 4 * stop])):
                        out[name].append(value)
                held += len(ids)
                if held > 1 << 24:
                    yield batch_of(schema, out)
                    out, held = {name: [] for name in schema.names}, 0
            yield batch_of(schema, out)

    return map_rows(docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text")), _PIECES, work)


class BestFit:
    """Open sequences by free space; ``place`` gives a piece its sequence and the place there, and adds sequences that take no
    more to ``closed``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free_bits = 0
        self.by_free: dict[int, list[int]] = {}
        self.opened = self.unfinished = 0
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        held = self.by_free[free]
        number = held.pop()
        if not held:
            self.free_bits &= ~(1 << free)
        self.unfinished -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free_bits >> length << length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            if self.unfinished >= self.open_bins:
                self.closed.append(self._take((self.free_bits & -self.free_bits).bit_length() - 1))
            self.by_free.setdefault(left, []).append(number)
            self.free_bits |= 1 << left
            self.unfinished += 1
        else:
            self.closed.append(number)
        return number, self.capacity - free


def assign(
    cut: DataFrame, capacity: int = CAPACITY, open_bins: int = SORTED_BINS, pieces_per_task: int = PIECES_PER_TASK, tasks: int | None = None
) -> DataFrame:
    """The rows of ``cut`` (with ``doc_id``, ``piece`` and ``length``) and their ``sequence_id`` and ``offset``: for pieces that are
    there already and may be put into another order.

    They are dealt evenly by a hash, ``pieces_per_task`` to a packer, longest first, which fills sequences better than
    the order in which they come. Rows that are alike in all three are packed each for itself. Null document ids are ids like any other.
    """
    tasks = tasks or max(1, math.ceil(cut.count() / pieces_per_task))
    dealt = cut.repartition(tasks, "doc_id", "piece").sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    names, at = cut.columns, cut.columns.index("length")
    fields = ", ".join(f"`{n}` {kind}" for n, kind in cut.dtypes) + ", sequence_id bigint, offset bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.place(length) for length in batch.column(at).to_pylist()]
            packer.closed.clear()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + n for n, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    return map_rows(dealt, fields, work)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, of rows that carry ``ids``: at most ``capacity`` ids each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.length").alias("lengths"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
