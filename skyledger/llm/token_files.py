"""Documents as files of entropy-coded token ids, in ascending order of their id.

Texts are dealt by ranges of the document id and sorted, tokenized once into blocks of whole documents, and kept
as plain ids in the shared folder. The counts of all ids make one frequency table; blocks are then encoded one by
one (``rans``). The files are Parquet as a container, one folder ``part=n`` for each range in ascending order, one row
a block: its place, the ids and lengths of its documents, and the coded bytes with checkpoints and checksums. Blocks
need nothing but the table beside them, so they are decoded in parallel in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm import rans
from skyledger.llm.common import arrow_schema, batch_of, map_rows, stored
from skyledger.llm.encode import encoder

BLOCK_IDS = 1 << 19
_PLAIN = "part int, block bigint, before bigint, doc_id array<bigint>, length array<bigint>, ids binary, counts binary"
_CODED = "part int, block bigint, before bigint, doc_id array<bigint>, length array<bigint>, coded binary"
_READ = "part int, doc_id bigint, start bigint, n_tokens bigint, ids binary"


def blocks(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", id_column: str = "doc_id", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Plain ids in blocks of whole documents, two bytes each, in ascending document order; and one row a part with
    ``counts``, how often each id occurs in it, in place of a block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer, 2)
        end = np.array([end_id], codec.dtype).tobytes()
        schema, part = arrow_schema(_PLAIN), TaskContext.get().partitionId()
        number, before, held = 0, 0, []
        counts = np.zeros(codec.size, np.int64)

        def block(held: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
            sizes, ids = [len(ids) // codec.dtype.itemsize for _, ids in held], b"".join([ids for _, ids in held])
            np.add(counts, np.bincount(np.frombuffer(ids, codec.dtype), minlength=codec.size), out=counts)
            return batch_of(schema, {
                "part": [part], "block": [number], "before": [before], "doc_id": [[doc for doc, _ in held]],
                "length": [sizes], "ids": [ids], "counts": [None],
            })

        size = 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = codec.ids(body.as_py() or "") + end
                held.append((doc, ids))
                size += len(ids) // codec.dtype.itemsize
                if size >= block_ids:
                    yield block(held)
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield block(held)
        if counts.any():
            yield batch_of(schema, {name: [None] for name in schema.names} | {"part": [part], "counts": [counts.astype("<i8").tobytes()]})

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # equal ids, if there are any, still have one order and may go to several ranges
    sorted_rows = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return map_rows(sorted_rows.select("doc_id", "text"), _PLAIN, work)


def id_counts(plain: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs: one sum a task and id, then at most ``size`` rows to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in batch.column(0):
                counts += np.frombuffer(part.as_buffer(), "<i8")
        used = np.flatnonzero(counts)
        yield pa.record_batch({"id": pa.array(used, pa.int64()), "n": pa.array(counts[used], pa.int64())})

    counts = np.zeros(size, np.int64)
    for row in map_rows(plain.where("counts is not null").select("counts"), "id bigint, n bigint", work).groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", id_column: str = "doc_id", block_ids: int = BLOCK_IDS) -> None:
    """Encode every document into files below ``folder``: ``table`` and ``blocks``.

    A null text is an empty one; each document, also an empty one, ends with ``end_id``. Null ids come first. Repeated
    rows are separate documents. An empty table gives an empty table of frequencies and no blocks.
    """
    spark = docs.sparkSession
    plain = stored(blocks(docs, tokenizer, end_id, text, id_column, block_ids), "plain-ids")
    counts = id_counts(plain, encoder(tokenizer, 2).size)
    table = rans.Table.of(counts)
    used = np.flatnonzero(counts).tolist()
    spark.createDataFrame(
        [(i, int(table.freq[i]), table.scale, len(counts)) for i in used] or [(-1, 0, table.scale, len(counts))],
        "id int, freq bigint, scale int, size int",
    ).coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(table)  # bounded by the vocabulary

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_CODED)
        for batch in batches:
            for row in batch.to_pylist():
                ids = row.pop("ids")
                yield batch_of(schema, {k: [v] for k, v in row.items()} | {"coded": [rans.encode(np.frombuffer(ids, "<u2"), shared.value)]})

    map_rows(plain.where("counts is null").drop("counts"), _CODED, work).write.partitionBy("part").option("compression", "none").parquet(f"{folder}/blocks")


def read_table(spark: SparkSession, folder: str) -> rans.Table:
    rows = spark.read.parquet(f"{folder}/table").collect()  # bounded by the vocabulary
    freq = np.zeros(rows[0]["size"], np.int64)
    for row in rows:
        if row["id"] >= 0:
            freq[row["id"]] = row["freq"]
    return rans.Table(freq, rows[0]["scale"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every document decoded from the files: ``doc_id, start, n_tokens, ids`` with ids as unsigned 32-bit little-endian
    numbers; ``start`` counts the ids of all documents before. Each block is checked before it is used."""
    shared = spark.sparkContext.broadcast(read_table(spark, folder))
    held = spark.read.schema(_CODED).parquet(f"{folder}/blocks")
    # one row a part: the ranges are dealt by the number of shuffle partitions
    parts = held.groupBy("part").agg(F.sum(F.aggregate("length", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("bigint").alias("offset"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_READ)
        for batch in batches:
            for row in batch.to_pylist():
                ids = rans.decode(row["coded"], shared.value).astype("<u4").tobytes()
                out: dict[str, list] = {name: [] for name in schema.names}
                start = 0
                for doc, length in zip(row["doc_id"], row["length"]):
                    for name, value in (("part", row["part"]), ("doc_id", doc), ("start", row["before"] + start), ("n_tokens", length),
                                        ("ids", ids[4 * start : 4 * (start + length)])):
                        out[name].append(value)
                    start += length
                yield batch_of(schema, out)

    decoded = map_rows(held.select("part", "block", "before", "doc_id", "length", "coded"), _READ, work)
    return decoded.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )
