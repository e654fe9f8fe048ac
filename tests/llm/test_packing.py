"""Packing and sharding against what must hold of them."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import packing, shards

BYTE = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(3, "It was a day."), (1, None), (2, ""), (None, "Ohne Nummer"), (3, "It was a day."), (9, "wörter " * 5000), (5, " \n "), (9, "w")]


@settings(max_examples=80, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=200), open_bins=st.integers(1, 9))
def test_best_fit(lengths, open_bins):
    packer, bins = packing.BestFit(64, open_bins), defaultdict(int)
    unfinished: dict[int, int] = {}
    for length in lengths:
        fitting = [free for free in unfinished.values() if free >= length]
        number, offset = packer.place(length)
        assert offset == bins[number]
        if fitting:
            assert unfinished.pop(number) == min(fitting)
        else:
            assert offset == 0
        bins[number] += length
        assert bins[number] <= 64
        if bins[number] < 64:
            if len(unfinished) >= open_bins:
                fullest = min(unfinished.values())
                closed = [n for n, free in unfinished.items() if free == fullest]
                held = {n for free, ns in packer.by_free.items() for n in ns}
                gone = [n for n in closed if n not in held]
                assert len(gone) == 1
                del unfinished[gone[0]]
            unfinished[number] = 64 - bins[number]
        assert packer.unfinished == len(unfinished)


def test_pieces_and_places(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("piece", F.lit("x"))
    cut = packing.pieces(docs, BYTE, end_id=2)
    packed = packing.assign(cut, open_bins=4)
    rows = packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("c"), "sequence_id", "offset").collect()
    library, want = Tokenizer.from_file(BYTE), []
    for doc, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if start == 0 else start + 1024]
            want.append((doc, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert max(at.values()) <= 1024
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in rows)
    assert packing.assign(packing.pieces(docs.limit(0), BYTE, end_id=2)).count() == 0


def test_sequences_of_documents(spark):
    """Sequences against ids of the library, and places read out of them."""
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "offset": F.lit(1)})
    packed = packing.pack(docs.repartition(2), BYTE, end_id=2, capacity=32, open_bins=3)
    library, want = Tokenizer.from_file(BYTE), []
    for doc, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 32 or 32, len(ids) + 1, 32)]
        want += [(doc, n, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    rows = packing.places(packed).collect()
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    whole = {r["sequence_id"]: len(r["ids"]) // 4 for r in packed.collect()}
    assert whole == dict(at) and max(at.values()) <= 32
    assert packing.pack(docs.limit(0), BYTE, end_id=2).count() == 0


def test_open_sequences_are_few(spark, monkeypatch):
    """The bound binds: the packer of a task never holds more, and what it closes is what it sends on."""
    monkeypatch.setattr(packing, "BATCH", 5)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a b "), (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).cast("int")).alias("text")).repartition(1)
    counts = {}
    for bins in (1, 8, 64):
        packed = packing.pack(docs, BYTE, end_id=2, capacity=256, open_bins=bins)
        places = packing.places(packed)
        assert places.agg(F.count("*"), F.count_distinct("doc_id")).head()[1] == 3000
        counts[bins] = packed.count()
    least = -(-places.agg(F.sum("length")).head()[0] // 256)
    assert least <= counts[64] <= counts[8] <= counts[1] and counts[64] <= 1.03 * least + 1


def test_packs_nearly_full(spark):
    lengths = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), (1 + F.pmod(F.xxhash64("id"), F.lit(900))).cast("bigint").alias("length"))
    packed = packing.assign(lengths, tasks=2)
    total = packed.agg(F.sum("length")).head()[0]
    assert packed.select("sequence_id").distinct().count() <= 1.01 * total / 1024 + 2


def _sharded(docs, n=24):
    return shards.shard(docs, n).toPandas()


def _whole(found, n):
    assert (found.groupby("shard").slot.apply(lambda s: sorted(s) == list(range(len(s))))).all()
    assert found["shard"].between(0, n - 1).all() and (found.law == "bytes").all()


def test_shards_weigh_the_same(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("ü"), F.pmod(F.xxhash64("id"), F.lit(400)).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, "src0").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.lit("en").alias("lang"),
    )
    # a third of the rows are copies of one text, another has many ids alike
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, "copy " * 30).otherwise(F.col("text")))
    found = _sharded(docs)
    _whole(found, 24)
    sizes = found.groupby("shard")["size"].sum()
    assert len(found) == 6000 and len(sizes) == 24
    assert sizes.max() < 1.04 * sizes.mean() and sizes.min() > 0.96 * sizes.mean()
    copies = found[found["size"] == 158].shard.nunique()
    assert copies <= 12  # pieces of a group lie together


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "x" * 100_000, None, "b"), (3, "é", "de", None)],
        "doc_id bigint, text string, lang string, source string",
    ).withColumns({"size": F.lit(0), "shard": F.lit("s"), "slot": F.lit(1)})
    found = _sharded(docs, 3)
    _whole(found, 3)
    assert sorted(found["size"]) == [8, 8, 8, 10, 100_008]
    assert sorted(found.text_crc32)[:3] == [0, 0, 0] and zlib.crc32("é".encode()) in set(found.text_crc32)
    assert found.grown_shard.isna().all()
    assert len(_sharded(docs.limit(0), 3)) == 0
