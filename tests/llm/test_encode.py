"""Ids against the tokenizers library, and the entropy coder against itself."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import rans, token_files
from skyledger.llm.encode import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {path: (Encoder(path, 2), Tokenizer.from_file(path)) for path in (WORD, BYTE)}
ODD = "ab Z\n\t\r\x0b\x0c\x1c\x1f\x85\xa0  .,'sé ñßø1²½0ÀÉıİſŉμΣσς中文😀́"
PARTS = st.sampled_from([*ODD, "<|endoftext|>", "<|startoftext|>", "'ll", "   ", "\n\n", " \n", " 're", "don't", "Words", "and"])


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=400, deadline=None)
@given(parts=st.lists(PARTS, max_size=14))
def test_ids_are_the_library_s(path, parts):
    codec, library = ENCODERS[path]
    text = "".join(parts)
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.ids(text) == struct.pack(f"<{len(ids)}H", *ids)


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 2**32 - 1), n=st.sampled_from([0, 1, 2, 63, 64, 1000, 40_000]), spread=st.sampled_from([1, 3, 50_000]))
def test_blocks_come_back(seed, n, spread):
    ids = (np.random.default_rng(seed).zipf(1.3, n) % spread).astype(np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=spread))
    assert n == 0 or table.freq.sum() == 1 << table.scale
    assert np.array_equal(rans.decode(rans.encode(ids, table), table), ids)


def test_checkpoints_and_checksums():
    ids = (np.random.default_rng(1).zipf(1.2, 700_000) % 49_408).astype(np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=49_408))
    block = rans.encode(ids, table)
    assert len(block) < 2 * len(ids)
    lanes, marks = struct.unpack_from("<8I", block)[4:6]
    assert marks >= 1
    for mark in range(marks + 1):
        assert np.array_equal(rans.decode(block, table, mark), ids[mark * rans.CHECKPOINT * lanes :])
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(block[:-1] + bytes([block[-1] ^ 1]), table)
    with pytest.raises(ValueError, match="another table"):
        rans.decode(block, rans.Table.of(np.bincount(ids[:9], minlength=49_408)))
    with pytest.raises(ValueError, match="no frequency"):
        rans.encode(np.array([5, 6], np.uint16), rans.Table.of(np.bincount([5], minlength=10)))


ROWS = [(3, "It was a day."), (1, None), (2, ""), (None, "Ohne Nummer"), (3, "It was a day."), (9, "wörter " * 5000), (5, " \n ")]


def test_files_hold_all_documents(spark, folder):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumns({"start": F.lit(1), "part": F.lit(2)})
    token_files.write(docs, folder, WORD, end_id=1, block_ids=200)
    got = token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect()
    library, at, want = Tokenizer.from_file(WORD), 0, []
    for doc, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_no_documents(spark, folder):
    token_files.write(spark.createDataFrame([], "doc_id bigint, text string"), folder, WORD, end_id=1)
    assert token_files.read(spark, folder).count() == 0
