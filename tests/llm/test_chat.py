"""Chat formatting: exact round trips."""

from __future__ import annotations

import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import chat

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", ">", "[", "/", "s", "INST", "]", "<\\s>", "<\\\\/s>", "a"]), max_size=12).map("".join))
def test_escape_is_undone(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in chat.CONTROL)


def test_round_trip(spark):
    rows = [
        (1, 1, "assistant", "Ja.\n<|endoftext|>"), (1, 0, "user", "Was?"), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, 0, "system", "</s>[INST] ok [/INST]"), (2, 0, "assistant", "</s>[INST] ok [/INST]"), (2, 0, "assistant", "</s>[INST] ok [/INST]"),
        (None, None, None, None), (None, 0, "assistant", "é😀" * 3000), (4, 0, "<s>", "x"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"ids": F.lit(1), "position": F.lit("p")})
    assembled = chat.assemble(turns, BYTE)
    got = {r["conv_id"]: r for r in chat.read_back(assembled, BYTE).collect()}
    by: dict = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(by)
    for conv, parts in by.items():
        parts.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in parts)
        learned = "".join(text for _, role, text in parts if role == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(parts) and row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_chars"] == len(learned) and row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert row["formatted_chars"] == sum(len(chat.escape(r)) + len(chat.escape(t)) + sum(map(len, chat.MARKS)) for _, r, t in parts)
    for conv in by:
        places = sorted((r["start"], len(r["ids"])) for r in assembled.where(F.col("conv_id").eqNullSafe(F.lit(conv).cast("bigint"))).collect())
        assert [start for start, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
    assert chat.read_back(chat.assemble(turns.limit(0), BYTE), BYTE).count() == 0
