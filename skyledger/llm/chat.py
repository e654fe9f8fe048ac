"""Chat formatting on ids: segments are encoded by themselves and reserved ids spliced between them.

A turn is ``<s>`` role ``[INST]`` text ``[/INST]`` ``</s>``; the four marks are reserved ids above the vocabulary, so no
text can produce them. For readers of the written form, marks (and other known control strings) inside a role or a
text are escaped: a backslash goes behind their first character, and one more where backslashes already stand
there, which can be undone exactly. Places of turns in a conversation, and so the spans under the loss, are
running sums of segment lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm.common import arrow_schema, batch_of, map_rows

MARKS = ("<s>", "[INST]", "[/INST]", "</s>")
#: Control strings of known templates; the marks are among them.
CONTROL = (*MARKS, "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
LEARNED = ("assistant",)
_ESCAPABLE = re.compile("|".join(re.escape(c[0]) + r"(\\*)" + re.escape(c[1:]) for c in CONTROL))
_ESCAPED = re.compile("|".join(re.escape(c[0]) + r"\\(\\*)" + re.escape(c[1:]) for c in CONTROL))
_ENCODED = "conv_id bigint, turn bigint, role string, text string, role_ids array<int>, text_ids array<int>"
_TURNS = "conv_id bigint, position bigint, ids array<int>, start bigint, loss_start bigint, loss_stop bigint, chars bigint"
_READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_ids bigint, loss_ids bigint"


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Tokenizer, int]:
    """The tokenizer, with its own special strings taken as text, and the first reserved id."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer, tokenizer.get_vocab_size()


def assemble(turns: DataFrame, tokenizer: str, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row a turn: ``conv_id, position, ids, start, loss_start, loss_stop, chars``.

    ``ids`` is the whole turn with its marks, ``start`` its place in the conversation, ``loss_start`` to ``loss_stop`` the
    places whose ids are learned (none: equal) and ``chars`` the length of its written form. Turns are in the order of
    ``turn``, ties by role and text, null first. Null texts and roles are empty. Rows with a null ``conv_id`` form one
    conversation; repeated rows are separate turns. Segments are encoded where the rows lie; one shuffle brings a
    conversation together, and its rows stream through, so a long one needs no memory.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, _ = _tokenizer(tokenizer)
        schema = arrow_schema(_ENCODED)
        for batch in batches:
            conv, turn, roles, texts = (column.to_pylist() for column in batch.columns)
            roles, texts = [escape(r or "") for r in roles], [escape(t or "") for t in texts]
            yield batch_of(schema, {
                "conv_id": conv, "turn": turn, "role": roles, "text": texts,
                "role_ids": [e.ids for e in codec.encode_batch_fast(roles, add_special_tokens=False)],
                "text_ids": [e.ids for e in codec.encode_batch_fast(texts, add_special_tokens=False)],
            })

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, reserved = _tokenizer(tokenizer)
        begin, inner, outer, end = range(reserved, reserved + 4)
        marks = sum(map(len, MARKS))
        schema, here, position, place = arrow_schema(_TURNS), object(), 0, 0
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for row in batch.to_pylist():
                if row["conv_id"] != here:
                    here, position, place = row["conv_id"], 0, 0
                ids = [begin, *row["role_ids"], inner, *row["text_ids"], outer, end]
                first = place + 2 + len(row["role_ids"])
                last = first + len(row["text_ids"]) if row["role"] in learned else first
                for name, value in zip(schema.names, (here, position, ids, place, first, last, len(row["role"]) + len(row["text"]) + marks)):
                    out[name].append(value)
                position, place = position + 1, place + len(ids)
            yield batch_of(schema, out)

    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    together = map_rows(rows, _ENCODED, encode).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_rows(together, _TURNS, splice)


def read_back(assembled: DataFrame, tokenizer: str) -> DataFrame:
    """What each conversation says, from its ids and spans alone; rows must lie as ``assemble`` leaves them.

    ``n_turns, turns_sha256`` (of role, newline, text, newline a turn), ``loss_chars, loss_sha256`` (of the text under the
    loss), ``formatted_chars``, and the counts of ids and of learned ids. Digests grow turn by turn.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reserved = _tokenizer(tokenizer)
        schema, state = arrow_schema(_READ), None

        def row(s: dict) -> list:
            return [s["conv"], s["turns"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["ids"], s["loss_ids"]]

        for batch in batches:
            rows, parts = batch.to_pylist(), []
            for r in rows:
                inner, outer = r["ids"].index(reserved + 1), len(r["ids"]) - 2
                if r["ids"][0] != reserved or r["ids"][outer:] != [reserved + 2, reserved + 3]:
                    raise ValueError("a turn is not marked as it should be")
                learned = r["ids"][r["loss_start"] - r["start"] : r["loss_stop"] - r["start"]]
                parts += [r["ids"][1:inner], r["ids"][inner + 1 : outer], learned]
            said = codec.decode_batch(parts, skip_special_tokens=False)
            done = []
            for i, r in enumerate(rows):
                role, text, learned = said[3 * i : 3 * i + 3]
                if state is None or r["position"] == 0:
                    if state is not None:
                        done.append(row(state))
                    state = {"conv": r["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "ids": 0, "loss_ids": 0}
                state["turns"] += 1
                state["all"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                learned = unescape(learned)
                state["loss"].update(learned.encode())
                state["loss_chars"] += len(learned)
                state["chars"] += len(role) + len(text) + sum(map(len, MARKS))
                state["ids"] += len(r["ids"])
                state["loss_ids"] += r["loss_stop"] - r["loss_start"]
            yield batch_of(schema, dict(zip(schema.names, map(list, zip(*done)) if done else [[]] * len(schema))))
        if state is not None:
            yield batch_of(schema, dict(zip(schema.names, [[v] for v in row(state)])))

    return map_rows(assembled, _READ, work)
