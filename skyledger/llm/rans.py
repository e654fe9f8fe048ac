"""Static range asymmetric numeral system for token ids.

One table of frequencies, scaled to 2^20 where the vocabulary allows, serves all blocks. A block is encoded by
itself: its ids are dealt in turn to lanes, each lane has a 64-bit state, and lanes share one stream of 32-bit
words. Every ``CHECKPOINT`` steps the states and the place in the stream are kept, so a reader can also begin
inside a block. A checksum covers all that follows it.

Block, little-endian: magic u32, checksum u32, table checksum u32, ids u32, lanes u32, checkpoints u32, words u32, scale u32;
then the states at step 0 and at each checkpoint (u64 a lane), the place in the stream of each checkpoint (u32),
and the words (u32).
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

MAGIC = 0x31534E52
LOW = np.uint64(1 << 31)
LANES, MIN_STEPS, CHECKPOINT = 2048, 64, 128
_HEAD = struct.Struct("<8I")


@dataclass(frozen=True)
class Table:
    """Frequencies of all ids, adding up to 2^scale; an id that never occurs has none."""

    freq: np.ndarray
    scale: int

    @staticmethod
    def of(counts: np.ndarray) -> "Table":
        used = np.flatnonzero(counts)
        scale = max(20, int(len(used)).bit_length() + 2)
        whole = 1 << scale
        freq = np.zeros(len(counts), np.int64)
        if len(used):
            share = counts[used].astype(np.float64) / float(counts[used].sum())
            freq[used] = 1 + np.floor(share * (whole - len(used))).astype(np.int64)
            freq[used[np.argmax(counts[used])]] += whole - int(freq.sum())
        return Table(freq, scale)

    @cached_property
    def freq64(self) -> np.ndarray:
        return self.freq.astype(np.uint64)

    @cached_property
    def begin64(self) -> np.ndarray:
        return (np.cumsum(self.freq) - self.freq).astype(np.uint64)

    @cached_property
    def owner(self) -> np.ndarray:
        """The id that owns each place of the scale."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)

    @cached_property
    def checksum(self) -> int:
        return zlib.crc32(self.freq.astype("<u4").tobytes())


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block of ids, all of which occur in the table."""
    n = len(ids)
    lanes = max(1, min(LANES, n // MIN_STEPS))
    steps = -(-n // lanes)
    freq, begin = table.freq64[ids], table.begin64[ids]
    if n and not freq.all():
        raise ValueError("an id has no frequency in the table")
    scale, roof = np.uint64(table.scale), np.uint64(63 - table.scale)
    states = np.full(lanes, LOW, np.uint64)
    written, count, marks = [], 0, []
    for step in range(steps - 1, -1, -1):
        f, b = freq[step * lanes : (step + 1) * lanes], begin[step * lanes : (step + 1) * lanes]
        x = states[: len(f)]
        full = x >= (f << roof)
        if full.any():
            words = x[full].astype(np.uint32)
            written.append(words)
            count += len(words)
            x = np.where(full, x >> np.uint64(32), x)
        part = x // f
        states[: len(f)] = (part << scale) + (x - part * f) + b
        if step and step % CHECKPOINT == 0:
            marks.append((states.copy(), count))
    marks = [(s, count - at) for s, at in reversed(marks)]
    body = b"".join(
        [states.astype("<u8").tobytes(), *[s.astype("<u8").tobytes() for s, _ in marks],
         np.array([at for _, at in marks], "<u4").tobytes(), *[w.astype("<u4").tobytes() for w in reversed(written)]]
    )
    rest = struct.pack("<6I", table.checksum, n, lanes, len(marks), count, table.scale) + body
    return struct.pack("<2I", MAGIC, zlib.crc32(rest)) + rest


def decode(block: bytes, table: Table, checkpoint: int = 0) -> np.ndarray:
    """The ids of a block from its start, or from its ``checkpoint``-th checkpoint."""
    magic, checksum, of_table, n, lanes, marks, count, scale = _HEAD.unpack_from(block)
    if magic != MAGIC or zlib.crc32(memoryview(block)[8:]) != checksum:
        raise ValueError("the block is damaged")
    if of_table != table.checksum or scale != table.scale:
        raise ValueError("the block belongs to another table")
    states = np.frombuffer(block, "<u8", lanes, _HEAD.size + 8 * lanes * checkpoint).astype(np.uint64)
    places = np.frombuffer(block, "<u4", marks, _HEAD.size + 8 * lanes * (marks + 1))
    words = np.frombuffer(block, "<u4", count, _HEAD.size + 8 * lanes * (marks + 1) + 4 * marks).astype(np.uint64)
    at = int(places[checkpoint - 1]) if checkpoint else 0
    first = checkpoint * CHECKPOINT * lanes
    out = np.empty(n - first, np.uint32)
    freq, begin, owner = table.freq64, table.begin64, table.owner
    bits, mask = np.uint64(scale), np.uint64((1 << scale) - 1)
    for start in range(first, n, lanes):
        x = states[: min(lanes, n - start)]
        slot = x & mask
        ids = owner[slot]
        x = freq[ids] * (x >> bits) + slot - begin[ids]
        low = x < LOW
        need = int(np.count_nonzero(low))
        if need:
            x[low] = (x[low] << np.uint64(32)) | words[at : at + need]
            at += need
        states[: len(x)] = x
        out[start - first : start - first + len(x)] = ids
    if at != count or (n and not (states == LOW).all()):
        raise ValueError("the block does not end as it was begun")
    return out
