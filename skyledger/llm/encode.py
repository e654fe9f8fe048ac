"""Ids of texts by the public tokenizers, as little-endian bytes.

Two kinds of tokenizer files are sped up by remembering the ids of words; both give exactly what the library's
``encode`` gives for the whole text:

* a normaliser that lowers case and a splitter that drops white space: texts fall apart at white space;
* byte-level splitting with a leading space: texts fall apart before a single space that follows other text.

A word of common characters is cut by the splitter's own pattern and its pieces go to the library's model;
a word with any other character goes to the library's ``encode`` as it is. A text whose white space could tie
words together goes to ``encode`` whole. The memory of words and pieces is cleared when it is full, so it has a bound.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from operator import attrgetter

import numpy as np
from tokenizers import Tokenizer

KEPT = 1_000_000
_ID = attrgetter("id")
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ", "0-9²³¹¼-¾"
#: Characters that every step of the tokenizers treats one by one.
_UNCOMMON = re.compile("[^\t\n\r\x20-\x7e\xa0-įı-ſ]")
#: Separators that Python counts as white space and the tokenizers do not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_LONG_SPACE = re.compile(r"\s\s(?:\s|\Z)")
#: Texts without these have no punctuation but full stops and commas.
_OTHERS = re.compile(f"[^{_LETTERS}{_NUMBERS}\t\n\r .,]")
_RUNS = ("..", ".,", ",.", ",,")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Known(dict):
    """Ids of units; a unit that is met first is encoded and kept."""

    def __init__(self, encode: Callable[[str], bytes], lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, unit: str) -> bytes:
        found = self[unit] = self.encode(self.lead + unit)
        return found


class Encoder:
    """Texts to ids of ``width`` bytes each (2 or 4), without special tokens."""

    def __init__(self, path: str, width: int = 4):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype(f"<u{width}")
        if width == 2 and self.size > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit two bytes")
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        self.lowers = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        self.spaced = not spec.get("normalizer") and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        letters, numbers = _LETTERS, _NUMBERS
        short = "'s|'t|'re|'ve|'m|'ll|'d"
        if self.lowers:
            self.pattern = re.compile(f"{short}|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+")
        else:
            self.pattern = re.compile(
                f"{short}| ?[{letters}]+| ?[{numbers}]+| ?[^\\s{letters}{numbers}]+|\\s+(?!\\S)|\\s+"
            )
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.table = str.maketrans({chr(b): letter for b, letter in _byte_letters().items()})
        self.marks = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        self.letter = "I" if width == 4 else "H"
        # every unit but the first of a text begins with the space at which it was cut, where spaces count
        self.known = _Known(self._word, "" if self.lowers else " ")
        self.pieces: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """By the library alone."""
        return array(self.letter, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _model(self, piece: str) -> bytes:
        spelled = piece.translate(self.table) if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        return array(self.letter, map(_ID, self.model.tokenize(spelled))).tobytes()

    def _piece(self, piece: str) -> bytes:
        """A piece that is a unit by itself is remembered once for both."""
        if self.lowers:
            held, name = self.known, piece
        elif len(piece) > 1 and piece[0] == " " and piece[1] != " ":
            held, name = self.known, piece[1:]
        else:
            held, name = self.pieces, piece
        found = held.get(name)
        if found is None:
            found = held[name] = self._model(piece)
        return found

    def _word(self, word: str) -> bytes:
        if _UNCOMMON.search(word) or self.marks.search(word):
            return self.whole(word)
        pieces = self.pattern.findall(word.lower() if self.lowers else word)
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join([self._piece(piece) for piece in pieces])

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        if _SEPARATORS.search(text) or not self.lowers and (not self.spaced or _LONG_SPACE.search(text)):
            return self.whole(text)
        if len(self.known) >= KEPT:
            self.known.clear()
        if len(self.pieces) >= KEPT // 4:
            self.pieces.clear()
        known = self.known
        if not self.lowers:
            first, *units = text.split(" ")
            return self._word(first) + b"".join([known[unit] for unit in units])
        if not _OTHERS.search(text):  # the same ids by fewer different words
            text = text.lower()
            if not any(run in text for run in _RUNS):
                text = text.replace(".", " . ").replace(",", " , ")
        return b"".join([known[unit] for unit in text.split()])


@lru_cache(maxsize=4)
def encoder(path: str, width: int = 4) -> Encoder:
    """One encoder a Python worker; its memory of words serves all tasks of the worker."""
    return Encoder(path, width)
