"""Phrase counts and scores against plain counts of every phrase."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import collocations as C


def _pieces(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [words for piece in re.split("[.,;:!?\n\x0b\x0c\r]", small) if (words := re.findall("[^ \t]+", piece))]


def _counts(docs, order):
    f = defaultdict(Counter)
    for lang, text in docs:
        for words in _pieces(text):
            for k in range(1, order + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f


def _brute(docs, order=3, least=10, inside=50, top=2000):
    out = []
    for lang, f in _counts(docs, order).items():
        n = sum(v for phrase, v in f.items() if len(phrase) == 1)
        candidates = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= least}
        rows = []
        for phrase, a in candidates.items():
            if any(
                len(big) > len(phrase) and 100 * b >= inside * a and any(big[i : i + len(phrase)] == phrase for i in range(len(big) - len(phrase) + 1))
                for big, b in candidates.items()
            ):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase)))
            rows.append((-score, -a, " ".join(phrase).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abÉ .,\t\n\x0b\x00\x1c\u2003"), max_size=25), max_size=4), st.integers(2, 4))
def test_windows(texts, order):
    columns, counts = C.windows([t.encode().translate(C._PLAIN) for t in texts], order)
    found = Counter()
    for n, *words in zip(counts.tolist(), *[c.to_pylist() for c in columns]):
        found[tuple(w.decode() for w in words)] += n
    want = Counter(tuple((words[i : i + order] + [""] * order)[:order]) for t in texts for words in _pieces(t) for i in range(len(words)))
    assert found == want


def test_slices_end_with_pieces():
    body = b"one two.three four five.six." + b"x" * 50 + b" y" * 20 + b".end"
    parts = list(C._slices(body, 12))
    assert b"".join(parts) == body and all(p.endswith(b".") for p in parts[:-1]) and len(parts) > 3


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 3), st.integers(0, 3), st.integers(0, 3), st.integers(1, 4)), min_size=1, max_size=60), st.integers(1, 7))
def test_ended_rows_keep_the_sums_of_prefixes(rows, least):
    rows = sorted(((*r[:3], r[3] if r[2] else 0, r[4]) for r in rows), key=lambda r: (r[1:4], r[0]))
    table = np.array(rows, np.int64)
    found, n = C.ended([table[:, k] for k in range(4)], [4] * 4, table[:, 4], least)

    def sums(lines):
        out = Counter()
        for *words, count in lines:
            for k in range(1, 5):
                out[tuple(words[:k])] += count
        return {phrase: v for phrase, v in out.items() if len(phrase) == 1 or (v >= least and phrase[-1])}

    assert sums(zip(*[c.tolist() for c in found], n.tolist())) == sums(rows)


def _docs():
    base = "The old mill stands by the river, the old mill turns; cc by-nc 4 cc by-nc 4\nNew York\tCity! x"
    docs = [("en", base)] * 12 + [("en", f"the old mill {k} of the river. a b a b a b") for k in range(40)] + [("fr", "été là\x00été là " * 6), ("fr", "là " * 30)]
    return docs + [(None, "a b c d " * 11), ("de", None), ("de", ""), ("xx", ".,;"), ("en", "one " * 9), ("EN", "Das " * 25)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_all_phrases(spark, order, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 8)
    monkeypatch.setattr(C, "CHUNK", 300)
    docs = spark.createDataFrame([(k, *d) for k, d in enumerate(_docs())], "doc_id bigint, lang string, text string").repartition(3)
    found = C.collocations(docs.withColumns({"n": F.lit(1), "phrase": F.lit("x")}), order)
    assert sorted(tuple(r) for r in found.collect()) == _brute(_docs(), order)
    few = C.collocations(docs, order, least=4, inside=80, top=3)
    assert sorted(tuple(r) for r in few.collect()) == _brute(_docs(), order, 4, 80, 3)


def test_counts_of_phrases(spark):
    docs = spark.createDataFrame(_docs(), "lang string, text string")
    found = {(r["lang"], r["phrase"]): r["n"] for r in C.phrase_counts(docs, 3, 5).collect()}
    want = {}
    for lang, f in _counts(_docs(), 3).items():
        want |= {(lang, " ".join(p)): n for p, n in f.items() if n >= 5}
        want[(lang, "")] = sum(n for p, n in f.items() if len(p) == 1)
    assert found == want


def test_nothing_to_count(spark):
    docs = spark.createDataFrame(_docs(), "lang string, text string")
    assert C.collocations(docs.limit(0)).count() == 0 and C.collocations(docs.where("lang = 'de'")).count() == 0
    with pytest.raises(ValueError):
        C.collocations(docs, 1)


def test_products_beyond_64_bits(spark, monkeypatch):
    counts = spark.createDataFrame(
        [("en", 0, "", 10**13), ("en", 1, "a", 5 * 10**12), ("en", 1, "b", 4 * 10**12), ("en", 2, "a b", 3 * 10**12 + 1)], "lang string, words int, phrase string, n bigint")
    monkeypatch.setattr(C, "phrase_counts", lambda *_: counts)
    row = C.collocations(spark.createDataFrame([], "lang string, text string")).head()
    assert row["score"] == 1_000_000 * (3 * 10**12 + 1) ** 2 // (20 * 10**24)
