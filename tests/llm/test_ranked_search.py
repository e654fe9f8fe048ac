"""Scores of an automaton scan against scores from plain counts."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, top=R.TOP):
    bags = [(doc, Counter(_terms(text))) for doc, text in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    out = []
    for item_id, text in items:
        found = []
        for doc, bag in bags:
            m = 100 - 25 + 25 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in _terms(text) if t in bag
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item_id, rank + 1, row[3], -row[0]) for rank, row in enumerate(sorted(found)[:top])]
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB9é\u00a0\u2003 .\t\n@[`{\x7f\x00ß日"), max_size=30))
def test_plain_text_has_the_terms(text):
    assert [t.encode("latin-1").decode() for t in R.plain(text).split(" ") if t] == _terms(text)
    assert R._n_terms(R.plain(text)) == len(_terms(text))


def test_matches_are_whole_terms():
    items = R.Items([(1, "the he e THE"), (2, ""), (3, None)])
    terms, tf = items.counts(R.plain("The he, the-THE there ee. e"))
    assert dict(zip((items.terms[t] for t in terms), tf.tolist())) == {"the": 3, "he": 1, "e": 1}


def _tables(spark):
    words = ["river", "mill", "The", "der", "été", "x9", "a"]
    docs = [(k, " ".join(words[(k * j + j) % 7] for j in range(1 + k % 23)) + "!") for k in range(160)]
    docs += [(None, "river mill"), (None, "river mill"), (200, None), (201, "... !"), (202, ""), (50, "été " * 400), (50, "river"), (49, "river"), (7, docs[7][1])]
    items = [(1, "River, river mill"), (2, "ÉTÉ été the"), (3, "nothing-there"), (4, None), (5, " "), (1, "x9"), (None, "a der"), (6, "the " * 30 + "a")]
    return docs, items


def test_against_plain_counts(spark, monkeypatch):
    docs, items = _tables(spark)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5).withColumns({"score": F.lit("x"), "rank": F.lit(1)})
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(3))

    def order(rows):
        return sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r))

    want = order(_brute(docs, items))
    assert order(tuple(r) for r in R.search(frame, bench).collect()) == want
    monkeypatch.setattr(R, "BLOCK_CHARS", 12)
    assert order(tuple(r) for r in R.search(frame, bench).collect()) == want
    assert order(tuple(r) for r in R.search(frame, bench, top=3).collect()) == order(_brute(docs, items, 3))


def test_empty_tables(spark):
    docs, items = _tables(spark)
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert R.search(frame.limit(0), bench).count() == 0 and R.search(frame, bench.limit(0)).count() == 0
    assert R.search(frame.where("doc_id > 200"), bench).count() == 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A session started from another folder, without the package on its path."""
    import os
    import subprocess
    import sys

    code = (
        "import importlib.util, sys; spec = importlib.util.spec_from_file_location('__spark_entry__', '/root/repo/__spark_entry__.py'.replace('/root/repo', sys.argv[1]))\n"
        "entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)\n"
        "from skyledger.session import build_session\n"
        "spark = build_session('elsewhere', 'local[2]', **{'spark.checkpoint.dir': 'file://' + sys.argv[2], 'spark.sql.shuffle.partitions': '2'})\n"
        "print('rows', entry.queries()['op12_automaton_search'](spark, '/root/testdata/sf0.001').count())\n"
    )
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code, repo, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    if "rows " not in done.stdout:
        pytest.fail(done.stderr[-2000:])
