"""Quality rules against plain counts, and the ratio on texts that differ."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import quality


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "\n", "  ", " x", "|", "#"]), max_size=60))
def test_base_counts(parts):
    text = " ".join(parts)
    words = re.findall("[^\x20\x09-\x0d]+", text)
    assert [w.decode() for w in text.encode().split()] == words
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)}
    assert quality.repeat_words(words) == len(covered)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            again += line in seen
            seen.add(line)
    assert quality.dup_lines(text) == again


def test_many_different_words():
    words = [str(k) for k in range(20_000)] + ["x"] + [str(k) for k in range(500, 600)]
    assert quality.repeat_words(words) == 200


def _docs(spark):
    good = [(i, f"the quiet river runs past house {i} and the old mill of the town every day") for i in range(60)]
    junk = [(100 + i, " ".join(f"w{i} | q{j} |" for j in range(12))) for i in range(30)]
    odd = [(200, None), (201, ""), (202, "short one"), (203, "a b c d e " * 4), (None, "the quiet river runs past house 7 and the old mill of the town every day")]
    docs = spark.createDataFrame(good + junk + odd + odd[-1:], "doc_id bigint, text string").withColumns({"kept": F.lit(1), "llr": F.lit("x")})
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(101, 0, 0), (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_verdicts(spark):
    docs, labels = _docs(spark)
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == 96
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert all(kept[i] for i in range(60)) and kept[None]
    assert not any(kept[100 + i] for i in range(30))
    failed = {r["doc_id"]: r["base_failed"] for r in rows}
    assert failed[200] and failed[201] and failed[202] and failed[203] and not failed[100] and not kept[203]
    row = next(r for r in rows if r["doc_id"] == 100)
    assert (row["n_words"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (48, 24, 0, 0)
    assert quality.judge(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_trusted_rows_have_a_bound(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert len(quality.trusted_ids(labels, 40)) == 40 and quality.trusted_ids(labels, 40) < quality.trusted_ids(labels, 41)
