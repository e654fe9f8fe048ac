"""Near duplicates against all pairs compared, and components against a plain search."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import order_minhash as om
from skyledger.llm.components import components


def plain_aligned(a: list[int], b: list[int]) -> int:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", range(40))
def test_alignment(seed):
    rng = random.Random(seed)
    words = [rng.choice("abcdefghij") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 60))]
    other = list(words)
    for _ in range(rng.randint(0, 3)):
        k = rng.randint(0, len(other))
        other[k : k + rng.randint(0, 2)] = [rng.choice("xyz")] * rng.randint(0, 2)
    if seed % 4 == 0:
        other = other[len(other) // 2 :] + other[: len(other) // 2]
    a, b = om.runs(om.word_codes(" ".join(words))), om.runs(om.word_codes(" ".join(other)))
    assert len(set(a.tolist())) == len(a)
    both = plain_aligned(a.tolist(), b.tolist())
    assert om.similar(a, b) == (both >= 0.8 * (len(a) + len(b) - both) - 1e-9)


def test_moved_halves_are_not_similar():
    words = [str(k) for k in range(200)]
    a, b = (om.runs(om.word_codes(" ".join(w))) for w in (words, words[100:] + words[:100]))
    assert len(np.intersect1d(a, b)) > 0.9 * len(a) and not om.similar(a, b)


def test_keys_follow_order():
    words = [str(k) for k in range(300)]
    a = om.keys(om.runs(om.word_codes(" ".join(words))))
    near = om.keys(om.runs(om.word_codes(" ".join(words[:150] + ["x"] + words[151:]))))
    moved = om.keys(om.runs(om.word_codes(" ".join(words[150:] + words[:150]))))
    assert len(a) == om.BANDS and (a == near).sum() > 15 and (a == moved).sum() < (a == near).sum()
    assert len(om.keys(om.runs(om.word_codes("a b c")))) == 1 and len(om.keys(om.runs(om.word_codes("")))) == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def _texts():
    rng = random.Random(11)
    rows, passage = [], " ".join(f"p{k}" for k in range(60))
    for n in range(40):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(3, 150))]
        rows.append((" ".join(words), n))
        for _ in range(rng.randint(0, 4)):  # copies with single words exchanged, in chains
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 9)}"
            rows.append((" ".join(words), n))
        if n % 3 == 0:
            rows.append((" ".join(words[:40]) + " " + passage, n))
    return [(k, text) for k, (text, _) in enumerate(rows)]


def test_classes_are_those_of_all_pairs(spark):
    rows = _texts() + [(900, None), (901, ""), (902, " \n"), (None, "null id text"), (903, "null id text"), (903, "null id text"), (904, "w " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"node": F.lit(1), "root": F.lit("r")})
    found = om.classes(docs)
    marks = {text or "": om.runs(om.word_codes(text or "")) for _, text in rows}
    group = {text: text for text in marks}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    links = 0
    for a, b in combinations(marks, 2):
        if len(marks[a]) and len(marks[b]) and om.similar(marks[a], marks[b]):
            links += 1
            group[find(a)] = find(b)
    classes: dict = {}
    for doc, text in rows:
        classes.setdefault(find(text or ""), []).append(doc)
    least = {find(text or ""): min((d for d in classes[find(text or "")] if d is not None), default=None) for _, text in rows}
    want = sorted((str(doc), str(least[find(text or "")])) for doc, text in rows)
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in found.collect()) == want
    assert links > 20
    kept = om.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(v) for v in least.values())
    assert om.classes(docs.limit(0)).count() == 0 and om.representatives(docs.limit(0)).count() == 0


def _true_classes(texts: list[str]) -> list[int]:
    """The least number in the class of each text, all pairs compared."""
    marks = [om.runs(om.word_codes(text)) for text in texts]
    _, tokens, held = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    column = np.cumsum(held > 1) - 1
    table, at = np.zeros((len(marks), column[-1] + 1), np.float32), 0
    for k, own in enumerate(marks):
        part = tokens[at : at + len(own)]
        table[k, column[part[held[part] > 1]]] = 1
        at += len(own)
    both, sizes = table @ table.T, np.array([len(own) for own in marks])
    group = np.arange(len(marks))
    for a, b in np.argwhere(np.triu(both >= 0.8 * (sizes[:, None] + sizes - both) - 1e-6, 1)).tolist():
        if group[a] != group[b] and om.similar(marks[a], marks[b]):
            group[group == max(group[a], group[b])] = min(group[a], group[b])
    return group.tolist()


def _classes(spark, texts: list[str]) -> list[int]:
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r["class_id"] for r in sorted(om.classes(docs).collect(), key=lambda r: r["doc_id"])]


def test_a_large_family_of_edited_copies(spark, monkeypatch):
    """Copies of one text with two or three edits each are similar only if the edits lie near each other."""
    monkeypatch.setattr(om, "BLOCK_NODES", 700, raising=False)  # several blocks a key
    rng = random.Random(4)
    base = [f"b{k}" for k in range(104)]
    texts = []
    for n in range(2000):
        words = list(base)
        for _ in range(2 + n % 2):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**9)}"
        texts.append(" ".join(words))
    want = _true_classes(texts)
    assert 100 < len(set(want)) < 1900
    found = _classes(spark, texts)
    assert len(set(found)) == len(set(want)) and found == want


def test_texts_that_share_most_of_their_words(spark):
    """All share a passage of 80 to 88 % of their words; pairs of them are similar in the rest too."""
    rng = random.Random(5)
    passage, texts = [f"p{k}" for k in range(240)], []
    for n in range(500):
        shared = rng.uniform(0.8, 0.88)
        own = [f"o{rng.randint(0, 10**9)}" for _ in range(round(240 * (1 - shared) / shared))]
        edited = list(own)
        for _ in range(rng.randint(1, 4)):
            edited[rng.randrange(len(own))] = f"e{rng.randint(0, 10**9)}"
        texts += [" ".join(passage + own), " ".join(passage + edited)]
    want = _true_classes(texts)
    assert 100 < len(set(want)) < 900
    found = _classes(spark, texts)
    assert len(set(found)) == len(set(want)) and found == want
