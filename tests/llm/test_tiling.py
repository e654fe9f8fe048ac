"""Greedy string tiling against a plain version."""

from __future__ import annotations

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from skyledger.llm import tiling

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def plain_tiles(doc: list[str], item: list[str], seed: int) -> list[tuple[int, int, int]]:
    """The textbook algorithm: the longest unmarked common run, again and again; ties by place in document, then item."""
    marked_doc, marked_item, tiles = set(), set(), []
    while True:
        best = (seed - 1, 0, 0)
        for at in range(len(doc)):
            for place in range(len(item)):
                k = 0
                while (at + k < len(doc) and place + k < len(item) and doc[at + k] == item[place + k]
                       and at + k not in marked_doc and place + k not in marked_item):
                    k += 1
                if k > best[0]:
                    best = (k, at, place)
        if best[0] < seed:
            return sorted(tiles)
        k, at, place = best
        tiles.append((at, place, k))
        marked_doc.update(range(at, at + k))
        marked_item.update(range(place, place + k))


@pytest.mark.parametrize("seed", range(60))
def test_tiles(seed):
    rng = random.Random(seed)
    item = [rng.choice("abcde") for _ in range(rng.randint(0, 25))]
    doc = [rng.choice("abcdef") for _ in range(rng.randint(0, 30))]
    for _ in range(rng.randint(0, 3)):
        k = rng.randint(0, 20)
        doc[rng.randint(0, len(doc)) : 0] = item[k : k + rng.randint(1, 12)]
    found = tiling.search(" ".join(doc), tiling.Items.of([(7, " ".join(item))], 3), 3)
    assert sorted(found.get(0, [])) == plain_tiles(doc, item, 3)


@pytest.mark.parametrize("seed", range(40))
def test_tiles_without_a_list(seed, monkeypatch):
    monkeypatch.setattr(tiling, "PAIRS", 0)
    rng = random.Random(seed)
    item = [rng.choice("ab") for _ in range(rng.randint(0, 20))]
    doc = [rng.choice("abc") for _ in range(rng.randint(0, 40))] + item * rng.randint(0, 2)
    found = tiling.search(" ".join(doc), tiling.Items.of([(7, " ".join(item)), (8, " ".join(item[::-1]))], 3), 3)
    assert sorted(found.get(0, [])) == plain_tiles(doc, item, 3) and sorted(found.get(1, [])) == plain_tiles(doc, item[::-1], 3)


def test_repetitive_texts_need_little_room():
    items = tiling.Items.of([(1, "word " * 300), (2, "word other " * 150), (3, ITEM)])
    tracemalloc.start()
    found = tiling.search("word " * 200_000 + ITEM + " word other" * 100_000, items)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sum(length for _, _, length in found[k]) for k in range(3)] == [300, 300, 16] and len(found[0]) == 1
    assert most < 400 << 20


def _tables(spark):
    words = ITEM.split()
    moved = " ".join(words[8:] + ["xx"] + words[:8])
    texts = [
        (1, f"before {ITEM.upper()}, after"), (2, f"a {moved} b"), (3, " ".join(words[:5])), (4, " ".join(words[::2])), (5, None), (6, ""),
        (None, ITEM), (7, "filler words " * 20_000 + ITEM), (8, ITEM), (8, ITEM), (9, " ".join(f"{w} x" for w in words)),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({"tiles": F.lit(1), "item_ids": F.lit("i")})
    items = spark.createDataFrame([(11, ITEM), (12, "too short here"), (None, "nothing of this is anywhere at all in them"), (13, None)], "item_id bigint, text string")
    return docs, items


@pytest.mark.parametrize("block", [16_000_000, 50])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(tiling, "BLOCK_CHARS", block)
    docs, items = _tables(spark)
    rows = tiling.leaks(docs, items).collect()
    assert len(rows) == 11
    leaked = [r["doc_id"] for r in rows if r["contaminated"]]
    assert sorted(leaked, key=str) == [1, 2, 7, 8, 8, None]
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["item_ids"] == [11] and by[2]["coverage"] == 1.0 and by[2]["tiles"] == ["11:1:8:8", "11:10:0:8"]
    assert by[3]["partial_ids"] == [11] and by[3]["coverage"] == 5 / 16 and by[4]["tiles"] == [] and by[5]["coverage"] == 0.0
    kept = tiling.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 9]


def test_nothing_to_search(spark):
    docs, items = _tables(spark)
    assert tiling.leaks(docs, items.limit(0)).where("contaminated or size(tiles) > 0").count() == 0
    assert tiling.clean(docs, items.limit(0)).count() == 11
    assert tiling.leaks(docs.limit(0), items).count() == 0
