"""Near duplicates by Order MinHash.

A document is the sequence of its runs of five words, each labelled with how often it occurred before. For each of
``BANDS`` hash functions the ``SAMPLE`` runs with the smallest hashes are taken and kept in the order of the text; their
digest is the document's key in that band. Two documents share a key if they share the sampled runs in the same
order, so keys follow edit similarity, not just common content.

Equal texts are one node. Of the nodes with one key in a band the least leads: it is candidate with every other, so
candidates grow with the rows and not with their pairs. Candidates are verified by an alignment: the longest chain of
common labelled runs that keeps the order of both, inside the band that the similarity allows. Verified links make
classes. A key that still holds different classes is then settled whole: all members are kept, and every pair of different
classes that can be similar by its sizes and its rare runs (a similar pair shares one of the rarest runs of either) is
verified, so that no key holds two similar texts of different classes. Large keys are cut into blocks, each
pair of which is the work of one task.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows, stored
from skyledger.llm.components import components

WIDTH, SIMILARITY, BANDS, SAMPLE = 5, 0.8, 24, 3
#: Texts and runs of a block of a large key.
BLOCK_NODES, BLOCK_RUNS = 2048, 1 << 20
FILTER_BITS = 1 << 24
_KEYS = "key bigint, node binary"
_WORDS = "node binary, words binary"
_PAIRS = "a binary, b binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD)


def word_codes(text: str) -> np.ndarray:
    """Checksums of the words, lower case."""
    words = text.lower().encode().split()
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def runs(codes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Labelled runs in the order of the text; a text shorter than a run is one run."""
    if not len(codes):
        return np.zeros(0, np.uint64)
    width = min(width, len(codes))
    n = len(codes) - width + 1
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = found * _ODD + codes[k : n + k] + np.uint64(1)
    found = _mixed(found)
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]])
    if same.any():
        place = np.arange(n)
        begin = np.maximum.accumulate(np.where(same, 0, place))
        labels = np.zeros(n, np.uint64)
        labels[order] = (place - begin).astype(np.uint64)
        found = _mixed(found + labels * np.uint64(0xD6E8FEB86659FD93))
    return found


def keys(marks: np.ndarray, bands: int = BANDS, sample: int = SAMPLE) -> np.ndarray:
    """One key a band; texts with no more runs than a sample have one key in all."""
    if not len(marks):
        return np.zeros(0, np.int64)
    if len(marks) <= sample:
        chosen = marks[None, :]
        seeds = np.zeros(1, np.uint64)
    else:
        hashed = _mixed(marks[None, :] ^ _SEEDS[:bands, None])
        places = np.sort(np.argpartition(hashed, sample - 1, axis=1)[:, :sample], axis=1)
        chosen, seeds = marks[places], _SEEDS[:bands]
    digest = seeds.copy()
    for k in range(chosen.shape[1]):
        digest = _mixed(digest * _ODD + chosen[:, k])
    return digest.view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> int:
    """Length of the longest chain of common labelled runs in the order of both, within the band that ``similarity`` allows.

    A pair as similar as that leaves at most (1 - s) / (1 + s) of all runs unmatched, and so no match can lie further
    from the diagonal.
    """
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at_a - at_b) <= (len(a) + len(b)) * (1 - similarity) / (1 + similarity) + 1e-9
    at_a, at_b = at_a[near], at_b[near]
    places = at_b[np.argsort(at_a)]
    if len(places) < 2 or (np.diff(places) > 0).all():
        return len(places)
    ends: list[int] = []
    for place in places.tolist():
        k = bisect_left(ends, place)
        if k == len(ends):
            ends.append(place)
        else:
            ends[k] = place
    return len(ends)


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether aligned runs are at least ``similarity`` of all runs of both."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    if not len(a):
        return True
    both = aligned(a, b, similarity)
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def _nodes(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.unhex(F.md5(body.cast("binary"))).alias("node"), body.alias("text"))


def band_keys(docs: DataFrame, text: str = "text") -> DataFrame:
    """``key, node`` for every distinct text that a task meets and each band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_KEYS)
        done: set[bytes] = set()
        for batch in batches:
            found, nodes = [np.zeros(0, np.int64)], []
            for node, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node in done:
                    continue
                done.add(node)
                own = keys(runs(word_codes(body)))
                found.append(own)
                nodes += [node] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64()), pa.array(nodes, pa.binary())], schema=schema)

    return map_rows(_nodes(docs, text), _KEYS, work)


def _filter(nodes: DataFrame) -> bytes:
    """A filter of fixed size (2 MB) that lets every one of ``nodes`` through."""
    place = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS))
    rows = nodes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    ).collect()
    part = 1 << 12
    bits = bytearray(FILTER_BITS // 8 + part)
    for row in rows:
        at = (row["b"] - 1) * part if row["b"] else FILTER_BITS // 8  # place 0 has a bucket of its own
        bits[at : at + part] = row["bits"]
    return bytes(bits)


def words_for(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """``node, words`` of all nodes in ``pairs`` (and of a few more); other texts are not moved."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(_filter(nodes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_WORDS)
        bits = np.frombuffer(shared.value, np.uint8)
        done: set[bytes] = set()
        for batch in batches:
            place = batch.column(2).to_numpy()
            place = np.where(place == 0, FILTER_BITS, place - 1)
            passes = np.flatnonzero(bits[place >> 3] >> (place & 7) & 1)
            out: dict[str, list] = {"node": [], "words": []}
            for k in passes.tolist():
                node = batch.column(0)[k].as_py()
                if node not in done:
                    done.add(node)
                    out["node"].append(node)
                    out["words"].append(word_codes(batch.column(1)[k].as_py()).tobytes())
            yield batch_of(schema, out)

    rows = _nodes(docs, text).withColumn("place", F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)))
    return map_rows(rows, _WORDS, work)


def verified(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` whose texts are similar."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_PAIRS)
        held: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in batches:
            out: dict[str, list] = {"a": [], "b": []}
            for a, b, left, right in zip(*(column.to_pylist() for column in batch.columns)):
                if held[0] != a:
                    held = a, runs(np.frombuffer(left, np.uint32))
                if similar(held[1], runs(np.frombuffer(right, np.uint32)), similarity):
                    out["a"].append(a)
                    out["b"].append(b)
            yield batch_of(schema, out)

    left = words.select(F.col("node").alias("a"), F.col("words").alias("left"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("right"))
    return map_rows(pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right"), _PAIRS, work)


def pairs_within(marks: list[np.ndarray], roots: list[bytes], sides: np.ndarray, similarity: float = SIMILARITY) -> Iterator[tuple[int, int]]:
    """Similar pairs that join different classes, until no two similar texts are of different classes.

    ``sides`` has a bit for each set that a text belongs to; only pairs of bit 1 with bit 2 are wanted. A similar pair has at least
    s / (1 + s) of the runs of both in common, so it shares one of the first n - sn + 1 runs of each in any common
    order. The order is rare runs first, which leaves few pairs to count.
    """
    sizes = np.array([len(m) for m in marks])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, tokens, held = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    rank = np.empty(len(held), np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(len(held))
    tokens = rank[tokens]
    common = np.sort(held) > 1
    owners = np.repeat(np.arange(len(marks)), sizes)
    order = np.lexsort((tokens, owners))
    place = np.arange(len(tokens)) - np.repeat(starts, sizes)
    prefix = sizes - np.ceil(similarity * sizes - 1e-6).astype(np.int64) + 1
    leading = order[(place < prefix[owners]) & common[tokens[order]]]
    heads, at = tokens[leading], owners[leading]  # by text, rare runs first
    begins = np.searchsorted(at, np.arange(len(marks) + 1))
    by_token = np.argsort(heads, kind="stable")  # texts ascend within a run
    listed, first = at[by_token], np.searchsorted(heads[by_token], np.arange(len(held) + 1))
    # classes by number; the lists follow what is joined here
    numbers = {root: n for n, root in enumerate(dict.fromkeys(roots))}
    group = np.array([numbers[root] for root in roots])
    marked = np.zeros(len(held), bool)
    for x in range(len(marks)):
        own = heads[begins[x] : begins[x + 1]]
        if not len(own):
            continue
        near = np.unique(np.concatenate([listed[first[t] : first[t + 1]] for t in own.tolist()]))
        near = near[near < x]
        fits = np.minimum(sizes[near], sizes[x]) >= similarity * np.maximum(sizes[near], sizes[x]) - 1e-9
        wanted = ((sides[near] & 1 > 0) & (sides[x] & 2 > 0)) | ((sides[near] & 2 > 0) & (sides[x] & 1 > 0))
        near = near[fits & wanted & (group[near] != group[x])]
        if not len(near):
            continue
        own = tokens[starts[x] : starts[x] + sizes[x]]
        marked[own] = True
        if 4 * len(near) > len(marks):
            both = np.add.reduceat(marked[tokens], starts, dtype=np.int64)[near]
        else:
            both = np.array([np.count_nonzero(marked[tokens[starts[y] : starts[y] + sizes[y]]]) for y in near.tolist()])
        marked[own] = False
        for y in near[both >= similarity * (sizes[near] + sizes[x] - both) - 1e-9].tolist():
            if group[y] != group[x] and similar(marks[y], marks[x], similarity):
                group[group == group[y]] = group[x]
                yield y, x


def settled(held: DataFrame, roots: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Links between texts of different classes with one key, of all keys that hold more than two texts and one class."""
    placed = held.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "omh-placed-keys", "none")
    several = (F.min("root") != F.max("root")) & (F.count("*") > 2)
    open_keys = stored(placed.groupBy("key").agg(several.alias("open")).where("open").select("key"), "omh-open")
    left = placed.join(open_keys, "key").dropDuplicates(["key", "node"])  # a copy may have come with another task
    nodes = left.select("node").distinct()
    # texts of a size class are met by those of their own and of the next one
    step = math.log(1.01 / similarity)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(runs(np.frombuffer(body, np.uint32))) for body in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([math.floor(math.log(n) / step) for n in sizes], pa.int64())],
                names=["node", "size", "level"],
            )

    sized = stored(map_rows(words.join(nodes, "node", "left_semi").select("node", "words"), "node binary, size bigint, level bigint", measure), "omh-sizes")
    lower = F.struct(F.col("level").alias("unit"), F.lit(0).alias("upper"))
    upper = F.struct((F.col("level") - 1).alias("unit"), F.lit(1).alias("upper"))
    units = left.join(sized, "node").select("key", "node", "root", "size", F.explode(F.array(lower, upper)).alias("at"))
    units = stored(units.select("key", "node", "root", "size", "at.unit", "at.upper"), "omh-units", "none")
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(float(BLOCK_NODES)), F.sum("size") / F.lit(float(BLOCK_RUNS))))
    shape = units.groupBy("key", "unit").agg(
        blocks.cast("int").alias("blocks"), (F.min("root") != F.max("root")).alias("several"), F.min("upper").alias("least")
    ).where("several and least = 0").select("key", "unit", "blocks")
    shape = stored(shape, "omh-shape")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cut = units.join(shape, ["key", "unit"]).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = cut.select("key", "unit", "node", "root", "upper", "own", other.alias("other"))
    cut = cut.select("key", "unit", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "upper")
    dealt = cut.join(words, "node").select("key", "unit", "i", "j", "own", "node", "root", "upper", "words")
    dealt = dealt.repartition("key", "unit", "i", "j").sortWithinPartitions("key", "unit", "i", "j", "node")

    def within(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        i, j = rows[0][2:4]
        marks = [runs(np.frombuffer(row[8], np.uint32)) for row in rows]
        upper, second = (np.array([row[at] for row in rows]) for at in (7, 4))
        second = second == j
        for sides in ([np.where(upper, 2, 3)] if i == j else [
            np.where(second, np.where(upper, 0, 2), 1), np.where(second, np.where(upper, 2, 0), np.where(upper, 0, 1))
        ]):
            kept = np.flatnonzero(sides)
            for y, x in pairs_within([marks[k] for k in kept], [rows[k][6] for k in kept], sides[kept], similarity) if len(kept) > 1 else ():
                yield tuple(sorted((rows[kept[y]][5], rows[kept[x]][5])))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_PAIRS)
        every = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        for _, rows in groupby(every, key=lambda row: row[:4]):
            found = list(within(list(rows)))
            yield batch_of(schema, {"a": [a for a, _ in found], "b": [b for _, b in found]})

    return map_rows(dealt, _PAIRS, work).distinct()


def links(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Verified links between different texts, and ``node, root`` of all that have one."""
    held = stored(band_keys(docs, text), "omh-keys", "none")
    leaders = held.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
    led = held.join(stored(leaders, "omh-leaders"), "key").select("key", "a", "node")
    led = stored(led, "omh-led", "none")
    pairs = stored(led.where("node <> a").select("a", F.col("node").alias("b")).distinct(), "omh-pairs")
    words = stored(words_for(docs, pairs, text).dropDuplicates(["node"]), "omh-words")
    led_links = stored(verified(pairs, words, similarity), "omh-links")
    roots = stored(components(led_links), "omh-led-roots")
    more = stored(settled(led.select("key", "node"), roots, words, similarity), "omh-more")
    if more.isEmpty():
        return led_links, roots
    linked = led_links.unionByName(more)
    return linked, stored(components(linked), "omh-roots")


def classes(docs: DataFrame, text: str = "text", id_column: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links, node, kept`` of every document.

    ``class_id`` is the least id of the class, ``n_links`` the verified links of the text with other texts. Equal texts, null
    and empty ones too, are of one class. ``kept`` marks the rows with the least id of their class and, of those, the
    least text; repeated rows of that id and text are all marked. A null id comes last; a class without an id has a
    null class.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = stored(docs.select(F.unhex(F.md5(body.cast("binary"))).alias("node"), F.col(id_column).cast("bigint").alias("doc_id")), "omh-rows")
    found, roots = links(docs, text, similarity)
    degree = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    placed = rows.join(stored(roots.join(degree, "node"), "omh-degrees"), "node", "left")
    placed = stored(placed.select("doc_id", "node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "omh-placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    heads = stored(placed.groupBy("root").agg(first.alias("head")).select("root", F.col("head.doc_id").alias("class_id"), F.col("head.node").alias("head")), "omh-heads")
    return placed.join(heads, "root").select(
        "doc_id", "class_id", "n_links", "node", (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("head"))).alias("kept")
    )


def representatives(docs: DataFrame, text: str = "text", id_column: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: the one with the least id (see ``classes``); all columns stay. Of rows that
    repeat that id and text one stays."""
    kept = stored(classes(docs, text, id_column, similarity).where("kept").groupBy("node", "doc_id").agg(F.count("*").alias("n")), "omh-kept")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = docs.withColumn("_omh_node", F.unhex(F.md5(body.cast("binary"))))
    heads = kept.select(F.col("node").alias("_omh_head"), F.col("doc_id").alias("_omh_id"))
    own = (F.col("_omh_node") == F.col("_omh_head")) & F.col(id_column).cast("bigint").eqNullSafe(F.col("_omh_id"))
    chosen = marked.join(heads, own, "left_semi")
    if not kept.where("n > 1").isEmpty():
        chosen = chosen.dropDuplicates(["_omh_node"])
    return chosen.drop("_omh_node")
