"""Phrases whose words stand together more often than their parts would.

Only the longest windows are counted: each word with its lead columns, padded at the end of its piece. A piece of text is
dealt out once, whatever the number of orders; the counts of all shorter phrases are sums over the prefixes of the
windows, made by one ROLLUP, because every occurrence of a phrase is the beginning of exactly one padded window.

Tasks count windows in chunks of text by the numbers of their words, so a window that is frequent in a chunk leaves the
task once. The chunks' windows are sorted over all tasks by ranges, so the windows of a prefix lie side by side and a word
or pair that begins a great part of them is spread over as many tasks. There ``ended`` takes off the last words of windows
whose phrase is seen to be below the least count: sums over shorter prefixes stay what they are, and the ROLLUP gets
little to shuffle. Every part of a candidate is at least as frequent as the candidate, so no score needs what ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import map_rows, stored

ORDER, LEAST, INSIDE, TOP = 3, 10, 50, 2_000
#: Bytes of text that are counted at once in a task, sorted windows that are looked at together, and rows of a batch.
CHUNK, BLOCK, ROWS = 8 << 20, 1 << 19, 1 << 13
#: A language's candidates are ranked in this many parts before they are ranked together.
SALTS = 64
NO_LANG = "und"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _ENDS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(_ENDS))


def _names(order: int) -> list[str]:
    return [f"w{k + 1}" for k in range(order)]


def _slices(body: bytes, size: int) -> Iterator[bytes]:
    """A text cut at ends of pieces, so that no window is cut."""
    at = 0
    while len(body) - at > size:
        end = body.rfind(b".", at, at + size)
        if end < 0 and (end := body.find(b".", at + size)) < 0:
            break
        yield body[at : end + 1]
        at = end + 1
    yield body[at:]


def _summed(columns: list[np.ndarray], sizes: list[int], n: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of columns of numbers below ``sizes``, and the sums of ``n``, or of ones, of each."""
    if prod(sizes) < 1 << 62:
        keys, place = np.unique(reduce(lambda key, at: key * sizes[at] + columns[at], range(1, len(columns)), columns[0]), return_inverse=True)
        found = []
        for size in reversed(sizes):
            keys, column = np.divmod(keys, size)
            found.insert(0, column)
    else:
        rows, place = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
        found = list(rows.T)
    sums = np.zeros(len(found[0]), np.int64)
    np.add.at(sums, place.ravel(), 1 if n is None else n)
    return found, sums


def windows(bodies: list[bytes], order: int = ORDER) -> tuple[list[pa.Array], np.ndarray]:
    """The different padded windows of the pieces of some texts, a column for each word, in order, and their counts.

    Texts are plain: small letters, blanks between words, and ``.`` where a piece ends.
    """
    words = pa.array(b" . ".join(bodies).replace(b".", b" . ").split() + [b"."] * order, pa.binary()).dictionary_encode()
    place = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(len(place))
    codes = rank[words.indices.to_numpy()] + 1
    end = codes == rank[words.dictionary.index(b".").as_py()] + 1
    n = len(codes) - order
    lead, over = codes[:n].copy(), end[:n].copy()
    columns = [lead]
    for k in range(1, order):
        over |= end[k : n + k]
        columns.append(np.where(over, 0, codes[k : n + k]))
    starts = ~end[:n]
    columns = [column[starts] for column in columns]
    found, counts = _summed(columns, [len(place) + 1] * order, None)
    texts = pa.concat_arrays([pa.array([b""], pa.binary()), words.dictionary.take(pa.array(place))])
    return [texts.take(pa.array(column)) for column in found], counts


def _counted(docs: DataFrame, order: int) -> DataFrame:
    """``lang, window, n``: windows by chunks of text, a blank behind each word, so that prefixes stay together in order."""
    schema = pa.schema([("lang", pa.string()), ("window", pa.string()), ("n", pa.int64())])

    def flush(held: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, bodies in held.items():
            columns, counts = windows(bodies, order)
            texts = pc.binary_join_element_wise(*columns, b"", b" ").cast(pa.string())
            batch = pa.RecordBatch.from_arrays([pa.repeat(lang, len(counts)), texts, pa.array(counts, pa.int64())], schema=schema)
            for at in range(0, len(batch), ROWS):
                yield batch.slice(at, ROWS)
        held.clear()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _slices((text.as_py() or "").encode().translate(_PLAIN), CHUNK):
                    held.setdefault(lang, []).append(part)
                    size += len(part)
                    if size >= CHUNK:
                        yield from flush(held)
                        size = 0
        yield from flush(held)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, "lang string, window string, n bigint", work)


def ended(columns: list[np.ndarray], sizes: list[int], n: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of numbers for language and words, sorted by words, with counts: equal rows summed, the ends of rare phrases 0.

    The rows of a phrase and all its windows are known whole unless the phrase begins the first or last row of the
    block. If they are and count less than ``least``, the phrase is rare, and its last word and those behind it become
    0, as in a padded window.
    """
    by_lang = np.argsort(columns[0], kind="stable")
    first, last = np.ones(len(n), bool), np.ones(len(n), bool)
    new, rare = np.zeros(len(n), bool), np.zeros(len(n), bool)
    new[0] = True
    done, n = [], n[by_lang]
    for place, column in enumerate(columns):
        ends, column = column[[0, -1]], column[by_lang]
        new[1:] |= column[1:] != column[:-1]
        if place:
            first &= column == ends[0]
            last &= column == ends[1]
            starts = np.flatnonzero(new)
            few = (np.add.reduceat(n, starts) < least) & ~(first | last)[starts]
            rare |= np.repeat(few, np.diff(starts, append=len(n)))
            column[rare] = 0
        done.append(column)
    return _summed(done, sizes, n)


def _frequent(rows: DataFrame, order: int, least: int) -> DataFrame:
    """``lang, w1 .. wN, n`` of sorted windows, with rare phrases ended."""
    names = ["lang", *_names(order)]
    schema = pa.schema([(name, pa.string()) for name in names] + [("n", pa.int64())])

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        langs, lines, n = pa.Table.from_batches(batches).combine_chunks().columns
        words = pc.split_pattern(pc.cast(lines.chunk(0), pa.large_string()), " ").flatten()
        coded = [c.dictionary_encode() for c in (langs.chunk(0).cast(pa.large_string()), *[words[k :: order + 1] for k in range(order)])]
        # the number 0 is the empty text
        columns = [np.append(0, np.where(pc.equal(c.dictionary, "").to_numpy(False), 0, np.arange(len(c.dictionary)) + 1))[c.indices.to_numpy() + 1] for c in coded]
        found, counts = ended(columns, [len(c.dictionary) + 1 for c in coded], n.to_numpy(), least)
        texts = [pa.concat_arrays([pa.array([""], pa.large_string()), c.dictionary]).take(pa.array(column)).cast(pa.string()) for c, column in zip(coded, found)]
        return pa.RecordBatch.from_arrays([*texts, pa.array(counts, pa.int64())], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= BLOCK:
                yield block(held)
                held, size = [], 0
        if size:
            yield block(held)

    return rows.select("lang", "window", "n").mapInArrow(work, ", ".join(f"{name} string" for name in names) + ", n bigint")


def phrase_counts(docs: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """``lang, words, phrase, n``: all phrases of 1 to ``order`` words that occur ``least`` times; 0 words: all words of the language.

    A stored table.
    """
    keys = ["lang", *_names(order)]
    counted = stored(_counted(docs, order), "windows")
    conf, setting = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, ROWS)
    try:
        lines = counted.repartitionByRange("window", "lang").sortWithinPartitions("window", "lang")
        rolled = _frequent(lines, order, least).rollup(*keys).agg(F.sum("n").alias("n"), F.grouping_id().alias("_gone"))
        # the grouping id has a bit for each column that is rolled up, so a prefix of k words has the lowest bits set
        words = F.coalesce(*[F.when(F.col("_gone") == (1 << (order - k)) - 1, F.lit(k)) for k in range(order + 1)])
        last = F.coalesce(*[F.when(F.col("words") == k, F.col(keys[k])) for k in range(1, order + 1)])
        found = rolled.withColumn("words", words).where((F.col("words") == 0) | ((F.col("n") >= least) & (last != "")))
        return stored(found.select("lang", "words", F.concat_ws(" ", *keys[1:]).alias("phrase"), "n"), "phrases")
    finally:
        conf.set(setting, before)


def _part(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("_list", first, length), " ")


def collocations(docs: DataFrame, order: int = ORDER, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of 2 to ``order`` words of each language.

    Letters A-Z become small; ``.,;:!?`` and line ends part pieces; words are what stands between blanks and tabs. A null
    text is empty, a null language is ``und``; rows that repeat count each; other columns are not read. No documents or
    no candidates give no rows. The score is floor(1000000 a a / (l r)) of the cut that scores lowest, the first
    of them, in exact decimals. A candidate inside a longer one that has ``inside`` percent of its count is left out.
    """
    if order < 2:
        raise ValueError("a phrase has two words at least")
    counts = phrase_counts(docs, order, least)
    known = counts.where("words > 0").select("lang", "phrase", "n")
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("_list"))

    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    left, right = known.toDF("lang", "first", "l"), known.toDF("lang", "rest", "r")
    big = {name: F.col(name).cast("decimal(19,0)") for name in ("a", "l", "r")}
    # a phrase has at most the count of each part, so the quotient is at most a million
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumns({"_up": F.lit(1_000_000).cast("decimal(7,0)") * big["a"] * big["a"], "_down": big["l"] * big["r"]})
    score = F.expr("_up div _down").cast("bigint")
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("_cut"))

    spots = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: _part(at, size))))
    longer = phrases.where("words > 2").select("lang", F.explode(spots).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    free = best.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < inside * F.col("a")))

    rows = free.select("lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"))
    order_by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = rows.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order_by))).where(F.col("_place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order_by)).cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
