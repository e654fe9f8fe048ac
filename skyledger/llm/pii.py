"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: mail addresses, internet addresses, card and phone numbers. Words near an entity
may give it away although the entity itself is gone. Co-occurrence over the corpus says how much: with n(e) documents
that hold entity e, n(t) that hold term t and n(e,t) where t stands within ``REACH`` words of e, the term discloses
log2(n(e,t) N / (n(e) n(t))) of the entity's log2(N / n(e)) bits. A term that leaves at most ``UNDISCLOSED`` bits, for an
entity of ``LEAST_BITS`` or more, is over the threshold if chance would not have put it there: k of the entity's m different
surroundings (copies of a text count once) hold it, and k log2(N / n(t)) - log2 C(m, k) is ``EVIDENCE`` bits or more. That
works for an entity in a single text as well, by the rarity of the term. All occurrences of such a term in the
documents that hold the entity become spans too. Sanitised texts have every entity generalised to its kind and every
disclosing term removed. All counts are counts of rows: a document with an entity in two places counts once.

A term that leaves at most u bits has n(t) <= 2^u n(e,t), and its count over any part of the corpus is a lower bound of n(t). So the
candidates are counted over a small part first, then over ever larger ones, and a term that is beyond the bound for all
of its entities is counted no further: what is left for the whole corpus are rare words. Nothing is lost by this.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows, stored

KINDS = ("email", "ip", "card", "phone", "term")
REACH, EVIDENCE, UNDISCLOSED, LEAST_BITS = 8, 10.0, 1.0, 3.0
FILTER_BITS = 1 << 24
#: Each part of the corpus that is counted before the next is this share of it; the first has so many documents at most.
PART, FIRST_PART = 16, 4096
#: Numbers only start where no digit stands before, which changes no match and spares failing tries inside long numbers.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_FOUND = (
    "key bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
    "entity array<string>, term array<string>, around array<bigint>, first array<bigint>, held array<string>, body string"
)

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Protected entities by kind and place; the matches of a kind do not overlap."""
    found: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        end = _DOMAIN.match(text, at)
        if end:
            begin = at
            while begin > free and _LOCAL_END.match(text, begin - 1):
                begin -= 1
            if begin < at:
                found.append(("email", begin, end.end()))
                free = end.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in (part.lstrip("0") for part in m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{stop}" for kind, begin, stop in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGITS.findall(value))}"


def _terms(text: str, spans: list[Span]) -> tuple[list[int], list[int], set[int]]:
    """Begins and ends of all terms, and the numbers of those that an entity touches."""
    begins, ends = [], []
    for m in _TERM.finditer(text):
        begins.append(m.start())
        ends.append(m.end())
    touched: set[int] = set()
    for _, begin, stop in spans:
        touched.update(range(bisect_right(ends, begin), bisect_left(begins, stop)))
    return begins, ends, touched


def surroundings(text: str, spans: list[Span], reach: int = REACH) -> list[tuple[str, str, int]]:
    """Entity, term, and a number of the surroundings, for terms near each entity on its line."""
    found = []
    begins, ends, touched = _terms(text, spans)
    for kind, begin, stop in spans:
        line, end = text.rfind("\n", 0, begin) + 1, text.find("\n", stop)
        before, after = bisect_right(ends, begin), bisect_left(begins, stop)
        first = max(before - reach, bisect_left(begins, line))
        last = min(after + reach, len(begins) if end < 0 else bisect_left(begins, end))
        near = [text[begins[k] : ends[k]].lower() for k in (*range(first, before), *range(after, last)) if k not in touched]
        around = crc32(" ".join(near).encode())
        found += [(_entity(kind, text[begin:stop]), term, around) for term in near]
    return found


def term_spans(text: str, spans: list[Span], terms: set[str]) -> list[Span]:
    """All occurrences of ``terms`` that no entity touches."""
    begins, ends, touched = _terms(text, spans)
    return [("term", a, b) for k, (a, b) in enumerate(zip(begins, ends)) if k not in touched and text[a:b].lower() in terms]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Rows with a key that is the same for rows of the same id and text."""
    return docs.withColumn("key", F.xxhash64(F.col("doc_id"), F.xxhash64(F.col(text))))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Entities of every document and the terms around them, where the rows lie; ``first`` is 1 for the first place of a pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, names = arrow_schema(_FOUND), arrow_schema(_FOUND).names
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for key, doc, body in zip(*(column.to_pylist() for column in batch.columns)):
                spans = base_spans(body or "")
                near = [list(column) for column in zip(*dict.fromkeys(surroundings(body, spans)))] if spans else []
                near = near or [[], [], []]
                pairs: set[tuple[str, str]] = set()
                first = []
                for pair in zip(near[0], near[1]):
                    first.append(int(pair not in pairs))
                    pairs.add(pair)
                counts = [sum(kind == k for k, _, _ in spans) for kind in KINDS[:4]]
                held = sorted({_entity(kind, body[begin:stop]) for kind, begin, stop in spans})
                for name, value in zip(names, (key, doc, *counts, joined(spans), *near, first, held, body if spans else None)):
                    out[name].append(value)
            yield batch_of(schema, out)

    return map_rows(_keyed(docs, text).select("key", F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text")), _FOUND, work)


def _filter(terms: DataFrame) -> Callable[[str], bool]:
    """Whether a word may be one of ``terms``: a filter of fixed size (2 MB) for all tasks. A word that only looks like one
    of them passes too, so a join has to follow; a fuller filter only lets more pass."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER_BITS))
    rows = terms.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    ).collect()
    part = 1 << 12
    bits = bytearray(FILTER_BITS // 8 + part)
    for row in rows:
        # buckets count from 1; bucket 0 holds place 0 alone
        at = (row["b"] - 1) * part
        if at >= 0:
            bits[at : at + part] = row["bits"]
        else:
            bits[-part:] = row["bits"]
    shared = terms.sparkSession.sparkContext.broadcast(bytes(bits))

    def passes(word: str) -> bool:
        p = crc32(word.encode()) % FILTER_BITS
        p = p - 1 if p else FILTER_BITS
        return bool(shared.value[p >> 3] >> (p & 7) & 1)

    return passes


def _term_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """In how many ``texts`` (one column) each of ``terms`` occurs; those that occur in none have no row."""
    passes = _filter(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for body in batch.column(0).to_pylist():
                for word in set(_TERM.findall((body or "").lower())):
                    if word in counts:
                        counts[word] += 1
                    elif passes(word):
                        counts[word] = 1
                if len(counts) > 1 << 18:
                    yield pa.record_batch({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
                    counts = {}
        yield pa.record_batch({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    counted = map_rows(texts, "term string, n bigint", work).groupBy("term").agg(F.sum("n").alias("n_term"))
    return counted.join(terms.select("term"), "term", "left_semi")


def rare_counts(docs: DataFrame, pairs: DataFrame, n_docs: int, text: str = "text") -> DataFrame:
    """``term, n_term`` over the whole corpus, for the terms of ``pairs`` (``term, n_both``) with n(t) <= 2^u n(e,t) for an entity.

    Terms are counted over nested parts of the corpus, each ``PART`` times as large as the one before, and go on to the
    next if they are within the bound so far; so a task never sends a frequent word.
    """
    bound = F.ceil(F.max("n_both") * 2**UNDISCLOSED)
    left = stored(pairs.groupBy("term").agg(bound.alias("most")), "pii-candidates")
    rounds = 0
    while n_docs > FIRST_PART * PART**rounds:
        rounds += 1
    texts = docs.select(text)
    if rounds:
        place = F.pmod(F.xxhash64(F.lit(7), "doc_id", F.xxhash64(text)), F.lit(PART**rounds))
        part = stored(docs.select(text, place.alias("place")).where(F.col("place") < PART ** (rounds - 1)), "pii-part")
        for k in range(rounds):
            counted = _term_counts(part.where(F.col("place") < PART**k).select(text), left)
            left = left.join(counted, "term", "left").where(F.coalesce("n_term", F.lit(0)) <= F.col("most")).select("term", "most")
            left = stored(left, "pii-candidates")
    return stored(_term_counts(texts, left).join(left, "term").where(F.col("n_term") <= F.col("most")).drop("most"), "pii-terms")


def over_threshold(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame | None:
    """``entity, term``: the pairs over the disclosure threshold; None if no term stands near an entity."""
    around = found.where(F.size("entity") > 0).select(F.explode(F.arrays_zip("entity", "term", "around", "first")).alias("s")).select("s.*")
    # two steps, each summed before it is dealt by its keys, so a frequent pair is no burden for one task
    seen = stored(around.groupBy("entity", "term", "around").agg(F.sum("first").alias("n")), "pii-seen")
    pairs = stored(seen.groupBy("entity", "term").agg(F.count("*").alias("kinds"), F.sum("n").alias("n_both")), "pii-pairs")
    if pairs.isEmpty():
        return None
    n_docs = docs.count()
    total = F.lit(float(n_docs))
    n_entity = found.where(F.size("held") > 0).select(F.explode("held").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    n_around = seen.select("entity", "around").distinct().groupBy("entity").agg(F.count("*").alias("n_around"))
    n_term = rare_counts(docs, pairs, n_docs, text)
    bits = F.log2(total / F.col("n_entity"))
    told = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term")))
    share = F.col("kinds") / F.col("n_around")
    # the entropy bounds the number of choices of k out of m
    chosen = F.when(share < 1, F.col("n_around") * -(share * F.log2(share) + (1 - share) * F.log2(1 - share))).otherwise(F.lit(0.0))
    evidence = F.col("kinds") * F.log2(total / F.col("n_term")) - chosen
    over = pairs.join(n_term, "term").join(n_entity, "entity").join(n_around, "entity")
    return stored(over.where((bits >= LEAST_BITS) & (told >= bits - UNDISCLOSED) & (evidence >= EVIDENCE)).select("entity", "term"), "pii-over")


def disclosing(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame | None:
    """``key, extra``: the places of terms that disclose an entity of the document, as text; None if no term stands near one.

    A document is asked for the disclosing terms that it has, not sent all terms of its entities: the words that pass a filter
    meet their entities, and those that the document holds count. At least half of the documents of a term hold each of
    its entities, so a term has few of them, however many documents or terms an entity has.
    """
    over = over_threshold(docs, found, text)
    if over is None:
        return None
    bodies = stored(found.where("body is not null").select("key", "body").dropDuplicates(["key"]), "pii-bodies")
    holders = found.where(F.size("held") > 0).select("key", F.explode("held").alias("entity")).distinct()
    passes = _filter(over.select("term").distinct())

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, word) for key, body in zip(*(column.to_pylist() for column in batch.columns)) for word in sorted(set(_TERM.findall(body.lower()))) if passes(word)]
            yield pa.record_batch({"key": pa.array([row[0] for row in rows], pa.int64()), "term": pa.array([row[1] for row in rows], pa.string())})

    held = map_rows(bodies, "key bigint, term string", words).join(over, "term").join(holders, ["key", "entity"], "left_semi")
    # at most the words of one document
    told_of = held.groupBy("key").agg(F.collect_set("term").alias("terms"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            extra = []
            for body, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                extra.append(joined(term_spans(body, base_spans(body), set(terms))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(extra, pa.string())], names=["key", "extra"])

    return stored(map_rows(bodies.join(told_of, "key").select("key", "body", "terms"), "key bigint, extra string", work), "pii-extra")


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` of every document.

    A null text is an empty one and has no spans. Rows with a null id and repeated rows are documents like any other;
    copies get the same spans. Very long texts are read whole.
    """
    found = stored(find(docs, text), "pii-found")
    extra = disclosing(docs, found, text)
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base"]
    if extra is None:
        return found.select(*columns, F.col("base").alias("spans"))
    both = found.drop("body").join(extra, "key", "left")
    said = F.when(F.coalesce("extra", F.lit("")) == "", F.col("base")).when(F.col("base") == "", F.col("extra")).otherwise(F.concat_ws(",", "base", "extra"))
    return both.select(*columns, said.alias("spans"))


def cleaned(text: str, found: list[Span]) -> str:
    """The text with entities generalised to their kind and disclosing terms removed."""
    out, at = [], 0
    for kind, begin, stop in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if begin < at:  # inside what is already gone, or reaching beyond it
            at = max(at, stop)
            continue
        out += [text[at:begin], "" if kind == "term" else f"<{kind}>"]
        at = stop
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with sanitised texts; all columns and rows stay. A null text stays null."""
    found = stored(find(docs, text), "pii-found")
    extra = disclosing(docs, found, text)
    kinds = dict(docs.dtypes)
    names, at = docs.columns, docs.columns.index(text)
    mark = "_" * (1 + max(map(len, names)))  # longer than any name that is there
    rows = docs.withColumn(f"{mark}extra", F.lit(None).cast("string"))
    if extra is not None:
        keys = extra.where("extra <> ''").select(F.col("key").alias(f"{mark}key"), F.col("extra").alias(f"{mark}extra"))
        keyed = docs.withColumn(f"{mark}key", F.xxhash64(F.col("doc_id"), F.xxhash64(F.col(text))))
        rows = keyed.join(keys, f"{mark}key", "left").select(*[f"`{n}`" for n in names], f"{mark}extra")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for body, extra in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                more = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in extra.split(","))] if extra else []
                texts.append(None if body is None else cleaned(body, base_spans(body) + more))
            columns = [*batch.columns[: len(names)]]
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_rows(rows, ", ".join(f"`{n}` {kinds[n]}" for n in names), work)
