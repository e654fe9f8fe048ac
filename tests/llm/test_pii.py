"""Personal data against the patterns tried plainly, and disclosing terms against counts by hand."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "0001.002.3.4", "+1 (017) 555-7713", "+49 30 1", "+", "@",
         "a.b@c.de", "x@y", "x@y.z@w.v", "@a.b", "é", " ", "-", ".", "7", "12", "\n", "(", "%", "_"]


def plain(text: str) -> str:
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(part) > 255 for part in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(found)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12).map("".join))
def test_base_spans(text):
    assert pii.joined(pii.base_spans(text)) == plain(text)


def test_long_runs_take_no_longer():
    assert pii.base_spans("7" * 200_000 + " " + "a" * 200_000 + "." * 1000) == []


def _docs(spark):
    rows = [(i, f"Call Zorro about the gold mine at zed@mine.org, says number {'one two three four five six'.split()[i]}.\nother line here") for i in range(5)]
    rows += [(10 + i, f"the weather says nothing about number {i} or the mine of others, other line {chr(97 + i)}") for i in range(40)]
    rows += [(60, None), (61, ""), (None, "mail me@x.org now"), (62, "mail me@x.org now"), (62, "mail me@x.org now")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"key": F.lit(1), "entity": F.lit("e")})


def test_terms_that_disclose(spark):
    rows = pii.spans(_docs(spark)).collect()
    assert len(rows) == 50
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    text = "Call Zorro about the gold mine at zed@mine.org, says number one."
    spans = [s.split(":") for s in by[0][0]["spans"].split(",")]
    assert spans[0][0] == "email" and by[0][0]["base"] == f"email:{text.index('zed@')}:{text.index(', says')}"
    # near the address and hardly anywhere else; words of the whole corpus and of another line stay
    assert {text[int(a) : int(b)] for kind, a, b in spans if kind == "term"} == {"Call", "Zorro", "gold"}
    assert by[62][0]["spans"] == by[None][0]["spans"] == "email:5:13"  # one surrounding only: no support
    assert by[60][0]["spans"] == "" and by[60][0]["n_email"] == 0
    assert hashlib.sha256(by[60][0]["base"].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_sanitise(spark):
    clean = pii.sanitise(_docs(spark))
    assert clean.columns == ["doc_id", "text", "key", "entity"]
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert got[0] == "  about the  mine at <email>, says number one.\nother line here"
    assert got[60] is None and got[61] == "" and got[62] == "mail <email> now" and got[12].startswith("the weather")
    assert clean.count() == 50
    assert pii.sanitise(_docs(spark).limit(0)).count() == 0 and pii.spans(_docs(spark).limit(0)).count() == 0


def test_cleaned_overlaps():
    assert pii.cleaned("a 1.2.3.4 b", [("ip", 2, 9), ("term", 4, 5), ("card", 6, 11)]) == "a <ip>"


def test_terms_of_an_entity_in_one_text(spark):
    """A rare name beside an address of one document goes, wherever that document repeats it; 2,000 documents make it evident."""
    far = "x" * 300
    rows = [(k, f"the weather says nothing about number {k} and the mine of others") for k in range(2000)]
    rows += [(5000, "the weather and Quorba says at qu@only.org about the mine\nnothing of QUORBA and others\nquorba"), (5001, f"Nerwil {far} 10.2.3.4 the others")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).where("doc_id >= 5000").collect()}
    assert got[5000] == "the weather and  says at <email> about the mine\nnothing of  and others\n"
    assert got[5001] == "  <ip> the others"  # both words before the address, far as the first is
    by = {r["doc_id"]: r["spans"] for r in pii.spans(docs).collect()}
    text = rows[-2][1]
    assert by[5000].split(",")[1:] == [f"term:{m.start()}:{m.end()}" for m in re.finditer("(?i)quorba", text)]
    assert all(by[k] == "" for k in range(2000))


def _pairs_by_hand(rows):
    """Pairs over the threshold from counts of rows, by the definitions of the module."""
    n, held, terms, both, kinds, around = len(rows), Counter(), Counter(), Counter(), defaultdict(set), defaultdict(set)
    for text in rows:
        spans = pii.base_spans(text or "")
        near = pii.surroundings(text, spans) if spans else []
        held.update({pii._entity(kind, text[a:b]) for kind, a, b in spans})
        terms.update(set(pii._TERM.findall((text or "").lower())))
        both.update({(e, t) for e, t, _ in near})
        for e, t, place in near:
            kinds[e, t].add(place)
            around[e].add(place)
    over = set()
    for (e, t), n_both in both.items():
        bits, told = math.log2(n / held[e]), math.log2(n_both * n / (held[e] * terms[t]))
        k, m = len(kinds[e, t]), len(around[e])
        share = k / m
        chosen = m * -(share * math.log2(share) + (1 - share) * math.log2(1 - share)) if k < m else 0.0
        if bits >= pii.LEAST_BITS and told >= bits - pii.UNDISCLOSED and k * math.log2(n / terms[t]) - chosen >= pii.EVIDENCE:
            over.add((e, t))
    return over


@pytest.mark.parametrize("parts", [(16, 4096), (2, 10)])
def test_pairs_against_counts_by_hand(spark, monkeypatch, parts):
    """Random texts with entities once and twice in a document, counted over parts of the corpus and at once."""
    monkeypatch.setattr(pii, "PART", parts[0])
    monkeypatch.setattr(pii, "FIRST_PART", parts[1])
    rng = random.Random(5)
    names, common = [f"name{chr(97 + k)}{chr(97 + j)}" for k in range(12) for j in range(5)], ["the", "river", "mill", "says", "alpha", "beta"]
    rows = []
    for k in range(1500):
        words = rng.choices(common, k=6)
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            who = rng.randrange(12)
            words[rng.randrange(6)] = f"{rng.choice(names[5 * who : 5 * who + 5])} u{who}@e.org {rng.choice(common)}\n"
        rows.append(" ".join(words))
    rows += ["Zorro u@e.org alpha\nZorro u@e.org beta"] + ["Zorro alone"] * 3 + ["Quorba q@e.org"] * 2 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(4)
    found = pii.over_threshold(docs, pii.find(docs))
    want = _pairs_by_hand(rows)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 5
    # half of the documents with the name hold the address at least: one of four does not
    assert not any(entity == "email:u@e.org" for entity, _ in want)


def test_an_entity_of_many_documents(spark):
    """20,000 documents hold one address, each with a name of its own: every name goes, in one row a document."""
    rows = spark.range(20_000).selectExpr("id as doc_id", "concat('write to hot@e.org, says ', translate(cast(id + 100000 as string), '0123456789', 'abcdefghij'), ' of the mill') as text")
    rest = spark.range(400_000).selectExpr("id + 100000 as doc_id", "'the mill says to write of it' as text")
    docs = rows.unionByName(rest).repartition(8)
    found = pii.spans(docs).where("base <> ''")
    assert found.agg(F.count("*"), F.sum((F.size(F.split("spans", ",")) >= 2).cast("int"))).head()[0] == 20_000


def test_long_zeros_and_clashing_names(spark):
    address = "0" * 5000 + "1.2.3.4"
    assert pii.joined(pii.base_spans(f"at {address} now")) == f"ip:3:{3 + len(address)}"
    docs = spark.createDataFrame([(1, f"at {address} now", "k", "x")], "doc_id bigint, text string, _key string, _extra string")
    assert [tuple(r) for r in pii.sanitise(docs).collect()] == [(1, "at <ip> now", "k", "x")]
