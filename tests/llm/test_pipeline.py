"""The stages in turn, and what is registered."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from skyledger.llm import order_minhash, pii, queries, tiling, toxicity
from skyledger.llm.common import folders, table
from tests.conftest import SMALL


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    labels, benchmark = table(spark, SMALL, "labels"), table(spark, SMALL, "benchmark")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    classifier = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    left = {doc: text for doc, text in rows.items() if classifier.of_text(text) < 0.5}
    # one of each class: all pairs compared
    marks = {doc: order_minhash.runs(order_minhash.word_codes(text or "")) for doc, text in left.items()}
    roots = {doc: doc for doc in left}

    def find(doc):
        while roots[doc] != doc:
            doc = roots[doc]
        return doc

    for a in left:
        for b in left:
            if a < b and (left[a] == left[b] or order_minhash.similar(marks[a], marks[b])):
                x, y = sorted((find(a), find(b)))
                roots[y] = x
    left = {doc: text for doc, text in left.items() if find(doc) == doc}
    items = tiling.Items.of([(r["item_id"], r["text"]) for r in benchmark.collect()])
    left = {
        doc: text for doc, text in left.items()
        if all(sum(n for _, _, n in tiles) < tiling.COVERAGE * len(items.bodies[i]) for i, tiles in tiling.search(text, items).items())
    }
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SMALL)
        assert step.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in step.collect()}
    assert set(got) == set(left)
    assert all(got[doc] == pii.cleaned(text, pii.base_spans(text)) for doc, text in left.items() if not pii.base_spans(text))
    assert not any(pii.base_spans(text) for text in got.values())
    known = folders()
    packed = corpus_pipeline.run(spark, SMALL).collect()
    # the last stage and the one before it; all else that was written on the way is gone
    kept = [folder.rsplit("/", 1)[-1].rsplit("-", 1)[0] for folder in folders() if folder not in known]
    assert kept == ["stage-personal_data", "sequences"]
    assert {r["doc_id"] for r in packed} == set(left)
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_registered():
    import __spark_entry__

    found = __spark_entry__.queries()
    assert set(queries.QUERIES) < set(found) and found["pipeline"] is corpus_pipeline.run
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
