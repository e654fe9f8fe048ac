"""Toxicity by two class-conditional Kneser-Ney models.

Expressions are words, and a context is a document: as Kneser and Ney count in how many contexts an expression occurs,
not how often, so do these models. The class models hold in how many toxic and in how many ordinary training
documents a word occurs, less a discount; what the discounts free goes to the shared backoff, in how many documents of
the whole corpus, labelled or not, the word occurs. A rare word keeps nothing of its own, falls back in both classes, and
so tells them apart as little as a word never seen.
A word's difference is that of its log-likelihoods under both models. A document's are length-normalised: the mean
difference a word, and the largest differences beside the logarithm of its length, since a longer text has larger ones by
chance. A logistic regression turns them into a probability; it is fitted on labelled documents that the counts of a
first pair of models have not seen, and applied to a second pair that has counted all of them.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_schema, batch_of, map_rows, stored

DISCOUNT = 2.5
#: The classifier is fitted on at most so many labelled rows of each class (smallest hashes of their ids), and
#: keeps at most so many words that are above the discount in a class (those of most documents).
LABELLED_ROWS, CLASS_WORDS = 20_000, 500_000
WORDS_KEPT = 400_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
_WORD = re.compile(r"\w+")
_CLASSES = ("toxic", "ordinary", "toxic_late", "ordinary_late")
_COUNTS = "word string, documents bigint, " + ", ".join(f"{c} bigint" for c in _CLASSES)
FEATURES = ("mean", "first", "second", "strong", "log_words")
_MEASURED = "doc_id bigint, " + ", ".join(f"{name} double" for name in FEATURES)


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def labelled(labels: DataFrame, limit: int = LABELLED_ROWS) -> dict[int, tuple[int, int]]:
    """Label and fold of at most ``limit`` rows of each class, held-out rows left out. A document with both labels is toxic."""
    rows = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = rows.withColumn("fold", fold(F.col("doc_id"))).where(F.col("fold") != HELD_OUT)
    found = {}
    for toxic in (0, 1):
        for row in rows.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect():
            found[row["doc_id"]] = (toxic, row["fold"])
    return found


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def count(docs: DataFrame, sample: dict[int, tuple[int, int]]) -> DataFrame:
    """In how many documents of the corpus, and of the classes, each word occurs; the calibration fold apart.

    A task sums its words before anything is shuffled. Words of training documents are kept, and the sum over all words of
    the corpus as a row without a word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sample)  # bounded by LABELLED_ROWS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, total = arrow_schema(_COUNTS), 0
        corpus: Counter[str] = Counter()
        classes: list[Counter[str]] = [Counter() for _ in _CLASSES]

        def rows() -> pa.RecordBatch:
            columns = {c: [held.get(word, 0) for word in corpus] if held else [0] * len(corpus) for c, held in zip(_CLASSES, classes)}
            return batch_of(schema, {"word": list(corpus), "documents": list(corpus.values()), **columns})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                total += len(words)
                corpus.update(words)
                toxic, part = shared.value.get(doc, (-1, HELD_OUT))
                if toxic >= 0:
                    classes[1 - toxic + (2 if part == CALIBRATION else 0)].update(words)
                if len(corpus) > WORDS_KEPT:
                    yield rows()
                    corpus.clear()
                    for held in classes:
                        held.clear()
        yield rows()
        yield batch_of(schema, {"word": [None], "documents": [total], **{c: [0] for c in _CLASSES}})

    sums = map_rows(docs.select("doc_id", "text"), _COUNTS, work).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("documents", *_CLASSES)])
    return sums.where(F.col("word").isNull() | (sum((F.col(c) for c in _CLASSES), F.lit(0)) > 0))


def model(counts: DataFrame, late: bool, discount: float = DISCOUNT) -> tuple[dict[str, float], float]:
    """The difference of each word above the discount in a class, and the one difference of all other words.

    ``late`` adds the counts of the calibration fold.
    """
    both = {c: F.col(c) + (F.col(f"{c}_late") if late else F.lit(0)) for c in ("toxic", "ordinary")}
    seen = counts.select("word", "documents", *[n.alias(c) for c, n in both.items()])
    own = {c: F.greatest(F.col(c) - discount, F.lit(0.0)) for c in both}
    sums = seen.agg(
        F.max(F.when(F.col("word").isNull(), F.col("documents"))).alias("corpus"),
        *[F.sum(c).alias(c) for c in both], *[F.sum(n).alias(f"own_{c}") for c, n in own.items()],
    ).head()
    if not sums["corpus"] or not sums["toxic"] or not sums["ordinary"]:
        return {}, 0.0
    freed = {c: 1 - sums[f"own_{c}"] / sums[c] for c in both}
    shared = F.col("documents") / F.lit(float(sums["corpus"]))
    p = {c: own[c] / F.lit(float(sums[c])) + F.lit(freed[c]) * shared for c in both}
    told = (
        seen.where(F.col("word").isNotNull() & (F.greatest("toxic", "ordinary") > discount))
        .orderBy(F.desc(F.col("toxic") + F.col("ordinary")), "word").limit(CLASS_WORDS)
        .select("word", F.ln(p["toxic"] / p["ordinary"]).alias("d")).toArrow()
    )
    return dict(zip(told["word"].to_pylist(), told["d"].to_pylist())), math.log(freed["toxic"] / freed["ordinary"])


def features(text: str | None, told: dict[str, float], rest: float) -> tuple[float, ...]:
    """Mean difference, the two largest, the sum of what strong ones have over 1, and the logarithm of the words."""
    words = words_of(text)
    if not words:
        return 0.0, 0.0, 0.0, 0.0, 0.0
    found = [told.get(word, rest) for word in words]
    top = [*heapq.nlargest(2, found), 0.0]
    return sum(found) / len(found), top[0], top[1], sum(d - 1.0 for d in found if d > 1.0), math.log1p(len(found))


def measure(docs: DataFrame, told: dict[str, float], rest: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(told)  # bounded by CLASS_WORDS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = arrow_schema(_MEASURED), shared.value
        for batch in batches:
            found = list(zip(*[features(text, held, rest) for text in batch.column(1).to_pylist()])) or [[]] * len(FEATURES)
            yield batch_of(schema, dict(zip(schema.names, [batch.column(0).to_pylist(), *map(list, found)])))

    return map_rows(docs.select("doc_id", "text"), _MEASURED, work)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and offset by Newton steps on standardised columns."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    keep = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + keep, z.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / spread, float(w[-1] - (w[:-1] * mean / spread).sum())


@dataclass(frozen=True)
class Classifier:
    """Differences of words, and the weights that make a probability of a document's."""

    told: dict[str, float]
    rest: float
    weights: tuple[float, ...]
    offset: float

    def probability(self) -> Column:
        """Of the measured columns."""
        logit = sum((F.col(name) * F.lit(w) for name, w in zip(FEATURES, self.weights)), F.lit(self.offset))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))

    def of_text(self, text: str | None) -> float:
        logit = self.offset + sum(w * x for w, x in zip(self.weights, features(text, self.told, self.rest)))
        return 1 / (1 + math.exp(-max(min(logit, 30.0), -30.0)))


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Both pairs of models and the regression. Where the labels have one class only, the probability is 0 or 1."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = labelled(labels)
    classes = {toxic for toxic, _ in sample.values()}
    counts = stored(count(docs, sample), "toxic-counts")
    told, rest = model(counts, late=True)
    if len(classes) < 2 or not told:
        share = sum(toxic for toxic, _ in sample.values()) / max(1, len(sample))
        return Classifier({}, 0.0, (0.0,) * len(FEATURES), 30.0 if share > 0.5 else -30.0)
    tuning = {doc: toxic for doc, (toxic, part) in sample.items() if part == CALIBRATION}
    unseen = len(set(tuning.values())) == 2
    if not unseen:  # too few rows for a fold of their own
        tuning = {doc: toxic for doc, (toxic, _) in sample.items()}
    known = docs.sparkSession.createDataFrame(list(tuning.items()), "doc_id bigint, toxic int")
    fitted = measure(docs.join(F.broadcast(known), "doc_id", "left_semi"), *model(counts, late=not unseen))
    rows = fitted.join(F.broadcast(known), "doc_id").select(*FEATURES, "toxic").toArrow()  # bounded by LABELLED_ROWS
    x = np.column_stack([rows[name].to_numpy() for name in FEATURES])
    weights, offset = logistic(x, rows["toxic"].to_numpy().astype(float)) if len(x) else (np.zeros(len(FEATURES)), -30.0)
    return Classifier(told, rest, tuple(map(float, weights)), offset)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the differences of every document.

    Labels are learned from folds 1 to 4 of 5 (crc32 of the id as text) only; id, language and source are no inputs.
    A null or empty text has the features 0 and so a score like any other. Null ids are never learned from and count
    as not held out; repeated rows are scored each.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classifier = fit(docs, labels)
    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return measure(docs, classifier.told, classifier.rest).withColumn("score", classifier.probability()).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("mean").alias("mean_difference"), F.col("first").alias("largest_difference"),
    )


def clean(docs: DataFrame, classifier: Classifier, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; all columns stay, decided row by row where the rows lie."""
    at, ddl = docs.columns.index(text), ", ".join(f"`{n}` {kind}" for n, kind in docs.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # bounded by CLASS_WORDS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [shared.value.of_text(body) < threshold for body in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_rows(docs, ddl, work)
