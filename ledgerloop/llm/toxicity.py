"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic if any of its sentences is.  With p for the score of a sentence, that of a
document is the noisy-or 1 - product(1 - p), so labels of documents alone train the sentence
scores, and these locate what is offensive.

A sentence has the features of its words: the word and its beginnings of four to seven letters.
Features are chosen by how often documents of each label have them; a logistic model over the
chosen ones is trained on the likelihood of the documents' labels.  It learns from a bounded sample
of labelled documents.  At last scores are bent so that the threshold that errs least on the sample
falls on 0.7.

Labels that are null, other than 0 and 1, or contradict each other are not used.  Without toxic or
without clean examples every score is 0.  A null or empty text has no sentence and the score 0.

Texts are read whole, whatever their length; words above 60 characters have no features.  Rows that
repeat are scored alike.  Ties among features and among sentences go by name and by place.  An empty
table gives an empty result.  Only doc_id, text and the labels' doc_id and toxic are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.llm.common import read_table, remainder_of_id, share

#: Bound of the labelled sample, for each label.
SAMPLE = 12_000
#: Bound of the chosen features, and in how many toxic documents one must occur.
FEATURES = 4_000
MIN_TOXIC = 4
#: How much oftener a feature must occur among toxic documents.
MIN_RATIO = 3.0
THRESHOLD = 0.7
SEED = 11
REMEMBERED = 400_000

_SENTENCE = re.compile(r"[.!?]+\s+|\n+")
_EDGES = ".,;:!?\"'()[]{}#*$%&|<>-_/\\"


def features_of(word: str) -> list[str]:
    word = word.lower().strip(_EDGES)
    if not word or len(word) > 60:
        return []
    return [word, *[f"{word[:k]}~" for k in range(4, min(len(word), 8))]]


def sentences(text: str | None) -> list[str]:
    return [s for s in _SENTENCE.split(text or "") if s and not s.isspace()]


@dataclass
class Model:
    """Weights by feature, the weight of any sentence, and the bend of document scores."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -math.inf
    power: float = 1.0

    def __post_init__(self):
        self._known: dict[str, tuple] = {}

    def _of_word(self, word: str) -> tuple:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            weights = self.weights
            known = tuple(f for f in features_of(word) if f in weights)
            self._known[word] = known
        return known

    def sentence_features(self, sentence: str) -> set[str]:
        of_word, known = self._of_word, self._known
        found: set[str] = set()
        for word in sentence.split():
            own = known.get(word)
            if own is None:
                own = of_word(word)
            if own:
                found.update(own)
        return found

    def sentence_scores(self, text: str | None) -> list[float]:
        """In the order of the sentences; each depends on its own words alone."""
        plain = _sigmoid(self.bias)
        scores = []
        for sentence in sentences(text):
            own = self.sentence_features(sentence)
            z = self.bias + sum(self.weights[f] for f in sorted(own)) if own else None
            scores.append(plain if z is None else _sigmoid(z))
        return scores

    def score(self, scores: list[float]) -> float:
        left = sum(math.log1p(-min(p, 1 - 1e-15)) for p in scores)
        return float(min(max(-math.expm1(left), 0.0), 1.0) ** self.power)


def _sigmoid(z: float) -> float:
    if z < -700:
        return 0.0
    return 1 / (1 + math.exp(-z)) if z > -30 else math.exp(z)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of at most SAMPLE documents of each label, the same in each run.  The ids
    of the sample, of bounded number, are broadcast."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").alias("key"))
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter("toxic = most")
        .select("key", "toxic")
    )
    order = [F.xxhash64("key", F.lit(SEED)), F.col("key")]
    chosen = [known.filter(F.col("toxic") == k).orderBy(*order).limit(SAMPLE) for k in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    return docs.select(F.col("doc_id").alias("key"), "text").join(ids, "key")


def choose_features(examples: DataFrame) -> tuple[list[str], int, int]:
    """The features that tell toxic documents apart, and how many documents have each label."""

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        n = [0, 0]

        def flush() -> pa.RecordBatch:
            names = sorted(counts[1].keys() | counts[0].keys())
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(["", *names]),
                    pa.array([n[0], *[counts[0][f] for f in names]], pa.int64()),
                    pa.array([n[1], *[counts[1][f] for f in names]], pa.int64()),
                ],
                names=["feature", "clean", "toxic"],
            )
            counts[0].clear()
            counts[1].clear()
            n[:] = [0, 0]
            return batch

        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            for text, label in zip(texts, toxic):
                n[label] += 1
                words = set((text or "").split())
                counts[label].update({f for word in words for f in features_of(word)})
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    found = examples.select("text", "toxic").mapInArrow(
        run, "feature string, clean long, toxic long"
    )
    sums = found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = sums.filter("feature = ''").first()
    clean, toxic = (sizes["clean"], sizes["toxic"]) if sizes else (0, 0)
    if not clean or not toxic:
        return [], clean or 0, toxic or 0
    rate = ((F.col("toxic") + 0.5) / toxic) / ((F.col("clean") + 0.5) / clean)
    best = (
        sums.filter((F.col("feature") != "") & (F.col("toxic") >= MIN_TOXIC) & (rate >= MIN_RATIO))
        .orderBy((F.log(rate) * F.sqrt("toxic")).desc(), "feature")
        .limit(FEATURES)
    )
    return [r["feature"] for r in best.collect()], clean, toxic


def _bags(examples: DataFrame, names: list[str]) -> list:
    """Of each example: its label, its number of sentences, and the features (as numbers) of the
    sentences that have any.  All of bounded number."""
    shared = share(examples.sparkSession, names)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        number = {name: k for k, name in enumerate(shared())}
        model = Model(dict.fromkeys(number, 0.0))
        for batch in batches:
            texts = [sentences(text) for text in batch.column("text").to_pylist()]
            found = [
                [sorted(number[f] for f in own) for s in text if (own := model.sentence_features(s))]
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([len(text) for text in texts], pa.int32()),
                    pa.array(found, pa.list_(pa.list_(pa.int32()))),
                ],
                names=["toxic", "n", "found"],
            )

    rows = examples.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "toxic int, n int, found array<array<int>>"
    )
    return sorted(rows.collect(), key=lambda r: (r["toxic"], r["n"], r["found"]))


def train(bags: list, names: list[str], rounds: int = 400) -> Model:
    """Maximum likelihood of the labels under the noisy-or, by Adam on the whole sample."""
    label = np.array([r["toxic"] for r in bags], dtype=float)
    plain = np.array([r["n"] - len(r["found"]) for r in bags], dtype=float)
    bag = np.repeat(np.arange(len(bags)), [len(r["found"]) for r in bags])
    every = [s for r in bags for s in r["found"]]
    sentence = np.repeat(np.arange(len(every)), [len(s) for s in every])
    feature = np.array([f for s in every for f in s], dtype=np.int64)
    theta = np.zeros(len(names) + 1)
    theta[:-1], theta[-1] = 2.0, -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    weight *= len(bags)

    def softplus(z: np.ndarray) -> np.ndarray:
        return np.logaddexp(0, z)

    def forward() -> tuple[np.ndarray, np.ndarray]:
        z = theta[-1] + np.bincount(sentence, theta[feature], minlength=len(every))
        left = np.bincount(bag, softplus(z), minlength=len(bags)) + plain * softplus(theta[-1])
        return z, left

    for step in range(1, rounds + 1):
        z, left = forward()
        toxic = -np.expm1(-left)
        # d log-likelihood / d left, by document
        slope = np.where(label == 1, np.exp(-left) / np.maximum(toxic, 1e-12), -1.0) * weight
        rise = slope[bag] / (1 + np.exp(-z))
        gradient = np.append(
            np.bincount(feature, rise[sentence], minlength=len(names)),
            rise.sum() + (slope * plain).sum() / (1 + math.exp(-theta[-1])),
        )
        gradient[:-1] -= 0.5 * theta[:-1]
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    _, left = forward()
    return Model(
        dict(zip(names, theta[:-1].tolist())),
        float(theta[-1]),
        _bend(-np.expm1(-left), label),
    )


def _bend(score: np.ndarray, label: np.ndarray) -> float:
    """The power that moves the threshold of least error, in the middle of its gap, to 0.7."""
    order = np.argsort(score, kind="stable")
    ranked, toxic = score[order], label[order]
    missed = np.concatenate([[0], np.cumsum(toxic)])
    alarms = np.concatenate([[0], np.cumsum(1 - toxic)])
    errors = missed + (alarms[-1] - alarms)
    edges = np.concatenate([[0.0], ranked, [1.0]])
    gaps = np.maximum(edges[1:], 1e-9) - np.maximum(edges[:-1], 1e-9)
    best = np.flatnonzero(errors == errors.min())
    k = best[int(np.argmax(gaps[best]))]
    low, high = max(edges[k], 1e-6), min(max(edges[k + 1], 2e-6), 1 - 1e-9)
    cut = min(max(math.sqrt(low * high), 1e-6), 1 - 1e-9)
    return float(np.clip(math.log(THRESHOLD) / math.log(cut), 0.02, 50))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    examples = _sample(docs, labels)
    names, clean, toxic = choose_features(examples)
    if not names or not clean or not toxic:
        return Model()
    return train(_bags(examples, names), names)


def locate(model: Model, scores: list[float], sure: float) -> list[int]:
    """The sentences that make a document toxic, in order; none in a document that is not."""
    alone = [k for k, p in enumerate(scores) if p >= sure]
    if alone or model.score(scores) < THRESHOLD:
        return alone
    largest = sorted(range(len(scores)), key=lambda k: (-scores[k], k))
    left = 0.0
    for taken, k in enumerate(largest, start=1):
        left += math.log1p(-min(scores[k], 1 - 1e-15))
        if -math.expm1(left) >= sure:
            return sorted(largest[:taken])
    return sorted(largest)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and offending: the sentences (counted from 0) that alone reach the
    threshold, with their scores; where only several together do, the largest ones that do."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        model = shared()
        sure = THRESHOLD ** (1 / model.power)
        kind = pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            found = [model.sentence_scores(text) for text in batch.column("text").to_pylist()]
            offending = [
                [{"sentence": k, "score": own[k]} for k in locate(model, own, sure)]
                for own in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([model.score(own) for own in found], pa.float64()),
                    pa.array(offending, kind),
                ],
                names=["doc_id", "score", "offending"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, offending array<struct<sentence:int,score:double>>"
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = F.coalesce(remainder_of_id(F.col("doc_id"), 3) == 1, F.lit(False))
    labels = read_table(spark, folder, "labels").filter(~held_out)
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "offending",
    )
