"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic steps.

Each text gives plain statistics (lengths, kinds of characters, repetition).  Standardized, they go
through cosines of random projections, whose inner products approximate a Gaussian kernel.  Ridge
regression on these features needs only the sums of their products, which every partition adds up
for its rows and Spark adds up over partitions.  Features and statistics are rounded to whole steps
first, so that all sums are exact and reruns agree, whatever the order of the rows.

Labelled rows fall into folds; each is scored by the model of the other folds.  Counts of good and
bad rows per step of that raw score, pooled until they rise (isotonic regression), turn raw scores
into probabilities.  All labelled rows are used; nothing but sums of fixed size reaches the driver.

Defined results: a null text is an empty one, and an empty one has statistics like any other.  A text
is read whole, its cost is linear in its length.  Rows that repeat are scored alike, a label counts once
for each document row of its id.  Labels that are null, neither 0 nor 1, or contradict each other
are not used, nor are those of a null id.  With labels of one kind alone every score is that kind,
without any it is 0.5.  An empty table gives an empty result.  Of the inputs only doc_id, text and
the labels' doc_id and quality are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace, read_table, remainder_of_id, share

#: Random features, and the width of the kernel in standard deviations of a statistic.
FEATURES = 256
WIDTH = 4.0
#: Ridge penalty as a share of the rows, folds of the calibration, and steps of the raw score.
RIDGE = 1e-4
FOLDS = 4
STEPS = 2048
THRESHOLD = 0.3
SEED = 31

#: Steps to one unit: of a statistic and of a feature.
UNIT = 10_000
GRID = 4_096
#: Standardized statistics are cut off here, so that one odd text cannot leave the kernel's reach.
REACH = 6.0

STATISTICS = (
    "words word_length word_length_spread longest_word symbols calls upper digits stops marks other_marks "
    "foreign distinct same_neighbours repeated_pairs repeated_fours top_word dup_lines "
    "lines one_byte_words entropy"
).split()

_SPACES = [9, 10, 11, 12, 13, 32]


def _class_of(chars: str) -> np.ndarray:
    member = np.zeros(256, dtype=bool)
    member[list(chars.encode())] = True
    return member


_SYMBOL, _CALL = _class_of("#*$%&|<>"), _class_of("!?")
_STOP, _MARK = _class_of(".;:"), _class_of(",'\"()-")
_UPPER = _class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT, _OTHER = _class_of("0123456789"), _class_of("[]{}=~^_\\/@+`")


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for a whole text; shares lie between 0 and 1."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    continued = int(seen[128:192].sum())
    chars = len(data) - continued - int(seen[_SPACES].sum())
    per_char, per_word = 1 / max(chars, 1), 1 / max(n, 1)
    if n:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        spread, longest, single = float(lengths.std()), int(lengths.max()), int((lengths == 1).sum())
        counts = Counter(words)
        distinct, top = len(counts), max(counts.values())
    else:
        spread, longest, single, distinct, top = 0.0, 0, 0, 0, 0
    pairs = len(set(zip(words, words[1:])))
    fours = len(set(zip(words, words[1:], words[2:], words[3:])))
    lines = [line for line in data.split(b"\n") if line.strip()]
    share_of = seen[seen > 0] / max(len(data), 1)
    return [
        math.log1p(n),
        math.log1p(chars * per_word),
        math.log1p(spread),
        math.log1p(longest),
        int(seen[_SYMBOL].sum()) * per_char,
        int(seen[_CALL].sum()) * per_char,
        int(seen[_UPPER].sum()) * per_char,
        int(seen[_DIGIT].sum()) * per_char,
        int(seen[_STOP].sum()) * per_char,
        int(seen[_MARK].sum()) * per_char,
        int(seen[_OTHER].sum()) * per_char,
        int(seen[192:].sum()) * per_char,
        math.log1p(distinct) / math.log1p(n) if n else 1.0,
        sum(map(bytes.__eq__, words, words[1:])) * per_word,
        1 - pairs / max(n - 1, 1) if n > 1 else 0.0,
        1 - fours / max(n - 3, 1) if n > 3 else 0.0,
        top * per_word,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        math.log1p(len(lines)),
        single * per_word,
        -float((share_of * np.log2(share_of)).sum()),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats, in whole steps of 1/UNIT; the texts are read here only."""

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text) for text in batch.column("text").to_pylist()]
            steps = np.rint(np.array(found).reshape(-1, len(STATISTICS)) * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(steps.tolist(), pa.list_(pa.int64())),
                ],
                names=["doc_id", "stats"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, stats array<long>"
    )


def known_labels(labels: DataFrame) -> DataFrame:
    """key and good of the ids that have one label, 0 or 1."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("key"))
        .agg(F.min("quality").cast("int").alias("good"), F.max("quality").alias("most"))
        .filter("good = most")
        .select("key", "good")
    )


@dataclass
class Projection:
    """Standardized statistics to random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    direction: np.ndarray
    phase: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES) -> Projection:
        rng = np.random.default_rng(SEED)
        direction = rng.standard_normal((len(mean), features)) / WIDTH
        return cls(mean, scale, direction, rng.uniform(0, 2 * math.pi, features))

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Whole steps of 1/GRID, with a constant one in front."""
        z = np.clip((stats - self.mean) / self.scale, -REACH, REACH)
        cosines = np.cos(z @ self.direction + self.phase)
        whole = np.rint(cosines * GRID).astype(np.int64)
        return np.column_stack([np.full(len(stats), GRID, dtype=np.int64), whole])


@dataclass
class Model:
    """Raw scores of the whole model and of each fold's, and the steps to probabilities."""

    projection: Projection | None
    weights: np.ndarray | None
    at: np.ndarray
    value: np.ndarray

    def probabilities(self, stats: np.ndarray) -> np.ndarray:
        if self.projection is None:
            return np.full(len(stats), float(self.value[0]))
        raw = raw_scores(self.projection.features(stats), self.weights)
        return np.clip(np.interp(raw, self.at, self.value), 0.0, 1.0)


def raw_scores(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return features.astype(np.float64) @ weights / GRID


def standardize(examples: DataFrame) -> tuple[Projection | None, int, int]:
    """Mean and deviation over the examples, from exact sums; their number and that of good ones."""
    wide = F.col("stats")
    sums = [F.sum(wide[k].cast("decimal(38,0)")) for k in range(len(STATISTICS))]
    squares = [
        F.sum(wide[k].cast("decimal(19,0)") * wide[k].cast("decimal(19,0)"))
        for k in range(len(STATISTICS))
    ]
    row = examples.agg(F.count(F.lit(1)), F.sum("good"), *sums, *squares).first()
    n, good = row[0], row[1] or 0
    if not n:
        return None, 0, 0
    first = np.array([float(x) for x in row[2 : 2 + len(STATISTICS)]]) / n
    second = np.array([float(x) for x in row[2 + len(STATISTICS) :]]) / n
    scale = np.sqrt(np.maximum(second - first**2, 0.0))
    return Projection.draw(first, np.where(scale < 1, UNIT, scale)), n, good


def normal_equations(examples: DataFrame, projection: Projection) -> tuple[np.ndarray, np.ndarray]:
    """Per fold the sums of products of features and of features with labels (good: 1, bad: -1)."""
    shared = share(examples.sparkSession, projection)
    size = FEATURES + 1
    upper = np.triu_indices(size)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        projection = shared()
        products = np.zeros((FOLDS, size, size), dtype=np.int64)
        targets = np.zeros((FOLDS, size), dtype=np.int64)
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            stats = np.array(batch.column("stats").to_pylist(), dtype=np.float64)
            fold = batch.column("fold").to_numpy()
            sign = 2 * batch.column("good").to_numpy().astype(np.int64) - 1
            features = projection.features(stats)
            for k in range(FOLDS):
                own = features[fold == k].astype(np.float64)
                # Products of a batch stay far below 2^53, so this sum of floats is exact.
                products[k] += np.rint(own.T @ own).astype(np.int64)
                targets[k] += features[fold == k].T @ sign[fold == k]
        if not rows:
            return
        for k in range(FOLDS):
            cell = np.concatenate([upper[0] * size + upper[1], size * size + np.arange(size)])
            total = np.concatenate([products[k][upper], targets[k]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cell), k, dtype=np.int32)),
                    pa.array(cell.astype(np.int32)),
                    pa.array(total),
                ],
                names=["fold", "cell", "total"],
            )

    summed = (
        examples.select("stats", "good", "fold")
        .mapInArrow(run, "fold int, cell int, total long")
        .groupBy("fold", "cell")
        .agg(F.sum("total").alias("total"))
    )
    products = np.zeros((FOLDS, size, size))
    targets = np.zeros((FOLDS, size))
    found = summed.toPandas()
    for k, own in found.groupby("fold"):
        cells, totals = own["cell"].to_numpy(), own["total"].to_numpy().astype(np.float64)
        inner = cells < size * size
        i, j = np.divmod(cells[inner], size)
        products[k, i, j] = totals[inner]
        products[k, j, i] = totals[inner]
        targets[k, cells[~inner] - size * size] = totals[~inner]
    return products / GRID**2, targets / GRID


def solve(products: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Ridge weights; the constant is not held back."""
    n = max(products[0, 0], 1.0)
    penalty = np.full(len(target), RIDGE * n)
    penalty[0] = 1e-9 * n
    return np.linalg.solve(products + np.diag(penalty), target)


def isotonic(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """The rising shares of good rows closest to good / (good + bad); steps without rows are NaN."""
    blocks: list[list[float]] = []
    for step in np.flatnonzero(good + bad):
        blocks.append([float(good[step]), float(good[step] + bad[step]), [step]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, n, steps = blocks.pop()
            blocks[-1][0] += g
            blocks[-1][1] += n
            blocks[-1][2] += steps
    value = np.full(len(good), np.nan)
    for g, n, steps in blocks:
        value[steps] = g / n
    return value


def _step_of(raw: np.ndarray) -> np.ndarray:
    """Raw scores lie around -1 (bad) to 1 (good)."""
    return np.clip(np.floor((raw + 1.5) / 3.0 * STEPS), 0, STEPS - 1).astype(np.int32)


def calibrate(examples: DataFrame, projection: Projection, by_fold: list) -> tuple:
    """Raw scores and their probabilities, from examples scored by the model of the other folds."""
    shared = share(examples.sparkSession, (projection, by_fold))

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        projection, by_fold = shared()
        counts = np.zeros((2, STEPS), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            stats = np.array(batch.column("stats").to_pylist(), dtype=np.float64)
            features = projection.features(stats)
            fold, good = batch.column("fold").to_numpy(), batch.column("good").to_numpy()
            for k in range(FOLDS):
                own = fold == k
                step = _step_of(raw_scores(features[own], by_fold[k]))
                np.add.at(counts, (good[own], step), 1)
        good, step = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(step.astype(np.int32)),
                pa.array(good.astype(np.int32)),
                pa.array(counts[good, step]),
            ],
            names=["step", "good", "n"],
        )

    found = (
        examples.select("stats", "good", "fold")
        .mapInArrow(run, "step int, good int, n long")
        .groupBy("step", "good")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros((2, STEPS))
    counts[found["good"].to_numpy(), found["step"].to_numpy()] = found["n"].to_numpy()
    value = isotonic(counts[1], counts[0])
    there = ~np.isnan(value)
    middle = (np.arange(STEPS) + 0.5) / STEPS * 3.0 - 1.5
    return middle[there], value[there]


def fit(stats: DataFrame, labels: DataFrame, ws: Workspace) -> Model:
    """`stats` as from with_statistics, written; the labels may be of any number."""
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(FOLDS)).cast("int")
    known = known_labels(labels)
    examples = stats.join(known, stats["doc_id"] == known["key"]).select(
        "stats", "good", fold.alias("fold")
    )
    examples = ws.materialize(examples, "examples")
    projection, n, good = standardize(examples)
    if not n or good in (0, n):
        share_of_good = good / n if n else 0.5
        return Model(None, None, np.zeros(1), np.array([share_of_good]))
    products, targets = normal_equations(examples, projection)
    by_fold = [
        solve(products.sum(axis=0) - products[k], targets.sum(axis=0) - targets[k])
        for k in range(FOLDS)
    ]
    at, value = calibrate(examples, projection, by_fold)
    return Model(projection, solve(products.sum(axis=0), targets.sum(axis=0)), at, value)


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score."""
    shared = share(stats.sparkSession, model)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            rows = np.array(batch.column("stats").to_pylist(), dtype=np.float64)
            score = model.probabilities(rows.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"]
            )

    return stats.mapInArrow(run, "doc_id long, score double")


def op11_quality_kernel(spark: SparkSession, folder: str) -> DataFrame:
    ws = Workspace(spark)
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    stats = ws.materialize(with_statistics(docs), "statistics")
    held_out = F.coalesce(remainder_of_id(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = read_table(spark, folder, "labels").select("doc_id", "quality").filter(~held_out)
    scored = score_statistics(stats, fit(stats, labels, ws))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
