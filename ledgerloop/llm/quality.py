"""Quality rules judged by an isolation forest.

Each text gives counts (the rules) and ratios of them.  Random splits isolate an unusual document
after few steps, so its path through the trees is short.  As the method has it, each tree is grown on
TREE_ROWS rows; every tree draws its own from all documents labelled as good, or from all documents
when no label exists.  The score is 2^(-mean path / expected path) as usual.  The threshold on it is
the one that separates the labelled good from the labelled bad documents best, good documents that
would go counting `GOOD_WEIGHT` times; without labels of both kinds the forest rejects nothing.
All labelled documents are counted for it, by BINS steps of the score.  Each half of the trees draws
from one half of the good documents, which the threshold sees with the score of the other trees: no
row is judged by its own tree.

Two plain rules come first: too few words, or too many words in repeated windows.

A null text counts as empty and fails the first rule.  Texts are read whole, whatever their length.  Rows
that repeat are judged alike.  A score at the threshold is kept.  An empty table gives an empty result.
Stages pass on other columns, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloop.llm.common import OWN, Workspace, any_columns, read_table, share

#: Steps of the score between which the threshold is chosen.
BINS = 1 << 16
TREES = 100
HALF = TREES // 2
#: Splits also fall beside the rows of a node, by this share of their range: rows beyond all that
#: trees have drawn are then isolated before the outermost that they have.
BESIDE = 0.5
TREE_ROWS = 256
#: A good document lost weighs as much as this many bad documents kept.
GOOD_WEIGHT = 10.0
SEED = 20

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKS = re.compile(r"[!?#*$%&|<>{}\[\]=~^_\\/@]")


def _repeated(words: list[bytes], window: int) -> int:
    """Words in windows that occur more than once, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    # Ranks of runs of 1, 2, 4 ... words; the last step overlaps to reach the window exactly.
    size, count = 1, len(numbers)
    while size < window:
        step = min(size, window - size)
        pairs = ids[: len(ids) - step] * count + ids[step:]
        _, ids = np.unique(pairs, return_inverse=True)
        size += step
        count = int(ids.max()) + 1
        if count == len(ids):
            return 0
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of COUNTS and the ratios that the forest looks at.  Null is an empty text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    joined = b"".join(words).decode()
    chars = len(joined)
    symbols = chars - len(joined.translate(_SYMBOLS))
    lines = [line for line in text.split("\n") if line.encode().split()]
    dup_lines = len(lines) - len(set(lines))
    repeated = _repeated(words, WINDOW)
    counts = [n, chars, symbols, dup_lines, repeated]
    per_word, per_char = 1 / max(n, 1), 1 / max(chars, 1)
    same = sum(map(bytes.__eq__, words, words[1:]))
    ratios = [
        chars * per_word,
        symbols * per_char,
        same * per_word,
        max(0, 100 * repeated - MAX_REPEATED_PERCENT * n // 2) * per_word / 100,
        len(_UPPER.findall(joined)) * per_char,
        len(_MARKS.findall(joined)) * per_char,
    ]
    return counts, ratios


def expected_path(n: float) -> float:
    """The mean path of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), split value, children, and the path of each leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    expected: float
    threshold: float = math.inf

    @classmethod
    def grow(cls, rows: np.ndarray, seed: int = SEED) -> Forest:
        """Trees that each draw from the same rows."""
        rng = np.random.default_rng(seed)
        take = min(TREE_ROWS, len(rows))
        return cls.of_draws(
            [rows[rng.choice(len(rows), take, replace=False)] for _ in range(TREES)], seed
        )

    @classmethod
    def of_draws(cls, draws: list[np.ndarray], seed: int = SEED) -> Forest:
        """One tree per draw."""
        rng = np.random.default_rng(seed)
        nodes: list[list[float]] = []

        def node(own: np.ndarray, level: int, depth: int) -> int:
            k = len(nodes)
            nodes.append([-1, 0.0, 0, 0, level + expected_path(len(own))])
            if level == depth or len(own) < 2:
                return k
            low, high = own.min(axis=0), own.max(axis=0)
            wide = np.flatnonzero(high > low)
            if len(wide):
                feature = int(rng.choice(wide))
                beside = BESIDE * (high[feature] - low[feature])
                value = float(rng.uniform(low[feature] - beside, high[feature] + beside))
                below = own[:, feature] <= value
                a, b = (node(own[side], level + 1, depth) for side in (below, ~below))
                nodes[k][:4] = [feature, value, a, b]
            return k

        roots = [node(own, 0, max(1, math.ceil(math.log2(max(len(own), 2))))) for own in draws]
        expected = float(np.mean([expected_path(len(own)) for own in draws]))
        f, v, a, b, p = map(np.array, zip(*nodes))
        whole = [x.astype(np.int64) for x in (f, a, b)]
        return cls(whole[0], v, whole[1], whole[2], p, np.array(roots), expected)

    def scores(self, rows: np.ndarray, trees: slice = slice(None)) -> np.ndarray:
        """Near 1: isolated at once; 0.5 and below: ordinary."""
        paths = np.zeros(len(rows))
        roots = self.roots[trees]
        for root in roots:
            at = np.full(len(rows), root)
            inner = np.flatnonzero(self.feature[at] >= 0)
            while len(inner):
                here = at[inner]
                go_left = rows[inner, self.feature[here]] <= self.value[here]
                at[inner] = np.where(go_left, self.left[here], self.right[here])
                inner = inner[self.feature[at[inner]] >= 0]
            paths += self.path[at]
        return 2.0 ** -(paths / len(roots) / max(self.expected, 1e-9))


def threshold_between(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The score above which to reject, from the numbers of good and bad rows in ascending bins of
    the score; a good row lost costs GOOD_WEIGHT times a bad one kept, each as a share of its kind.
    Infinite without rows of both kinds."""
    if not good.sum() or not bad.sum():
        return math.inf
    cuts = np.append((bins[:-1] + 1 + bins[1:]) / 2 / BINS, np.inf)
    lost = 1 - np.cumsum(good) / good.sum()
    kept = np.cumsum(bad) / bad.sum()
    cost = GOOD_WEIGHT * lost + kept
    return float(cuts[int(np.argmin(cost))])


def _base_failed(counts: list[int]) -> bool:
    return counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEATED_PERCENT * counts[0]


RATIO_ROWS = "key long, ratios array<double>"


def _ratio_rows(batches: Iterator) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(text) for text in batch.column("text").to_pylist()]
        keep = [k for k, (counts, _) in enumerate(found) if not _base_failed(counts)]
        ratios = pa.array([found[k][1] for k in keep], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key").take(keep), ratios], names=["key", "ratios"]
        )


def _draws(rows: DataFrame, trees: range = range(TREES)) -> list[np.ndarray]:
    """For each tree the TREE_ROWS of all `rows` that a hash of key and tree puts first."""
    trees_of_row = F.sequence(F.lit(trees.start), F.lit(trees.stop - 1))
    hashed = rows.select(F.explode(trees_of_row).alias("tree"), "key", "ratios").withColumn(
        "drawn", F.xxhash64("key", "tree", F.lit(SEED))
    )
    first = Window.partitionBy("tree").orderBy("drawn", "key", "ratios")
    chosen = hashed.withColumn("place", F.row_number().over(first)).where(
        F.col("place") <= TREE_ROWS
    )
    draws: dict[int, list] = {tree: [] for tree in trees}
    for row in chosen.orderBy("tree", "place").select("tree", "ratios").collect():
        draws[row.tree].append(row.ratios)
    return [np.array(own) for own in draws.values() if own]


def _counted_scores(rows: DataFrame, forest: Forest) -> tuple[np.ndarray, ...]:
    """Bins of the score in order, and the good and bad rows in each.  `side` tells which trees judge
    a row: those of the first half, of the second, or all."""
    shared = share(rows.sparkSession, forest)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            if not batch.num_rows:
                continue
            ratios = np.array(batch.column("ratios").to_pylist())
            side = batch.column("side").to_numpy()
            score = np.zeros(len(ratios))
            for k, trees in enumerate((slice(HALF), slice(HALF, None), slice(None))):
                score[side == k] = model.scores(ratios[side == k], trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), pa.array((score * BINS).astype(np.int64))],
                names=["good", "bin"],
            )

    counted = (
        rows.select("good", "ratios", "side")
        .mapInArrow(run, "good int, bin long")
        .groupBy("bin")
        .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
        .collect()
    )
    found = np.array(sorted(tuple(r) for r in counted), dtype=np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def fit(docs: DataFrame, labels: DataFrame | None) -> Forest | None:
    """The forest and its threshold from all labelled documents; None where there is nothing to
    learn from.  Labels that are null or contradict each other are not used."""
    ws = Workspace(docs.sparkSession)
    # Labels are joined to ratios, so that no text is shuffled.
    text = docs.select(F.col("doc_id").cast("long").alias("key"), "text")
    ratios = text.mapInArrow(_ratio_rows, RATIO_ROWS)
    if labels is not None:
        known = (
            labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
            .groupBy(F.col("doc_id").cast("long").alias("key"))
            .agg(F.min("quality").cast("int").alias("good"), F.max("quality").alias("most"))
            .filter("good = most")
            .select("key", "good")
        )
        rows = ws.materialize(ratios.join(known, "key"), "labelled-ratios")
        good, bad = rows.filter("good = 1"), rows.filter("good = 0")
        half = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(2)).cast("int")
        one = _draws(good.filter(half == 0), range(HALF))
        two = _draws(good.filter(half == 1), range(HALF, TREES))
        draws, side = one + two, 1 - half
        if not one or not two:
            draws, side = _draws(good), F.lit(2)
        if draws:
            forest = Forest.of_draws(draws)
            judged = good.withColumn("side", side).unionByName(bad.withColumn("side", F.lit(2)))
            forest.threshold = threshold_between(*_counted_scores(judged, forest))
            return forest
    draws = _draws(ws.materialize(ratios, "all-ratios"))
    return Forest.of_draws(draws) if draws else None


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """All columns of `docs` and, under names that start with OWN, the counts, base_failed, score
    and kept.  An empty or null text has no words and so fails the first rule."""
    shared = share(docs.sparkSession, forest)
    added = {f"{OWN}{name}": "long" for name in COUNTS}
    added |= {f"{OWN}base_failed": "boolean", f"{OWN}score": "double", f"{OWN}kept": "boolean"}
    schema = T.StructType(docs.schema.fields[:])
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in batches:
            found = [statistics(text) for text in batch.column("text").to_pylist()]
            failed = np.array([_base_failed(counts) for counts, _ in found], dtype=bool)
            if model is None or not found:
                score = np.zeros(len(found))
            else:
                score = model.scores(np.array([ratios for _, ratios in found]))
            kept = ~failed & (score <= (math.inf if model is None else model.threshold))
            counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    *[pa.array(counts[:, k]) for k in range(len(COUNTS))],
                    pa.array(failed),
                    pa.array(score),
                    pa.array(kept),
                ],
                names=[*batch.schema.names, *added],
            )

    return docs.mapInArrow(run, schema)


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "labels").select("doc_id", "quality")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    judged = judge(docs, fit(docs, _labels(spark, folder)))
    return judged.select(
        "doc_id",
        *[F.col(f"{OWN}{name}").alias(name) for name in (*COUNTS, "base_failed", "kept", "score")],
    )


@any_columns
def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the rules and the forest keep, unchanged."""
    judged = judge(docs, fit(docs, _labels(spark, folder)))
    return judged.filter(F.col(f"{OWN}kept")).select(*docs.columns)
