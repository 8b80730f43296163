import math
import zlib

import numpy as np
import pandas as pd
import pytest
from conftest_llm import awkward_rows, prose

from ledgerloop.llm import quality_kernel as q


def junk(seed: int, n: int) -> str:
    return " ".join(f"{w}$$$" for w in prose(seed, n).split())


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture
def labelled():
    rows = [(k, prose(k, 60 + k % 90), "en", "a", 0) for k in range(200)]
    rows += [(1000 + k, junk(k, 60 + k % 90), "en", "a", 0) for k in range(100)]
    marks = [(k, 1, 0) for k in range(0, 200, 2)] + [(1000 + k, 0, 0) for k in range(0, 100, 2)]
    return rows, marks


def test_held_out_rows_are_told_apart(spark, folder, labelled):
    rows, marks = labelled
    found = q.op11_quality_kernel(spark, folder(rows, marks)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == held_out(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.predicted == (r.doc_id < 1000)


def test_held_out_labels_are_never_read(spark, folder, labelled):
    rows, marks = labelled
    turned = [(d, 1 - good if held_out(d) else good, t) for d, good, t in marks]
    plain = sorted(q.op11_quality_kernel(spark, folder(rows, marks)).collect())
    assert plain == sorted(q.op11_quality_kernel(spark, folder(rows, turned)).collect())


def test_sums_and_scores_equal_those_of_plain_numpy(spark, folder, ws, labelled):
    """The sums over partitions, the ridge solution, the calibration and the scores, without Spark."""
    rows, marks = labelled
    path = folder(rows, marks)
    docs = spark.read.parquet(f"{path}/documents.parquet").repartition(7)
    labels = spark.read.parquet(f"{path}/labels.parquet")
    stats = ws.materialize(q.with_statistics(docs), "s")
    model = q.fit(stats, labels, ws)

    text, good = {r[0]: r[1] for r in rows}, {d: g for d, g, _ in marks}
    ids = sorted(good)
    plain = np.rint(np.array([q.statistics(text[d]) for d in ids]) * q.UNIT)
    projection = q.Projection.draw(plain.mean(axis=0), np.where(plain.std(axis=0) < 1, q.UNIT, plain.std(axis=0)))
    z = projection.features(plain) / q.GRID
    target = np.array([2 * good[d] - 1 for d in ids])
    penalty = np.eye(z.shape[1]) * q.RIDGE * len(ids)
    penalty[0, 0] = 1e-9 * len(ids)
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ target)
    # Statistics without spread divide rounding errors by a whole unit: equal up to such errors.
    assert np.allclose(z @ weights, q.raw_scores(model.projection.features(plain), model.weights), atol=1e-4)

    scored = {r.doc_id: r.score for r in q.score_statistics(stats, model).collect()}
    everyone = np.rint(np.array([q.statistics(r[1]) for r in rows]) * q.UNIT)
    assert np.allclose([scored[r[0]] for r in rows], model.probabilities(everyone))


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    stats = rng.standard_normal((40, len(q.STATISTICS)))
    projection = q.Projection.draw(np.zeros(stats.shape[1]), np.ones(stats.shape[1]), 20_000)
    z = projection.features(stats)[:, 1:] / q.GRID
    near = 2 * (z @ z.T) / 20_000
    gaps = ((stats[:, None] - stats[None]) ** 2).sum(axis=2)
    assert np.abs(near - np.exp(-gaps / (2 * q.WIDTH**2))).max() < 0.06


def brute_isotonic(good, bad):
    """max over i<=k of min over j>=k of the share of good rows in i..j."""
    there = np.flatnonzero(good + bad)
    value = np.full(len(good), np.nan)
    for k in there:
        value[k] = max(
            min(
                good[i : j + 1].sum() / (good[i : j + 1] + bad[i : j + 1]).sum()
                for j in there[there >= k]
            )
            for i in there[there <= k]
        )
    return value


def test_isotonic_equals_the_min_max_formula():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 30):
        good, bad = rng.integers(0, 5, n), rng.integers(0, 5, n)
        assert np.allclose(q.isotonic(good, bad), brute_isotonic(good, bad), equal_nan=True)


def test_awkward_rows_labels_and_reruns(spark, folder):
    marks = [(3, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, 0), (7, 3, 1), (None, 1, 0), (11, 0, 0), (8, 1, 0)]
    path = folder(awkward_rows(), marks, extra=True)
    found = q.op11_quality_kernel(spark, path).toPandas()
    assert found.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    assert len(found) == len(awkward_rows())
    assert found["score"].between(0, 1).all()
    same = found[found["doc_id"] == 5]["score"]
    assert len(same) == 2 and same.nunique() == 1
    again = q.op11_quality_kernel(spark, path).toPandas()
    order = ["doc_id", "score"]
    pd.testing.assert_frame_equal(
        found.sort_values(order).reset_index(drop=True), again.sort_values(order).reset_index(drop=True)
    )


@pytest.mark.parametrize("marks, score", [([], 0.5), ([(7, 1, 0), (11, 1, 0)], 1.0), ([(11, 0, 0)], 0.0)])
def test_labels_of_one_kind_or_none(spark, folder, marks, score):
    found = q.op11_quality_kernel(spark, folder(awkward_rows(), marks)).collect()
    assert {r.score for r in found} == {score}


def test_empty_tables(spark, folder):
    assert q.op11_quality_kernel(spark, folder()).collect() == []


def test_statistics_of_plain_texts():
    names = dict(zip(q.STATISTICS, q.statistics("AB ab ab\n\nAB ab ab\n")))
    assert names["words"] == math.log1p(6)
    assert names["upper"] == 4 / 12
    assert names["same_neighbours"] == 2 / 6
    assert names["dup_lines"] == 0.5
    assert names["repeated_pairs"] == 1 - 3 / 5
    assert q.statistics(None) == q.statistics("")
    assert names["word_length"] == math.log1p(2)
