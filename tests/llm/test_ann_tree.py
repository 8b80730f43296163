import math

import numpy as np
from ledgerloop.llm import ann_tree


def vectors(n=3000, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(30, dim))
    return (middles[rng.integers(30, size=n)] + 0.3 * rng.normal(size=(n, dim))).astype("f4")


def truth(rows, k=10):
    fine = [
        (i, np.array(v, dtype=float))
        for i, v in rows
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    size = max({len(v) for _, v in fine}, key=lambda d: sum(len(v) == d for _, v in fine))
    fine = [(i, v) for i, v in fine if len(v) == size and v.any()]
    ids = np.array([i for i, _ in fine])
    x = np.array([v for _, v in fine])
    out = {}
    for i, q in fine:
        if i % 100 == 0:
            d = np.sqrt(((x - q) ** 2).sum(axis=1))
            best = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(d[j])) for j in best]
    return out


def check(found, wanted):
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == wanted.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    for q in got:
        exact = dict(wanted[q])
        assert got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        assert len(got[q]) == len(wanted[q])
        for i, score in got[q]:
            assert i not in exact or math.isclose(score, exact[i], rel_tol=1e-12)
    return hits / max(1, sum(map(len, wanted.values())))


def table(x):
    return [(k, [float(c) for c in v], 0) for k, v in enumerate(x)]


def test_recall_of_clustered_vectors(spark, folder):
    rows = table(vectors())
    found = ann_tree.op4_ann_tree(spark, folder(vectors=rows)).collect()
    assert check(found, truth([r[:2] for r in rows])) >= 0.9


def test_recall_on_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    table_ = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    found = ann_tree.op4_ann_tree(spark, folder).collect()
    assert check(found, truth([(r.vec_id, r.embedding) for r in table_])) >= 0.9


def test_ties_and_a_large_group_of_equal_vectors(spark, folder, monkeypatch):
    monkeypatch.setattr(ann_tree, "BLOCK_NUMBERS", 50 * 16)
    x = vectors(900)
    x[::3] = x[0]
    rows = table(x)
    found = ann_tree.op4_ann_tree(spark, folder(vectors=rows)).collect()
    wanted = truth([r[:2] for r in rows])
    assert check(found, wanted) >= 0.9
    of_zero = [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0]
    assert of_zero == [i for i, _ in wanted[0]] == list(range(3, 33, 3))


def test_vectors_that_take_no_part(spark, folder):
    rows = table(vectors(30, 4)) + [
        (100, None, 0),
        (200, [0.0] * 4, 0),
        (300, [1.0, None, 0.0, 0.0], 0),
        (400, [1.0, float("nan"), 0.0, 0.0], 0),
        (500, [1.0, float("inf"), 0.0, 0.0], 0),
        (600, [1.0], 0),
        (700, [], 0),
        (None, [1.0, 2.0, 3.0, 4.0], 0),
        (800, [1.0, 2.0, 3.0, 4.0], None),
        (800, [1.0, 2.0, 3.0, 4.0], None),
    ]
    found = ann_tree.op4_ann_tree(spark, folder(vectors=rows, extra=True)).collect()
    assert {r.query_id for r in found} == {0, 800}
    assert {r.vec_id for r in found} <= {*range(30), 800}
    # two rows share the id 800: both are queries and neither finds the other
    assert sum(r.query_id == 800 for r in found) == 20
    assert all(r.vec_id != r.query_id for r in found)


def test_few_vectors_are_all_found(spark, folder):
    rows = table(vectors(4))
    found = ann_tree.op4_ann_tree(spark, folder(vectors=rows)).collect()
    assert check(found, truth([r[:2] for r in rows])) == 1.0 and len(found) == 3


def test_empty_table(spark, folder):
    assert ann_tree.op4_ann_tree(spark, folder()).collect() == []


def test_queries_in_small_leaves_find_ten_rows(spark, folder, monkeypatch):
    # What calibration gives where nearly all queries lie in tight clusters.
    monkeypatch.setattr(ann_tree, "calibrate", lambda *_: 1)
    rng = np.random.default_rng(3)
    x = np.repeat(50 * rng.normal(size=(40, 8)), 50, axis=0) + 1e-3 * rng.normal(size=(2000, 8))
    # Queries far from all others, one of them under an id that twelve equal rows have.
    x[[100, 700, 1500]] = 1e4 * np.eye(8)[:3]
    rows = table(x) + [(700, [float(c) for c in x[700]], 0)] * 11
    found = ann_tree.op4_ann_tree(spark, folder(vectors=rows)).collect()
    counts = {}
    for r in found:
        counts[r.query_id] = counts.get(r.query_id, 0) + 1
    assert counts == {q: 120 if q == 700 else 10 for q in range(0, 2000, 100)}
    assert all(r.vec_id != r.query_id for r in found)
