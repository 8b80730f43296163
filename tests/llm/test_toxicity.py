import zlib

import numpy as np
from conftest_llm import awkward_rows, prose

from ledgerloop.llm import toxicity


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_documents_of_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    found = toxicity.op3_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").toPandas()
    assert auc(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.9
    hits = rows[rows["toxic"] == 1]["predicted"].mean()
    alarms = rows[rows["toxic"] == 0]["predicted"].mean()
    assert hits > 0.75 and alarms < 0.01


def planted(n=240):
    rows, labels = [], []
    for k in range(n):
        toxic = k % 3 == 0
        text = ". ".join(prose(10 * k + j, 12) for j in range(6))
        if toxic:
            text += ". You utter blockhead fool. " + prose(k, 10)
        rows.append((k, text, "en", "a", 0))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_offending_sentences_are_located(spark, folder):
    rows, labels = planted()
    found = toxicity.op3_toxicity(spark, folder(rows, labels)).collect()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == (r.doc_id % 3 == 0) == (r.score >= 0.7)
        assert [s.sentence for s in r.offending] == ([6] if r.predicted else [])


def test_labels_of_held_out_rows_are_not_seen(spark, folder):
    rows, labels = planted(120)
    other = [
        (i, q, 1 - t) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels
    ]
    runs = [toxicity.op3_toxicity(spark, folder(rows, own)).collect() for own in (labels, other)]
    assert sorted(map(str, runs[0])) == sorted(map(str, runs[1]))


def test_noisy_or():
    model = toxicity.Model({"bad": 3.0}, bias=-2.0)
    scores = model.sentence_scores("Good one. Bad one! Fine")
    assert np.allclose(scores, 1 / (1 + np.exp([2.0, -1.0, 2.0])))
    assert np.isclose(model.score(scores), 1 - np.prod(1 - np.array(scores)))


def test_awkward_documents(spark, folder):
    rows, labels = planted(60)
    labels += [(None, 1, 1), (0, 1, 0), (5, None, None)]
    path = folder(awkward_rows() + [(r[0] + 500, *r[1:]) for r in rows], labels, extra=True)
    found = toxicity.op3_toxicity(spark, path).collect()
    assert len(found) == len(awkward_rows()) + len(rows)
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in found)
    assert all(r.score == 0 for r in found if r.doc_id in (0, 1, 2))


def test_empty_tables(spark, folder):
    assert toxicity.op3_toxicity(spark, folder()).collect() == []
    rows, _ = planted(4)
    assert all(r.score == 0 for r in toxicity.op3_toxicity(spark, folder(rows)).collect())


def test_sentences_that_are_toxic_together_only():
    model = toxicity.Model({}, bias=-5.0, power=0.5)
    sure = toxicity.THRESHOLD ** (1 / model.power)
    assert toxicity.locate(model, [0.1, 0.3, 0.2, 0.25], sure) == [1, 2, 3]
    assert toxicity.locate(model, [0.1, 0.6, 0.2], sure) == [1]
    assert toxicity.locate(model, [0.1, 0.1], sure) == []


def test_every_flagged_document_has_a_sentence(spark):
    found = toxicity.op3_toxicity(spark, "/root/testdata/sf0.1").filter("predicted = 1")
    rows = found.select("doc_id", "offending").collect()
    assert rows and all(r.offending for r in rows)
