import random
import re

import numpy as np
from conftest_llm import awkward_rows, prose

from ledgerloop.llm import quality
from ledgerloop.llm.common import OWN


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 8))
    return [len(words), sum(map(len, words)), symbols, repeats, len(covered)]


def test_counts_are_those_of_the_rules():
    rnd = random.Random(2)
    for n in [0, 1, 7, 8, 9, 15, 16, 17, 40, 90]:
        for letters in ("a", "ab", "abcd"):
            words = [rnd.choice(letters) + rnd.choice(["", "", "#", "é"]) for _ in range(n)]
            text = "".join(w + rnd.choice([" ", " ", "\n", "\t", "\x0b", "　 "]) for w in words)
            assert quality.statistics(text)[0] == plain_counts(text)
    for _, text, *_ in awkward_rows():
        if text is None or len(text) < 5000:
            assert quality.statistics(text)[0] == plain_counts(text)


def junk(k):
    return " ".join(w.upper() + "!!$$%" for w in prose(k, 60).split())


def test_junk_goes_and_clean_text_stays(spark, folder):
    rows = [(k, prose(k, 80), "en", "a", 0) for k in range(300)]
    rows += [(1000 + k, junk(k), "en", "a", 0) for k in range(60)]
    labels = [(k, 1, 0) for k in range(0, 300, 2)] + [(1000 + k, 0, 0) for k in range(0, 60, 2)]
    found = {r.doc_id: r for r in quality.op10_quality_rules(spark, folder(rows, labels)).collect()}
    assert sum(not found[k].kept for k in range(300)) <= 6
    assert sum(found[1000 + k].kept for k in range(60)) == 0
    assert not any(r.base_failed for r in found.values())


def test_held_out_accuracy_on_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    forest = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality.judge(docs, forest).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = judged.filter(f"not {OWN}base_failed").select("quality", f"{OWN}kept").collect()
    good = [r[1] for r in rows if r.quality == 1]
    bad = [r[1] for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_awkward_documents(spark, folder):
    rows = awkward_rows()
    for labels in ([], [(7, 1, 0), (7, 0, 0), (None, 1, 0), (9, None, 1), (8, 1, 0), (3, 1, 0)]):
        found = quality.op10_quality_rules(spark, folder(rows, labels, extra=True)).collect()
        assert len(found) == len(rows)
        by_id = {r.doc_id: r for r in found if r.doc_id is not None}
        assert by_id[0].base_failed and not by_id[0].kept and by_id[1].n_words == 0
        assert by_id[3].n_words == 30_000 and not by_id[3].base_failed
        assert all(not (r.base_failed and r.kept) for r in found)


def test_stage_keeps_columns(spark, folder):
    path = folder(awkward_rows(), extra=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = quality.stage(spark, docs, path)
    assert out.columns == docs.columns
    wanted = sorted(r.doc_id for r in quality.op10_quality_rules(spark, path).collect() if r.kept)
    assert sorted(r.doc_id for r in out.collect()) == wanted


def test_an_outlier_has_a_short_path():
    rows = np.random.default_rng(1).normal(size=(500, 3))
    scores = quality.Forest.grow(rows).scores(np.array([[0.0, 0, 0], [9, 9, 9]]))
    assert scores[1] > scores[0] + 0.2


def test_empty_tables(spark, folder):
    assert quality.op10_quality_rules(spark, folder()).collect() == []


def test_all_labelled_documents_set_the_threshold(spark, monkeypatch):
    """Far more labelled documents than any bound that was: every one is counted."""
    counted = []
    plain = quality.threshold_between

    def seen(bins, good, bad):
        counted.append((int(good.sum()), int(bad.sum())))
        return plain(bins, good, bad)

    monkeypatch.setattr(quality, "threshold_between", seen)
    rows = [(k, prose(k % 40, 25 + k % 5)) for k in range(11_000)]
    rows += [(20_000 + k, junk(k % 40)) for k in range(5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, int(k < 20_000)) for k, _ in rows], "doc_id long, quality int"
    )
    quality.fit(docs, labels)
    (good, bad), = counted
    assert (good, bad) == (11_000, 5_000)


def test_each_tree_draws_from_all_rows(spark):
    rows = spark.range(20_000).selectExpr("id key", "array(double(id)) ratios")
    draws = quality._draws(rows)
    assert [len(own) for own in draws] == [quality.TREE_ROWS] * quality.TREES
    drawn = {value for own in draws for value in own[:, 0].tolist()}
    assert len(drawn) > 12_000
