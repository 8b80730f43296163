import random

import numpy as np
import pytest
from conftest_llm import awkward_rows, prose

from ledgerloop.llm import chunks, substrings


def overlapping(n=60):
    rnd = random.Random(6)
    passages = [prose(900 + k, 40).split() for k in range(6)]
    rows = []
    for k in range(n):
        words = prose(k, rnd.randrange(5, 80)).split()
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) - 13)
            cut = p[a : a + rnd.randrange(11, 30)]
            at = rnd.randrange(len(words) + 1)
            words[at:at] = cut
        rows.append((rnd.randrange(10_000), " ".join(words), "en", "a", 0))
    # few words, so that windows repeat within a document too
    rows += [(20_000 + k, " ".join(rnd.choice("ab") for _ in range(90)), "", "", 0) for k in range(9)]
    return rows


@pytest.mark.parametrize("chars", [300, 4_000_000])
def test_same_as_sql(folder, same_as_sql, monkeypatch, chars):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", chars)
    path = folder(overlapping() + awkward_rows(), extra=True)
    found = same_as_sql(substrings.op7_substrings, substrings.ORACLE, path)
    assert found["n_removed"].sum() > 100


def test_a_large_group_of_copies(folder, same_as_sql, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", 2_000)
    rows = [(k, prose(1, 60) + f" own{k}", "en", "a", 0) for k in range(80)]
    found = same_as_sql(substrings.op7_substrings, substrings.ORACLE, folder(rows))
    assert (found["n_removed"] > 0).sum() == 79


def test_given_tables(same_as_sql):
    same_as_sql(substrings.op7_substrings, substrings.ORACLE, "/root/testdata/sf0.001")


def test_prefixes_grow_where_groups_are_large():
    rnd = random.Random(2)
    suffixes = [" ".join(rnd.choice("ab") for _ in range(13)).encode() for _ in range(500)]
    docs = np.array([rnd.randrange(1000) for _ in suffixes])
    wanted = {}
    for s, d in zip(suffixes, docs.tolist()):
        wanted[s] = min(wanted.get(s, d), d)
    groups = list(substrings.subtrees(suffixes, 20))
    assert len(groups) > 10 and sorted(k for g in groups for k in g) == list(range(500))
    for group in (20, 10_000):
        least = substrings.smallest_documents(suffixes, docs, group)
        assert least.tolist() == [wanted[s] for s in suffixes]


def _anchor_phrase() -> str:
    """Five words that are the anchor of all windows over them, whatever stands around."""
    for k in range(20_000):
        phrase = [f"p{k}w{j}" for j in range(5)]
        words, n = [], []
        for c in range(20):
            own = [*[f"a{c}x{j}" for j in range(12)], *phrase, *[f"b{c}x{j}" for j in range(12)]]
            words += own
            n.append(len(own))
        encoded = [w.encode() for w in words]
        lengths, offsets = substrings._passages(encoded, np.array(n))
        if sum((lengths == 9) & (offsets == 8)) == 20:
            return " ".join(phrase)
    raise AssertionError


def test_windows_of_a_hot_anchor_do_not_meet_in_one_bucket(folder, same_as_sql, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", 2_000)
    monkeypatch.setattr(substrings, "HOT", 20, raising=False)
    phrase, asked, whole = _anchor_phrase(), [], substrings.per_bucket

    def spy(questions, *rest):
        asked.append([(r.bucket, r.content) for r in questions.collect()])
        return whole(questions, *rest)

    monkeypatch.setattr(substrings, "per_bucket", spy)
    rows = []
    for k in range(200):
        around = [" ".join(f"{side}{k % 150}x{j}" for j in range(12)) for side in "ab"]
        rows.append((k, f"{around[0]} {phrase} {around[1]}", "en", "a", 0))
    found = same_as_sql(substrings.op7_substrings, substrings.ORACLE, folder(rows))
    assert (found["n_removed"] > 0).sum() == 50
    windows: dict = {}
    for bucket, content in asked[1]:
        _, own, _ = chunks.unpack(chunks.unpack(content))
        windows[bucket] = windows.get(bucket, 0) + int(own.sum())
    assert sum(windows.values()) > 1_500
    assert max(windows.values()) < 0.4 * sum(windows.values())


def test_same_as_sql_where_all_anchors_are_hot(folder, same_as_sql, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", 300)
    monkeypatch.setattr(substrings, "HOT", 0, raising=False)
    path = folder(overlapping() + awkward_rows(), extra=True)
    found = same_as_sql(substrings.op7_substrings, substrings.ORACLE, path)
    assert found["n_removed"].sum() > 100


def brute_force(rows, window):
    """Kept words and removed spans of rows (doc_id, text); ids are unique."""
    least: dict = {}
    texts = {k: [w.decode() for w in (t or "").encode().split()] for k, t in rows}
    for k in sorted(texts, reverse=True):
        for p in range(len(texts[k]) - window + 1):
            least[tuple(texts[k][p : p + window])] = k
    found = {}
    for k, words in texts.items():
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if least[tuple(words[p : p + window])] < k:
                gone[p : p + window] = [True] * window
        edges = [p for p in range(len(words) + 1) if [False, *gone, False][p] != [*gone, False][p]]
        spans = list(zip(edges[::2], edges[1::2]))
        found[k] = (len(words), " ".join(w for w, g in zip(words, gone) if not g), spans)
    return found


@pytest.mark.parametrize("window", [5, 7, 20, 300])
def test_kept_texts_and_spans_for_other_windows(spark, folder, ws, monkeypatch, window):
    monkeypatch.setattr(chunks, "CHUNK_CHARS", 3_000)
    rows = [(k, row[1], *row[2:]) for k, row in enumerate(overlapping(40))]
    shared = prose(77, 400)
    rows += [(1000 + k, f"own{k} {shared} été{k} \t\n", "en", "a", 0) for k in range(3)]
    rows += [(2000, "", "en", "a", 0), (2001, None, "en", "a", 0)]
    docs = spark.read.parquet(f"{folder(rows)}/documents.parquet")
    found = substrings.remove_repeats(docs, ws, window).collect()
    got = {r.doc_id: (r.n_words, r.kept, [tuple(s) for s in r.spans]) for r in found}
    assert got == brute_force([r[:2] for r in rows], window)
    # a repeat much longer than a window is one span
    assert got[1001][2] == got[1002][2] == [(1, 401)]


def test_a_window_holds_an_anchor(spark, folder, ws):
    docs = spark.read.parquet(f"{folder()}/documents.parquet")
    with pytest.raises(ValueError, match="at least 5 words"):
        substrings.remove_repeats(docs, ws, 4)


def test_empty_table(spark, folder):
    assert substrings.op7_substrings(spark, folder()).collect() == []
