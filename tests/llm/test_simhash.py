import random

import numpy as np
import pytest
import xxhash
from conftest_llm import awkward_rows, prose

from ledgerloop.llm import simhash
from ledgerloop.llm.components import components
from ledgerloop.llm.common import Workspace


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits=4):
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                a_, b_ = root(i), root(j)
                parent[max(a_, b_)] = min(a_, b_)
    return [root(k) for k in range(len(prints))]


def expected(rows):
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    groups = plain_groups(prints)
    least = {}
    for (doc_id, *_), g in zip(rows, groups):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(r[0], f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, groups)]


def test_awkward_documents(spark, folder):
    rows = awkward_rows() + [
        (1000 + k, prose(7, 200).replace(f"w{k}", "x"), "en", "a", 0) for k in range(60)
    ]
    found = simhash.op5_simhash(spark, folder(rows, extra=True)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected(rows), key=repr)


def clustered(seed, n):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(max(2, n // 50))]
    out = set()
    while len(out) < n:
        x = rnd.choice(base)
        for _ in range(rnd.randrange(12)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [20, 200_000])
def test_links_are_those_of_all_pairs(spark, ws, shard_rows, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 16)
    prints = clustered(3, 700)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = ws.materialize(spark.createDataFrame([(x,) for x in signed], "fp long"), "prints")
    found = simhash.link_fingerprints(df, ws, 4, shard_rows).collect()
    root = {r.node: r.root for r in found}
    wanted = plain_groups(prints)
    got = {}
    for x, g in zip(signed, wanted):
        assert got.setdefault(g, root.get(x, x)) == root.get(x, x)
    assert len(set(got.values())) == len(got)


def test_upper_tree_brings_every_close_pair_together():
    prints = np.array(clustered(5, 400), dtype=np.uint64)
    row, leaf = simhash.UpperTree(prints, 4).places(prints, 4)
    at = [set(leaf[row == k].tolist()) for k in range(len(prints))]
    for i in range(len(prints)):
        for j in range(i):
            if int(prints[i] ^ prints[j]).bit_count() <= 4:
                assert at[i] & at[j]


def test_a_hot_shard_is_searched_by_its_tree():
    prints = np.array(clustered(9, 900), dtype=np.uint64)
    a, b = simhash.shard_links(np.zeros(len(prints), np.int64), prints, 4)
    label = simhash.local_components(len(prints), a, b)
    assert label.tolist() == plain_groups([int(x) for x in prints])
    assert len(a) < len(prints)


def test_components_of_a_long_chain_and_a_star(spark, ws):
    chain = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)]
    random.Random(1).shuffle(chain)
    found = components(spark.createDataFrame(chain, "a long, b long"), ws).collect()
    root = {r.node: r.root for r in found}
    assert {root[k] for k in range(201)} == {0}
    assert {root[1000 + k] for k in range(300)} == {1000}


def test_stage_keeps_one_of_each_group(spark, folder):
    rows = awkward_rows()
    path = folder(rows, extra=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = simhash.stage(spark, docs, path)
    assert out.columns == docs.columns
    kept = sorted((r.doc_id for r in out.collect()), key=repr)
    named = {g for _, _, g in expected(rows) if g is not None}
    alone = [r for r in expected(rows) if r[2] is None]
    assert kept == sorted([*named, *[None] * len({r[1] for r in alone})], key=repr)


def test_stage_keeps_a_row_of_each_group_where_an_id_repeats(spark, folder):
    # One id with six texts, each in a group of its own with a later copy; rows that differ only
    # in their source; one text of an id that another group has as well.
    rows = [(1, prose(k, 80), "en", "b", 0) for k in range(6)]
    rows += [(10 + k, prose(k, 80), "en", "b", 0) for k in range(6)]
    rows += [(2, prose(50, 80), "en", source, 0) for source in "cab"]
    rows += [(3, prose(51, 80), "en", "a", 0), (3, prose(0, 80), "en", "a", 0)]
    for given in (rows, rows[::-1]):
        path = folder(given)
        docs = spark.read.parquet(f"{path}/documents.parquet")
        out = simhash.stage(spark, docs, path).collect()
        wanted = [(1, prose(k, 80), "b") for k in range(6)]
        wanted += [(2, prose(50, 80), "a"), (3, prose(51, 80), "a")]
        assert sorted((r.doc_id, r.text, r.source) for r in out) == sorted(wanted)


def test_empty_table(spark, folder):
    assert simhash.op5_simhash(spark, folder()).collect() == []
