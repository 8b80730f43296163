import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import awkward_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloop.llm import collocations as c


def brute(rows, top=c.TOP):
    words, grams, n = Counter(), Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            found = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(found)
            words.update((lang, w) for w in found)
            for size in (2, 3):
                grams.update((lang, *found[k : k + size]) for k in range(len(found) - size + 1))

    def f(lang, part):
        return words[lang, part[0]] if len(part) == 1 else grams[(lang, *part)]

    often = {g: a for g, a in grams.items() if a >= 10}
    longest = Counter()
    for g, a in often.items():
        if len(g) == 4:
            for inner in ((g[0], g[1], g[2]), (g[0], g[2], g[3])):
                longest[inner] = max(longest[inner], a)
    result = []
    for g, a in often.items():
        if 100 * longest[g] >= 50 * a:
            continue
        cuts = []
        for k in range(1, len(g) - 1):
            left, right = f(g[0], g[1 : 1 + k]), f(g[0], g[1 + k :])
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        result.append((g[0], " ".join(g[1:]), a, left, right, n[g[0]], score))
    ranked = []
    for lang in {r[0] for r in result}:
        own = sorted(
            (r for r in result if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode())
        )
        ranked += [(r[0], k + 1, *r[1:]) for k, r in enumerate(own[:top])]
    return sorted(ranked)


def rows_with_phrases() -> list[tuple]:
    rnd = random.Random(3)
    stems = ["New York City", "of the", "in spite of", "a\x01b c", "a b", "Été chaud", "x, y z"]
    rows = []
    for k in range(120):
        words = [rnd.choice((*stems, prose(rnd.randrange(50), 3))) for _ in range(40)]
        rows.append((k, rnd.choice((" ", "  ", "\t", " ")).join(words), rnd.choice(("en", "de", None, "und")), "a", 0))
    return rows + awkward_rows()


def as_rows(found):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


def test_equals_brute_force(spark, folder):
    rows = rows_with_phrases()
    wanted = brute(rows)
    assert len(wanted) > 100 and any(len(r[2].split(" ")) == 3 for r in wanted)
    assert as_rows(c.op13_collocations(spark, folder(rows, extra=True))) == wanted


def test_equals_sql(spark, same_as_sql, folder):
    same_as_sql(c.op13_collocations, c.ORACLE, "/root/testdata/sf0.001")
    same_as_sql(c.op13_collocations, c.ORACLE, folder(rows_with_phrases()))


@pytest.mark.parametrize("merge_entries, fan_bits, shard", [(50, 2, 300), (1000, 3, 40), (10, 8, 10**6)])
def test_any_cut_into_shards_and_slices(spark, folder, ws, monkeypatch, merge_entries, fan_bits, shard):
    """Several levels of merges, many shards."""
    rows = rows_with_phrases()
    docs = spark.read.parquet(f"{folder(rows)}/documents.parquet").repartition(3)
    monkeypatch.setattr(c, "SHARD_WORDS", shard)
    words, phrases, totals = c.count_phrases(docs, ws, merge_entries, fan_bits)
    best = c.top_phrases(c.score_phrases(words, phrases, ws), 20).join(totals, "lang")
    assert as_rows(best) == brute(rows, 20)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 2**32 - 1), st.integers(0, 2**32), st.integers(1, 200))
def test_packing_is_undone_and_filters_are_lossless(most, seed, n):
    layout = c.Layout.of(most)
    rng = np.random.default_rng(seed)
    a, b, d = (rng.integers(low, most, n, endpoint=True) for low in (1, 1, 0))
    a, b, d = (np.concatenate([x, x[: n // 2], x[: n // 3]]) for x in (a, b, d))
    count = rng.integers(1, 1000, len(a))
    quotient, remainder = layout.pack(a, b, d)
    assert all((x == y).all() for x, y in zip(layout.unpack(quotient, remainder), (a, b, d)))
    wanted = Counter()
    for x, y, z, k in zip(a, b, d, count):
        wanted[x, y, z] += k
    whole = c.Filter.merged(layout, quotient, remainder, count)
    bits = min(3, layout.quotient_bits)
    parts = [c.Filter.from_bytes(layout, own.to_bytes()) for _, own in whole.slices(bits)]
    assert sum(map(len, parts)) == len(whole) == len(wanted)
    again = c.Filter.union(layout, [p.to_bytes() for p in parts])
    found = zip(*layout.unpack(again.quotient, again.remainder), again.count)
    assert {(x, y, z): k for x, y, z, k in found} == wanted


def test_the_permutation_spreads_close_numbers():
    layout = c.Layout.of(200_000)
    a = np.repeat(np.arange(1, 301), 300)
    quotient, _ = layout.pack(a, np.tile(np.arange(1, 301), 300), np.zeros(len(a), dtype=np.int64))
    sizes = np.bincount(quotient >> (layout.quotient_bits - 6), minlength=64)
    assert sizes.min() > 0.8 * len(a) / 64 and sizes.max() < 1.2 * len(a) / 64


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_001
    df = spark.createDataFrame([(big, big, big + 7), (3, 7, 11)], "a long, l long, r long")
    score = c._score(df["a"], df["l"], df["r"])
    assert [r[0] for r in df.select(score).collect()] == [
        1_000_000 * big * big // (big * (big + 7)),
        1_000_000 * 9 // 77,
    ]


def test_one_phrase_makes_a_third_of_all_words(spark, folder):
    rows = [(k, "same old words " * 200, "en", "a", 0) for k in range(60)]
    rows += [(100 + k, prose(k, 400), "en", "a", 0) for k in range(60)]
    assert as_rows(c.op13_collocations(spark, folder(rows))) == brute(rows)


def test_empty_tables(spark, folder):
    found = c.op13_collocations(spark, folder())
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.collect() == []
    assert c.op13_collocations(spark, folder([(1, "one two", "en", "a", 0)])).collect() == []
