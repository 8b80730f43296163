import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import awkward_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloop.llm import spelling as s


def brute_words(rows):
    counts = Counter()
    for doc_id, text in ((r[0], r[1]) for r in rows):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def distance_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    edits = {a[:i] + a[i + 1 :] for i in range(len(a))}
    if b in edits or a in {b[:i] + b[i + 1 :] for i in range(len(b))}:
        return True
    return len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1


def brute(words):
    """word -> (form, root, n, n_near, form_n), by trying all pairs that share a deletion or hole."""
    holes = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + w[k + 1 :]].add(w)
        holes[w].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if distance_one(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {
        w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None)
        for w, n in words.items()
    }


def rows_with_variants(seed: int = 4) -> list[tuple]:
    rnd = random.Random(seed)
    letters = "abcdeéè"
    stems = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(7, 10))) for _ in range(40)]
    rows = []
    for k in range(150):
        words = []
        for _ in range(80):
            w = stems[int(40 * rnd.random() ** 3)]
            for _ in range(rnd.choice((0, 0, 0, 0, 1, 1, 2))):
                i = rnd.randrange(len(w))
                w = rnd.choice((w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1 :]))
            words.append(rnd.choice((w, w, w.upper(), w.title())))
        rows.append((k, rnd.choice((" ", ", ", "1")).join(words), "en", "a", 0))
    # A chain of forms.
    chain = ["quarterly"] * 60 + ["quarterli"] * 5
    rows += [(1000 + k, " ".join(chain), "en", "a", 0) for k in range(10)]
    return rows + [(1010, "quarteli quarteli", "en", "a", 0)]


def as_dict(rows):
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_brute_force(spark, folder):
    rows = rows_with_variants() + awkward_rows()
    wanted = brute(brute_words(rows))
    assert sum(form is not None for form, *_ in wanted.values()) > 50
    assert any(root != (form or w) for w, (form, root, *_) in wanted.items())
    assert as_dict(s.op12_spelling(spark, folder(rows, extra=True)).collect()) == wanted


@pytest.mark.parametrize("part_rows, first", [(1, 1), (40, 2), (10_000, 0)])
def test_any_cut_gives_the_same(spark, folder, ws, part_rows, first):
    """Down to parts cut by all counts and by halves of words."""
    rows = rows_with_variants(5)
    docs = spark.read.parquet(f"{folder(rows)}/documents.parquet")
    found = s.group_variants(docs, ws, part_rows=part_rows, first=first)
    assert as_dict(found.collect()) == brute(brute_words(rows))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert as_dict(s.op12_spelling(spark, folder).collect()) == brute(brute_words(rows))


@settings(max_examples=300, deadline=None)
@given(st.text("abà", min_size=7, max_size=12), st.text("abà", min_size=7, max_size=12))
def test_is_near(a, b):
    assert s.is_near(a, b) == distance_one(a, b)


def test_a_word_with_thousands_of_near_words(spark, folder):
    """A hub, and anagrams that share all counts."""
    hub = "abcdefgh" * 3
    near = [hub[:k] + chr(c) + hub[k:] for k in range(25) for c in range(ord("a"), ord("z") + 1)]
    rows = [(k, " ".join([hub] * 30 + near), "en", "a", 0) for k in range(3)]
    rnd = random.Random(1)
    mixed = ["".join(rnd.sample("abcdefghij", 10)) for _ in range(300)]
    rows += [(9 + k, " ".join(mixed + [m[:4] + m[5:] for m in mixed]), "de", "a", 0) for k in range(2)]
    assert as_dict(s.op12_spelling(spark, folder(rows)).collect()) == brute(brute_words(rows))


def test_long_texts_and_words(spark, folder):
    rows = [(1, "x" * 20_000 + " " + "x" * 20_001, "en", "a", 0), (2, "x" * 20_000 + "," + "x" * 20_001, "en", "a", 0)]
    rows.append((3, prose(1, 50_000).replace("w", "letters"), "en", "a", 0))
    assert as_dict(s.op12_spelling(spark, folder(rows)).collect()) == brute(brute_words(rows))


def test_empty_tables(spark, folder):
    found = s.op12_spelling(spark, folder())
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.collect() == []
