import os
import subprocess
import sys
import zlib
from collections import Counter
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pytest
from conftest_llm import awkward_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloop.llm import bpe, huffman


def plain_cost(counts):
    heap = [c for c in counts if c]
    heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heappop(heap) + heappop(heap)
        cost += pair
        heappush(heap, pair)
    return cost


@settings(max_examples=100, deadline=None)
@given(counts=st.lists(st.integers(0, 1000), min_size=1, max_size=60), limit=st.integers(6, 20))
def test_lengths_make_a_prefix_code_of_least_cost(counts, limit):
    lengths = huffman.limited_lengths(np.array(counts), limit)
    used = lengths[lengths > 0]
    assert (lengths > 0).tolist() == [c > 0 for c in counts]
    assert used.max(initial=0) <= limit
    if len(used) > 1:
        assert sum(2.0**-used) == 1
    if limit == 20 and len(used) > 1:
        assert int((lengths * counts).sum()) == plain_cost(counts)


def test_the_limit_binds():
    counts = np.array([2**k for k in range(20)])
    assert huffman.limited_lengths(counts, 30).max() == 19
    lengths = huffman.limited_lengths(counts, 6)
    assert lengths.max() == 6 and sum(2.0**-lengths) == 1


@settings(max_examples=60, deadline=None)
@given(
    docs=st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=200), min_size=1, max_size=8)
)
def test_round_trip(docs):
    flat = np.array([x for d in docs for x in d])
    code = huffman.Code(huffman.limited_lengths(np.bincount(flat, minlength=301), 9))
    sizes = np.array([len(d) for d in docs])
    payload, at = code.encode(flat, sizes)
    starts = np.cumsum(sizes) - sizes
    assert (at[starts] % 8 == 0).all()
    assert code.decode(payload, at[starts], sizes).tolist() == flat.tolist()
    # any checkpoint is a place to start from
    k = len(flat) - 1
    assert code.decode(payload, at[[k]], np.array([1])).tolist() == [flat[k]]


def expected(rows):
    library = Tokenizer.from_str(bpe.vocabulary())
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text, *_ in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [huffman.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_awkward_documents(spark, folder, monkeypatch, small):
    if small:
        monkeypatch.setattr(huffman, "BLOCK_IDS", 500)
    rows = awkward_rows() + [(k, prose(k, 50), "en", "a", 0) for k in range(100, 140)]
    found = huffman.op6_huffman(spark, folder(rows, extra=True)).collect()
    wanted = expected(rows)

    def unique(all_rows):
        """Rows of an id that occurs once; the others in any order."""
        n = Counter(r[0] for r in all_rows)
        return sorted(tuple(r) for r in all_rows if n[r[0]] == 1)

    assert unique(found) == unique(wanted)
    assert Counter((r[0], r[2], r[3]) for r in found) == Counter((r[0], r[2], r[3]) for r in wanted)


def test_many_files_are_in_order(spark, folder, ws, tmp_path):
    rows = [(k, prose(k, 30), "en", "a", 0) for k in range(120)]
    path = folder(rows)
    tokens = huffman.tokenize(spark.read.parquet(f"{path}/documents.parquet"), bpe.vocabulary(), ws)
    counts = huffman.count_ids(tokens, 50257)
    assert counts[huffman.END_ID] == len(rows)
    code = huffman.Code(huffman.limited_lengths(counts))
    out = str(tmp_path / "files")
    huffman.write_files(tokens, code, out, file_ids=500)
    blocks = spark.read.parquet(out)
    spans = sorted((r.part, r.block, r.doc_ids) for r in blocks.collect())
    assert len({p for p, *_ in spans}) > 5
    assert [d for *_, own in spans for d in own] == list(range(120))
    found = huffman.read_files(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_lengths_survive_packing():
    code = huffman.Code(huffman.limited_lengths(np.array([5, 0, 1, 9, 0, 2])))
    again = huffman.Code.unpacked(code.packed())
    assert again.lengths.tolist() == code.lengths.tolist()
    assert again.codes.tolist() == code.codes.tolist()


READER = """
import sys
from pyspark.sql import SparkSession
from ledgerloop.llm import huffman

spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
)
rows = huffman.read_files(spark, sys.argv[1]).orderBy("start").collect()
for r in rows:
    print("ROW", r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids).hex())
"""


def test_another_session_reads_the_folder_alone(spark, folder, ws, tmp_path):
    rows = [(k, prose(k, 30), "en", "a", 0) for k in range(40)]
    docs = spark.read.parquet(f"{folder(rows)}/documents.parquet")
    tokens = huffman.tokenize(docs, bpe.vocabulary(), ws)
    code = huffman.Code(huffman.limited_lengths(huffman.count_ids(tokens, 50257)))
    out = str(tmp_path / "files")
    huffman.write_files(tokens, code, out, file_ids=300)
    # Another process that knows neither the code nor the vocabulary.
    root = Path(huffman.__file__).parents[2]
    env = {**os.environ, "PYTHONPATH": str(root)}
    run = subprocess.run(
        [sys.executable, "-c", READER, out], capture_output=True, text=True, env=env, timeout=300
    )
    assert run.returncode == 0, run.stderr
    found = [line.split()[1:] for line in run.stdout.splitlines() if line.startswith("ROW ")]
    assert [tuple(map(int, row[:4])) for row in found] == expected(rows)
    library = Tokenizer.from_str(bpe.vocabulary())
    for (_, text, *_), row in zip(rows, found):
        ids = library.encode(text, add_special_tokens=False).ids + [huffman.END_ID]
        assert bytes.fromhex(row[4]) == np.array(ids, "<u4").tobytes()


def test_one_long_document_among_many_short_ones(spark, folder, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 64)
    rows = [(k, "a b", "en", "a", 0) for k in range(300)] + [(1000, prose(5, 900), "en", "a", 0)]
    found = huffman.op6_huffman(spark, folder(rows)).collect()
    assert sorted(map(tuple, found)) == expected(rows)


def test_empty_table(spark, folder):
    assert huffman.op6_huffman(spark, folder()).collect() == []
