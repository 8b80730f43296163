"""Removes passages that an earlier document has, found with prefix-partitioned suffix trees.

A window is a number of consecutive words of a document (`WINDOW`, if no other is asked for, `ANCHOR` at
least).  A word goes if a window over it also starts in a document with a smaller id; windows are judged
on the input.  The operator gives what is left of each text and the spans of words that went: windows
that overlap or touch are one span, so a repeat of any length is found whole.

The suffixes of all documents, cut off after a window, are the material of a suffix tree; a repeated
window is an inner node at that depth.  To keep the tree out of any one place:

1. Every window has an anchor, the five words in it whose hash is smallest.  Equal windows have
   equal anchors, so a window whose anchor occurs in one document only has no equal.  Chunks of
   documents (see chunks) ask about each anchor they hold, and go on with those that repeat.
2. Neighbouring windows with one anchor form a passage.  A chunk sends each distinct passage once,
   with its smallest document, to the bucket of its anchor, where all equal windows meet.  An
   anchor with many windows (a phrase of menus or licences) would fill one bucket: of its passages
   each distinct window goes on its own, to the bucket of all its words.
3. In a bucket, suffixes are split by prefixes that grow by one word while a group is too large for
   memory.  The suffixes of a group, sorted, are the leaves of its subtree in order; where
   neighbours agree for the whole window, they hang below one deep inner node.  The smallest
   document of each node tells for which passages another chunk has an earlier one.

What stands in a chunk itself needs only the smallest document of each passage.  Nothing is sampled,
and no list grows with the documents that share a passage, only with the chunks that do.

A null text has no words.  Documents without an id have no place in the order: they lose nothing
and cause nothing.  Rows that repeat an id are the same document, none earlier than the other.

Texts are read whole, whatever their length; one with fewer words than a window loses none.  An empty
table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.llm.chunks import bucket_count, pack, per_bucket, unpack, write_chunks
from ledgerloop.llm.common import Workspace, read_table

WINDOW = 13
ANCHOR = 5
#: Suffixes of a group that are sorted together.
GROUP = 100_000
#: Windows of an anchor above which they are dealt by all their words.
HOT = 100_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NO_ID = -(2**63)
_QUESTIONS = "chunk long, bucket int, content binary"
_ANSWERS = "chunk long, bucket int, content binary"
_FOUND = "doc_id long, n_words long, kept string, start array<long>, stop array<long>"


def _squeeze(value: object) -> bytes:
    """As pack does, but for texts, where more effort pays."""
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, protocol=5))


def _payload(ids: list, texts: list, window: int = WINDOW) -> tuple[bytes, dict]:
    """Ids, words and passages of a chunk's documents."""
    words: list[bytes] = []
    sizes = []
    for text in texts:
        own = (text or "").encode().split()
        words += own
        sizes.append(len(own))
    n = np.array(sizes, dtype=np.int64)
    lengths, offsets = _passages(words, n, window)
    return (
        _squeeze((ids, b" ".join(words), n.astype(np.uint32), lengths, offsets)),
        {},
    )


def _windows(n: np.ndarray, window: int) -> np.ndarray:
    """The word at which each window starts, for documents of n words one after the other."""
    each = np.maximum(n - window + 1, 0)
    starts = np.cumsum(n) - n
    total = int(each.sum())
    return np.repeat(starts - (np.cumsum(each) - each), each) + np.arange(total)


def _passages(
    words: list[bytes], n: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of windows of one document with one anchor: how many windows, and how far
    behind the first window's start the anchor is."""
    at, narrow = _windows(n, window), np.min_scalar_type(window)
    if not len(at):
        return np.zeros(0, narrow), np.zeros(0, narrow)
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    word = np.array(list(map(numbers.__getitem__, words)), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w, 1) for w in numbers], dtype=np.uint64)[word]
    gram = hashes[: len(hashes) - ANCHOR + 1].copy()
    for k in range(1, ANCHOR):
        gram = (gram ^ gram >> np.uint64(29)) * _MIX + hashes[k : len(hashes) - ANCHOR + 1 + k]
    gram = (gram ^ gram >> np.uint64(32)) * _MIX
    choices = window - ANCHOR + 1
    least, place = gram[at], np.zeros(len(at), dtype=np.int64)
    for k in range(1, choices):
        other = gram[at + k]
        less = other < least
        least = np.where(less, other, least)
        place[less] = k
    anchor = at + place
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(new)
    lengths = np.diff(np.append(first, len(at)))
    return lengths.astype(narrow), place[first].astype(narrow)


class _Chunk:
    """A payload laid out for use: word positions, and the passages with their documents."""

    def __init__(self, content: bytes, buckets: int, window: int):
        self.window = window
        self.ids, self.data, n, lengths, offsets = unpack(content)
        self.n = n.astype(np.int64)
        size = np.array([len(w) for w in self.data.split(b" ")] if self.n.sum() else [], np.int64)
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        self.length = lengths.astype(np.int64)
        at = _windows(self.n, window)
        self.first = at[np.cumsum(self.length) - self.length] if len(at) else at
        self.anchor = self.first + offsets
        owner = np.repeat(np.arange(len(self.n)), self.n)
        doc = np.array([_NO_ID if i is None else i for i in self.ids], dtype=np.int64)
        self.doc = doc[owner[self.first]]
        data, digest = self.data, xxhash.xxh64_intdigest
        begin = self.start[self.anchor].tolist()
        end = self.end[self.anchor + ANCHOR - 1].tolist()
        hashes = np.array([digest(data[a:b], 7) for a, b in zip(begin, end)], dtype=np.uint64)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        # Distinct anchors of documents with an id, ordered by bucket.
        self.known = np.flatnonzero(self.doc != _NO_ID)
        key = np.lexsort((hashes[self.known], bucket[self.known]))
        own = self.known[key]
        new = np.append(True, hashes[own][1:] != hashes[own][:-1])[: len(own)]
        self.number = np.full(len(hashes), -1)
        self.number[own] = np.cumsum(new) - 1
        self.hashes, self.bucket = hashes[own[new]], bucket[own[new]]
        starts = np.flatnonzero(new)
        docs = self.doc[own]
        self.several, self.windows = np.zeros(0, bool), np.zeros(0, np.int64)
        if len(starts):
            self.several = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
            self.windows = np.add.reduceat(self.length[own], starts)
        self.buckets = buckets

    def anchors(self) -> Iterator[tuple[int, tuple]]:
        """By bucket: hashes of anchors, whether several documents of the chunk have them, and how
        many windows do."""
        edges = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        windows = self.windows.astype(np.uint32)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(self.bucket)]):
            yield int(self.bucket[a]), (self.hashes[a:b], self.several[a:b], windows[a:b])

    def candidates(
        self, repeats: np.ndarray, hot: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list, np.ndarray]:
        """Of the passages with repeated anchors, those of hot anchors cut into single windows: the
        first window, the number of windows and the document of each, the number of its distinct
        passage, the distinct passages as (bucket, bytes, windows), and their smallest documents.
        """
        own = self.known[repeats[self.number[self.known]]]
        cut = hot[self.number[own]]
        pieces = np.where(cut, self.length[own], 1)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        own, cut = np.repeat(own, pieces), np.repeat(cut, pieces)
        first = self.first[own] + step
        length = np.where(cut, 1, self.length[own])
        bucket = self.bucket[self.number[own]]
        data, digest = self.data, xxhash.xxh64_intdigest
        for k in np.flatnonzero(cut).tolist():
            text = data[self.start[first[k]] : self.end[first[k] + self.window - 1]]
            bucket[k] = digest(text, 11) % self.buckets
        order = np.argsort(bucket, kind="stable")
        own, first, length, bucket = own[order], first[order], length[order], bucket[order]
        begin = self.start[first].tolist()
        end = self.end[first + length + self.window - 2].tolist()
        # A window on its own is the same wherever its anchor is.
        offset = np.where(cut[order], 0, self.anchor[own] - first).tolist()
        numbers: defaultdict[tuple, int] = defaultdict(count().__next__)
        number = np.array(
            [numbers[(data[a:b], o)] for a, b, o in zip(begin, end, offset)], dtype=np.int64
        )
        least = np.full(len(numbers), 2**63 - 1, dtype=np.int64)
        np.minimum.at(least, number, self.doc[own])
        any_ = np.zeros(len(numbers), dtype=np.int64)
        any_[number[::-1]] = np.arange(len(number))[::-1]
        texts = [text for text, _ in numbers]
        distinct = list(zip(bucket[any_].tolist(), texts, length[any_].tolist()))
        return first, length, self.doc[own], number, distinct, least


def _repeated_anchors(
    bucket: int, chunks: list[int], lists: list[tuple], most: int
) -> Iterator[tuple]:
    """Which anchors of each list occur in more than one document, and which of them are hot, that
    is, have more than `most` windows."""
    hashes, several, windows = map(np.concatenate, zip(*lists))
    _, where = np.unique(hashes, return_inverse=True)
    again = (np.bincount(where) > 1) | (np.bincount(where, several) > 0)
    hot = again & (np.bincount(where, windows) > most)
    edges = np.cumsum([len(h) for h, _, _ in lists])[:-1]
    for chunk, *own in zip(chunks, np.split(again[where], edges), np.split(hot[where], edges)):
        yield chunk, bucket, pack((len(own[0]), *map(np.packbits, own)))


def subtrees(
    suffixes: list[bytes], group: int = GROUP, window: int = WINDOW
) -> Iterator[list[int]]:
    """Numbers of suffixes by common prefix, sorted.  Prefixes are one word long, and longer by one
    word at a time where more than `group` suffixes share them."""
    todo = [(0, list(range(len(suffixes))))]
    while todo:
        words, own = todo.pop()
        if len(own) <= group or words == window:
            own.sort(key=suffixes.__getitem__)
            yield own
            continue
        parts: defaultdict[bytes, list[int]] = defaultdict(list)
        for k in own:
            parts[b" ".join(suffixes[k].split(b" ", words + 1)[: words + 1])].append(k)
        todo += [(words + 1, part) for part in parts.values()]


def smallest_documents(
    suffixes: list[bytes], docs: np.ndarray, group: int = GROUP, window: int = WINDOW
) -> np.ndarray:
    """For each suffix the smallest document of those below its deep node, that is, that agree with
    it for the whole window."""
    least = np.empty(len(suffixes), dtype=np.int64)
    for own in subtrees(suffixes, group, window):
        ordered = [suffixes[k] for k in own]
        starts = np.array([True, *map(bytes.__ne__, ordered, ordered[1:])][: len(own)])
        node = np.cumsum(starts) - 1
        where = np.array(own, dtype=np.int64)
        least[where] = np.minimum.reduceat(docs[where], np.flatnonzero(starts))[node]
    return least


def _earlier_elsewhere(
    bucket: int, chunks: list[int], lists: list[bytes], window: int
) -> Iterator[tuple]:
    """For each window of each passage whether any chunk has it in an earlier document than the
    asking chunk does."""
    opened = [unpack(x) for x in lists]
    data = b"\n".join([text for text, _, _ in opened])
    windows = np.concatenate([w for _, w, _ in opened]).astype(np.int64)
    least = np.concatenate([d for _, _, d in opened])
    raw = np.frombuffer(data, dtype=np.uint8)
    stops = np.append(np.flatnonzero((raw == 0x20) | (raw == 0x0A)), len(raw))
    starts = np.append(0, stops[:-1] + 1)
    size = windows + window - 1
    first = np.cumsum(size) - size
    at = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    begin, end = starts[at].tolist(), stops[at + window - 1].tolist()
    suffixes = [data[a:b] for a, b in zip(begin, end)]
    own = np.repeat(least, windows)
    earlier = smallest_documents(suffixes, own, window=window) < own
    edges = np.cumsum([int(w.sum()) for _, w, _ in opened])[:-1]
    for chunk, bits in zip(chunks, np.split(earlier, edges)):
        yield chunk, bucket, pack((len(bits), np.packbits(bits)))


def _bits(frame: pd.DataFrame, kind: int, which: int = 1) -> np.ndarray:
    """The answers of a kind, in the order of their buckets."""
    frame = frame[frame["kind"] == kind].sort_values("bucket")
    found = [unpack(c) for c in frame["content"]]
    return np.concatenate(
        [np.zeros(0, bool), *[np.unpackbits(x[which], count=x[0]).astype(bool) for x in found]]
    )


def _repeats_and_hot(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _bits(answers, 1), _bits(answers, 1, 2)


def remove_repeats(docs: DataFrame, ws: Workspace, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, kept (the words that stay, joined by one space) and spans,
    an array in order of (start, stop), from the first removed word of a run to the one behind it."""
    if window < ANCHOR:
        raise ValueError(f"a window has at least {ANCHOR} words")
    buckets, most = bucket_count(docs), HOT
    payloads, _ = write_chunks(docs, ws, "passage-chunks", partial(_payload, window=window))
    names = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("content", pa.binary())])

    def ask_anchors(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("chunk", "content")]
            for chunk, content in zip(*columns):
                asked = list(_Chunk(unpack(content), buckets, window).anchors())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * len(asked), pa.int64()),
                        pa.array([b for b, _ in asked], pa.int32()),
                        pa.array([pack(x) for _, x in asked], pa.binary()),
                    ],
                    names=names.names,
                )

    def repeated_anchors(bucket: int, chunks: list[int], lists: list[tuple]) -> Iterator[tuple]:
        return _repeated_anchors(bucket, chunks, lists, most)

    first = per_bucket(
        payloads.mapInArrow(ask_anchors, _QUESTIONS), repeated_anchors, names, _ANSWERS
    )
    first = ws.materialize(first.withColumn("kind", F.lit(1)), "repeated-anchors")

    def ask_passages(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(own) and len(answers):
            chunk = _Chunk(unpack(own["content"].iloc[0]), buckets, window)
            *_, distinct, least = chunk.candidates(*_repeats_and_hot(answers))
            edges = [k for k, d in enumerate(distinct) if not k or d[0] != distinct[k - 1][0]]
            for a, b in zip(edges, [*edges[1:], len(distinct)]):
                part = distinct[a:b]
                text = b"\n".join([t for _, t, _ in part])
                windows = np.array([w for _, _, w in part], dtype=np.min_scalar_type(window))
                rows.append((part[0][0], pack(_squeeze((text, windows, least[a:b])))))
        return pd.DataFrame(
            {
                "chunk": np.full(len(rows), own["chunk"].iloc[0] if len(own) else 0),
                "bucket": [b for b, _ in rows],
                "content": [c for _, c in rows],
            }
        )

    asked = (
        payloads.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInPandas(
            ask_passages, _QUESTIONS
        )
    )
    def earlier_elsewhere(bucket: int, chunks: list[int], lists: list[bytes]) -> Iterator[tuple]:
        return _earlier_elsewhere(bucket, chunks, lists, window)

    second = per_bucket(asked, earlier_elsewhere, names, _ANSWERS)
    second = ws.materialize(second.withColumn("kind", F.lit(2)), "earlier-passages")

    def finish(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame()
        chunk = _Chunk(unpack(own["content"].iloc[0]), buckets, window)
        n = chunk.n
        edge = np.zeros(int(n.sum()) + 1, dtype=np.int64)
        if len(answers):
            first, length, doc, number, distinct, least = chunk.candidates(
                *_repeats_and_hot(answers)
            )
            windows = np.array([w for _, _, w in distinct], dtype=np.int64)
            begins = np.cumsum(windows) - windows
            earlier = _bits(answers, 2)
            step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            late = np.repeat(doc > least[number], length)
            gone = late | earlier[np.repeat(begins[number], length) + step]
            start = (np.repeat(first, length) + step)[gone]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + window, -1)
        removed = np.cumsum(edge[:-1]) > 0
        ends = np.cumsum(n)
        texts, starts, stops = [], [], []
        words = None
        for end, size in zip(ends.tolist(), n.tolist()):
            here = removed[end - size : end]
            turns = np.flatnonzero(np.diff(here, prepend=False, append=False))
            starts.append(turns[::2])
            stops.append(turns[1::2])
            if not size:
                kept = b""
            elif not len(turns):
                kept = chunk.data[chunk.start[end - size] : chunk.end[end - 1]]
            else:
                words = words or chunk.data.split(b" ")
                stays = np.flatnonzero(~here) + (end - size)
                kept = b" ".join([words[w] for w in stays.tolist()])
            texts.append(kept.decode())
        return pd.DataFrame(
            {
                "doc_id": pd.array(chunk.ids, dtype="Int64"),
                "n_words": n,
                "kept": texts,
                "start": starts,
                "stop": stops,
            }
        )

    answers = first.unionByName(second)
    found = (
        payloads.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finish, _FOUND)
    )
    return found.select("doc_id", "n_words", "kept", F.arrays_zip("start", "stop").alias("spans"))


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    n_removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, span: n + span["stop"] - span["start"]
    )
    return remove_repeats(docs, Workspace(spark)).select(
        "doc_id",
        "n_words",
        n_removed.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
starts AS (
  SELECT r, doc_id, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS p FROM words
  WHERE len(w) >= {WINDOW} AND doc_id IS NOT NULL),
windows AS (
  SELECT s.r, s.doc_id, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS k
  FROM starts s JOIN words USING (r)),
late AS (
  SELECT r, p FROM (SELECT r, p, doc_id, min(doc_id) OVER (PARTITION BY k) AS least FROM windows)
  WHERE doc_id > least),
gone AS (
  SELECT DISTINCT r, unnest(generate_series(p, p + {WINDOW - 1})) AS p FROM late),
kept AS (
  SELECT w.r, string_agg(w.word, ' ' ORDER BY w.p) FILTER (g.p IS NULL) AS text,
         count(g.p) AS n_removed
  FROM (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM words) w
  LEFT JOIN gone g ON w.r = g.r AND w.p = g.p
  GROUP BY w.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r)
"""
