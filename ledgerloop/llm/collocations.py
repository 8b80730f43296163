"""Phrase collocations, counted in quotient filters.

Words of at least MIN_COUNT occurrences in their language get consecutive numbers; no phrase that is
frequent enough holds another word.  The numbers of an n-gram, packed into one wide number, are
permuted invertibly (a Feistel network) and cut into a quotient and its full remainder.  A filter
keeps these sorted, with a counter of one byte that overflows into a list.  Nothing is lost: the
permutation is undone to read the phrases back.  As quotients are spread evenly, slices of equal
width hold equally many entries, however often a phrase occurs.

Texts become shards of word numbers of their own (a bounded number of words and the rest of a text).
The distinct words of a shard meet the numbered words in a join, each shard counts its n-grams into a
filter, and its slices are merged over shards as sorted runs.  Where one slice of all shards would be
too large, it is merged in several groups and cut again, at most FAN slices at a time, so that neither
the slices of a shard nor the entries of a merge grow with the corpus.

Defined results: a null text is an empty one and has no words, a null language is `und`.  Texts are read
whole, whatever their length.  Repeated rows count each; ties of score and count go by the phrase.
An empty table gives an empty result.  Only text and lang are read, so other columns, whatever their
names, do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace, read_table, total
from ledgerloop.operators.ordinal import with_ordinal

MIN_COUNT = 10
#: A phrase goes if a longer one has at least this percentage of its occurrences.
COVERED_PERCENT = 50
TOP = 2_000
SCALE = 1_000_000
#: Words of a shard, after which no further text is added.
SHARD_WORDS = 2_000_000
#: Entries of one merge, and bits by which slices are cut at a time.
MERGE_ENTRIES = 4_000_000
FAN_BITS = 8
LEAST_BITS = 5
#: Groups in which a language is ranked first.
RANK_GROUPS = 64

_BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_U = np.uint64


class _Numbers(dict):
    """Numbers new words of one language from a list that the languages of a shard share."""

    def __init__(self, lang: str, every: list):
        super().__init__({b".": 0})
        self.lang, self.every = lang, every

    def __missing__(self, word: bytes) -> int:
        self.every.append((self.lang, word))
        self[word] = number = len(self.every)
        return number


def pieces_and_words(text: str | None) -> list[bytes]:
    """The words in order, with b"." at the ends of pieces (no word has it)."""
    data = (text or "").encode().lower().translate(_BREAKS)
    return data.replace(b".", b" . ").split()


def pack_stream(stream: np.ndarray) -> bytes:
    """int32 numbers, compressed byte by byte of the same place."""
    planes = np.ascontiguousarray(stream.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_stream(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def make_shards(docs: DataFrame) -> DataFrame:
    """Of each shard a row with `stream`, its words as packed numbers with 0 for a break, and a row
    per distinct word: local (its number), lang, word and n."""
    schema = "shard long, local int, lang string, word string, n long, stream binary"

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = (task.partitionId() if task else 0) << 24
        every: list = []
        by_lang: dict[str, _Numbers] = {}
        streams: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            stream = np.concatenate(streams)
            n = np.bincount(stream, minlength=len(every) + 1)[1:]
            rows = len(every)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows + 1, shard, dtype=np.int64)),
                    pa.array([*range(1, rows + 1), None], pa.int32()),
                    pa.array([*[lang for lang, _ in every], None], pa.string()),
                    pa.array([*[word.decode() for _, word in every], None], pa.string()),
                    pa.array([*n.tolist(), None], pa.int64()),
                    pa.array([*[None] * rows, pack_stream(stream)], pa.binary()),
                ],
                names=["shard", "local", "lang", "word", "n", "stream"],
            )
            every.clear()
            by_lang.clear()
            streams.clear()
            return batch

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang, text in zip(langs, texts):
                words = pieces_and_words(text)
                if not words:
                    continue
                numbers = by_lang.get(lang)
                if numbers is None:
                    numbers = by_lang[lang] = _Numbers(lang, every)
                words.append(b".")
                streams.append(
                    np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
                )
                size += len(words)
                if size >= SHARD_WORDS:
                    yield flush()
                    shard, size = shard + 1, 0
        if streams:
            yield flush()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Layout:
    """How n-grams are packed: three word numbers of `width` bits, of which the last may be 0."""

    width: int

    @classmethod
    def of(cls, words: int) -> Layout:
        """For word numbers 1 to `words`."""
        width = max(1, words.bit_length())
        if width > 32:
            raise ValueError("word numbers have at most 32 bits")
        return cls(width)

    @property
    def half(self) -> int:
        return (3 * self.width + 1) // 2

    @property
    def bits(self) -> int:
        return 2 * self.half

    @property
    def quotient_bits(self) -> int:
        """Enough for slices, and for remainders of at most 64 bits."""
        return min(self.half, max(16, self.bits - 64))

    @property
    def remainder_bytes(self) -> int:
        return (self.bits - self.quotient_bits + 7) // 8

    def pack(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quotients and remainders of the n-grams (a, b, c)."""
        w, half = _U(self.width), _U(self.half)
        low = (b.astype(_U) << w) | c.astype(_U)
        left = (a.astype(_U) << (_U(2) * w - half)) | (low >> half)
        right = low & self._mask(self.half)
        for key in _ROUNDS:
            left, right = right, left ^ self._mix(right, key)
        rest = self.half - self.quotient_bits
        quotient = left >> _U(rest)
        return quotient.astype(np.uint32), ((left & self._mask(rest)) << half) | right

    def unpack(self, quotient: np.ndarray, remainder: np.ndarray) -> tuple[np.ndarray, ...]:
        w, half = _U(self.width), _U(self.half)
        rest = self.half - self.quotient_bits
        left = (quotient.astype(_U) << _U(rest)) | (remainder >> half)
        right = remainder & self._mask(self.half)
        for key in reversed(_ROUNDS):
            left, right = right ^ self._mix(left, key), left
        over = 2 * self.width - self.half
        low = ((left & self._mask(over)) << half) | right
        found = left >> _U(over), low >> w, low & self._mask(self.width)
        return tuple(x.astype(np.int64) for x in found)

    @staticmethod
    def _mask(bits: int) -> np.uint64:
        return _U((1 << bits) - 1)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        mixed = (x ^ (x >> _U(7))) * key
        return (mixed ^ (mixed >> _U(29))) * _U(0x9E3779B97F4A7C15) >> _U(64 - self.half)


_ROUNDS = [_U(k) for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


@dataclass
class Filter:
    """Sorted quotients and remainders with their counts."""

    layout: Layout
    quotient: np.ndarray
    remainder: np.ndarray
    count: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    @classmethod
    def merged(
        cls, layout: Layout, quotient: np.ndarray, remainder: np.ndarray, count: np.ndarray
    ) -> Filter:
        """Sorted, with equal entries added up."""
        if layout.bits <= 64:
            rest = _U(layout.bits - layout.quotient_bits)
            order = np.argsort((quotient.astype(_U) << rest) | remainder, kind="stable")
        else:
            order = np.lexsort((remainder, quotient))
        quotient, remainder, count = quotient[order], remainder[order], count[order]
        if not len(count):
            return cls(layout, quotient, remainder, count)
        new = np.ones(len(count), dtype=bool)
        new[1:] = (quotient[1:] != quotient[:-1]) | (remainder[1:] != remainder[:-1])
        first = np.flatnonzero(new)
        return cls(layout, quotient[first], remainder[first], np.add.reduceat(count, first))

    @classmethod
    def of_stream(cls, layout: Layout, numbers: np.ndarray) -> Filter:
        """The n-grams of two and three words of a stream, 0 being a break."""
        numbers = np.append(numbers, [0, 0])
        there = numbers > 0
        two = np.flatnonzero(there[:-1] & there[1:])
        three = two[there[two + 2]]
        a = np.concatenate([numbers[two], numbers[three]])
        b = np.concatenate([numbers[two + 1], numbers[three + 1]])
        c = np.concatenate([np.zeros(len(two), numbers.dtype), numbers[three + 2]])
        quotient, remainder = layout.pack(a, b, c)
        if layout.bits > 64:
            return cls.merged(layout, quotient, remainder, np.ones(len(a), dtype=np.int64))
        rest = layout.bits - layout.quotient_bits
        key, count = np.unique((quotient.astype(_U) << _U(rest)) | remainder, return_counts=True)
        return cls(layout, (key >> _U(rest)).astype(np.uint32), key & layout._mask(rest), count)

    def slices(self, bits: int) -> Iterator[tuple[int, Filter]]:
        """Slices by the highest `bits` of the quotients, those that are not empty."""
        number = self.quotient >> np.uint32(self.layout.quotient_bits - bits)
        starts = np.flatnonzero(np.diff(number, prepend=number[:1] ^ np.uint32(1)))
        for low, high in zip(starts, [*starts[1:], len(number)]):
            part = slice(low, high)
            yield int(number[low]), Filter(
                self.layout, self.quotient[part], self.remainder[part], self.count[part]
            )

    def to_bytes(self) -> bytes:
        """Quotients by their runs, remainders without idle bytes, counts in a byte or a list."""
        run = np.flatnonzero(np.diff(self.quotient, prepend=self.quotient[:1] ^ np.uint32(1)))
        size = np.diff(run, append=len(self)).astype(np.uint32)
        large = np.flatnonzero(self.count >= 255)
        head = np.array([len(self), len(run), len(large)], dtype=np.uint32)
        octets = self.remainder.astype("<u8").view(np.uint8).reshape(-1, 8)
        parts = (
            head,
            self.quotient[run],
            size,
            np.ascontiguousarray(octets[:, : self.layout.remainder_bytes]),
            np.minimum(self.count, 255).astype(np.uint8),
            self.count[large],
        )
        return b"".join(x.tobytes() for x in parts)

    @classmethod
    def from_bytes(cls, layout: Layout, data: bytes) -> Filter:
        n, runs, large = np.frombuffer(data, np.uint32, 3).tolist()
        at = 12
        quotient = np.frombuffer(data, np.uint32, runs, at)
        size = np.frombuffer(data, np.uint32, runs, at + 4 * runs)
        at += 8 * runs
        octets = np.zeros((n, 8), dtype=np.uint8)
        width = layout.remainder_bytes
        octets[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        count = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        count[count == 255] = np.frombuffer(data[at + n :], np.int64, large)
        return cls(layout, np.repeat(quotient, size), octets.view("<u8").ravel().astype(_U), count)

    @classmethod
    def union(cls, layout: Layout, blobs: list[bytes]) -> Filter:
        filters = [cls.from_bytes(layout, blob) for blob in blobs]
        columns = [
            np.concatenate([getattr(f, name) for f in filters])
            for name in ("quotient", "remainder", "count")
        ]
        return cls.merged(layout, *columns)


_SLICES = "slice long, shard long, data binary"


def _slice_rows(found: Filter, bits: int, shard: int) -> pa.Table:
    rows = [(k, own.to_bytes()) for k, own in found.slices(bits)] if len(found) else []
    return pa.table(
        {
            "slice": pa.array([k for k, _ in rows], pa.int64()),
            "shard": pa.array([shard] * len(rows), pa.int64()),
            "data": pa.array([data for _, data in rows], pa.binary()),
        }
    )


def count_shards(streams: DataFrame, numbers: DataFrame, layout: Layout, bits: int) -> DataFrame:
    """A filter per shard, in slices by `bits`.  `numbers` has of (a shard), local and number."""

    def run(streams: pa.Table, numbers: pa.Table) -> pa.Table:
        found = Filter.of_stream(layout, np.zeros(1, dtype=np.int64))
        shard = 0
        if streams.num_rows and numbers.num_rows:
            shard = streams.column("shard")[0].as_py()
            stream = unpack_stream(streams.column("stream")[0].as_py())
            known = np.zeros(int(stream.max(initial=0)) + 1, dtype=np.int64)
            known[numbers.column("local").to_numpy()] = numbers.column("number").to_numpy()
            found = Filter.of_stream(layout, known[stream])
        return _slice_rows(found, bits, shard)

    return (
        streams.groupBy("shard").cogroup(numbers.groupBy("of")).applyInArrow(run, _SLICES)
    )


def merge_slices(rows: DataFrame, layout: Layout, groups: int, bits: int) -> DataFrame:
    """Filters of a slice merged in `groups` groups of shards, and cut by `bits`."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        merged = Filter.union(layout, table.column("data").to_pylist())
        return _slice_rows(merged, bits, key[1].as_py())

    group = F.pmod(F.xxhash64("shard"), F.lit(groups)).alias("group")
    return rows.select("slice", "data", group).groupBy("slice", "group").applyInArrow(run, _SLICES)


def read_slices(rows: DataFrame, layout: Layout, least: int) -> DataFrame:
    """Every n-gram of at least that many occurrences: w1, w2, w3 (0: none) and a."""

    def run(table: pa.Table) -> pa.Table:
        merged = Filter.union(layout, table.column("data").to_pylist())
        often = merged.count >= least
        words = layout.unpack(merged.quotient[often], merged.remainder[often])
        return pa.table([*map(pa.array, words), pa.array(merged.count[often])], ["w1", "w2", "w3", "a"])

    return rows.groupBy("slice").applyInArrow(run, "w1 long, w2 long, w3 long, a long")


def count_phrases(
    docs: DataFrame, ws: Workspace, merge_entries: int = MERGE_ENTRIES, fan_bits: int = FAN_BITS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """words (number, lang, word, f), phrases (w1, w2, w3, a) and totals (lang, n); words and phrases
    of at least MIN_COUNT occurrences."""
    shards = ws.materialize(make_shards(docs), "shards")
    own = shards.filter("stream is null")
    totals = ws.materialize(own.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = own.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= MIN_COUNT)
    words = with_ordinal(often, [F.col("lang"), F.col("word")], ws).select(
        (F.col("ordinal") + 1).alias("number"), "lang", "word", "f"
    )
    words, n_words = ws.materialize_counted(words, "words")
    layout = Layout.of(n_words)
    numbers = own.join(words, ["lang", "word"]).select(
        F.col("shard").alias("of"), "local", "number"
    )

    # At most two n-grams begin at each word, which bounds the entries of all filters.
    entries = 2 * total(totals, "n")
    need = math.ceil(math.log2(max(entries, 1) / merge_entries)) if entries else 0
    bits = min(layout.quotient_bits, max(LEAST_BITS, need))
    done = min(bits, fan_bits)
    streams = shards.filter("stream is not null").select("shard", "stream")
    slices = count_shards(streams, numbers, layout, done)
    while done < bits:
        groups = max(1, math.ceil(entries / merge_entries / 2**done))
        done = min(bits, done + fan_bits)
        slices = merge_slices(slices, layout, groups, done)
    phrases = ws.materialize(read_slices(slices, layout, MIN_COUNT), "phrases")
    return words, phrases, totals


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole decimals, exact below 10^13 occurrences."""
    a, left, right = (c.cast("decimal(13,0)") for c in (a, left, right))
    scaled = (a * a).cast("decimal(26,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", scaled, left * right)


def score_phrases(words: DataFrame, phrases: DataFrame, ws: Workspace) -> DataFrame:
    """lang, phrase, a, l, r and score of the phrases that no longer one covers, each cut where it
    scores least."""
    pairs = phrases.filter("w3 = 0").select("w1", "w2", "a")
    triples = phrases.filter("w3 > 0")
    inside = F.inline(
        F.array(
            F.struct(F.col("w1"), F.col("w2"), F.col("a").alias("longer")),
            F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("longer")),
        )
    )
    covers = triples.select(inside).groupBy("w1", "w2").agg(F.max("longer").alias("longer"))
    covers = ws.materialize(covers, "covers")
    covered = F.coalesce(100 * F.col("longer") >= COVERED_PERCENT * F.col("a"), F.lit(False))
    kept = pairs.join(covers, ["w1", "w2"], "left").filter(~covered)
    nothing = F.lit(None).cast("long")
    kept = kept.select("w1", "w2", F.lit(0).cast("long").alias("w3"), "a", nothing.alias("f12"), nothing.alias("f23"))
    head = pairs.select("w1", "w2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    cut = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    rows = ws.materialize(kept.unionByName(cut.select(*kept.columns)), "candidates")
    for k in (1, 2, 3):
        own = words.select(
            F.col("number").alias(f"w{k}"),
            F.col("word").alias(f"word{k}"),
            F.col("f").alias(f"f{k}"),
            *([F.col("lang")] if k == 1 else []),
        )
        rows = rows.join(own, f"w{k}", "left" if k == 3 else "inner")
    a, two = F.col("a"), F.col("w3") == 0
    first = F.struct(
        _score(a, F.col("f1"), F.when(two, F.col("f2")).otherwise(F.col("f23"))).alias("score"),
        F.lit(1).alias("k"),
        F.col("f1").alias("l"),
        F.when(two, F.col("f2")).otherwise(F.col("f23")).alias("r"),
    )
    second = F.struct(
        _score(a, F.col("f12"), F.col("f3")).alias("score"),
        F.lit(2).alias("k"),
        F.col("f12").alias("l"),
        F.col("f3").alias("r"),
    )
    return rows.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(two, first).otherwise(F.least(first, second)).alias("cut"),
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def top_phrases(scored: DataFrame, n: int = TOP) -> DataFrame:
    """The first n of each language, with their rank.  Groups of a language are ranked on their own
    first, so that no task sorts a language."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    inner = Window.partitionBy("lang", "part").orderBy(*order)
    first = (
        scored.withColumn("part", group)
        .withColumn("rank", F.row_number().over(inner))
        .filter(F.col("rank") <= n)
        .drop("part", "rank")
    )
    outer = Window.partitionBy("lang").orderBy(*order)
    return first.withColumn("rank", F.row_number().over(outer)).filter(F.col("rank") <= n)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    ws = Workspace(spark)
    docs = read_table(spark, folder, "documents").select("lang", "text")
    words, phrases, totals = count_phrases(docs, ws)
    best = ws.materialize(top_phrases(score_phrases(words, phrases, ws)), "best")
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\n\x0B\f\r]')) AS piece,
    generate_subscripts(string_split_regex(t, '[.,;:!?\n\x0B\f\r]'), 1) AS p
  FROM texts),
split AS (SELECT d, lang, p, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces),
tokens AS (
  SELECT d, lang, p, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM split),
grams AS (
  SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3
  FROM tokens WINDOW s AS (PARTITION BY d, p ORDER BY i)),
one AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, count(*) AS n FROM grams GROUP BY lang),
two AS (
  SELECT lang, w1, w2, count(*) AS a FROM grams WHERE w2 IS NOT NULL GROUP BY ALL
  HAVING count(*) >= {MIN_COUNT}),
three AS (
  SELECT lang, w1, w2, w3, count(*) AS a FROM grams WHERE w3 IS NOT NULL GROUP BY ALL
  HAVING count(*) >= {MIN_COUNT}),
covers AS (
  SELECT lang, w1, w2, max(a) AS longer FROM (
    SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, concat(t.w1, ' ', t.w2) AS phrase, t.a, 1 AS k, x.f AS l, y.f AS r
  FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
  JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  LEFT JOIN covers c ON c.lang = t.lang AND c.w1 = t.w1 AND c.w2 = t.w2
  WHERE c.longer IS NULL OR 100 * c.longer < {COVERED_PERCENT} * t.a
  UNION ALL
  SELECT t.lang, concat(t.w1, ' ', t.w2, ' ', t.w3), t.a, 1, x.f, y.a
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1
  JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, concat(t.w1, ' ', t.w2, ' ', t.w3), t.a, 2, x.a, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2
  JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (
  SELECT *, CAST((CAST(a AS HUGEINT) * a * {SCALE}) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score
  FROM cuts),
least AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}
"""
