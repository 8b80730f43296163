"""Spelling variants: words at edit distance one, found in a trie of letter-group counts.

Letters fall into GROUPS groups; a word is the vector of how many letters it has of each.  One
inserted, deleted or replaced letter raises at most one count by one (the surplus) and lowers at most
one (the deficit).  In a trie whose levels are the successive counts, a depth-first search that may
spend one surplus and one deficit therefore meets every near word; the words of the leaves it reaches
are verified letter by letter.

Spark holds the trie in parts.  A word is stored in the part of its own first counts and asks every
part that the budget reaches.  Parts that hold or are asked by too many rows are cut by the next
count, again and again; rows carry what is left of their budget along.  A part whose counts are all
used up is cut by equal halves of words, of which near words share one.  Each part is one task's
group, searched by blocks of node pairs on a stack, so that its memory stays bounded.  What a word
finds in a part leaves it as one row: the number of near words and the most frequent one.

Defined results: null and empty texts have no words.  Texts are read whole, whatever their length;
an id that is null counts as empty text in the checksum, repeated rows count each.  Among near words
of equal count the smallest in code-point order is the form.  An empty table gives an empty result.
Only doc_id and text are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace, read_table

#: Groups of letters and the number of counts that name the first parts.
GROUPS = 16
FIRST = 3
#: Parts with more rows than this are cut by one more count.
PART_ROWS = 400_000
MIN_LENGTH = 7
MIN_COUNT = 2
#: A form has at least this many times the occurrences of its variant.
RATIO = 10
#: One run in this many, by checksum, loses a letter.
SPOILED = 31
#: Node or word pairs in one block of the search, and words in one flush of the counting.
BLOCK = 1 << 18
REMEMBERED = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)

# The commonest letters of European texts get groups of their own, so that counts tell most.
_COMMON = "eantirsolducm"


def _group_table() -> np.ndarray:
    rest = [c for c in range(256) if chr(c) not in _COMMON]
    table = np.zeros(256, dtype=np.int64)
    for k, c in enumerate(_COMMON):
        table[ord(c)] = k
    for c in rest:
        table[c] = len(_COMMON) + c % (GROUPS - len(_COMMON))
    return table


_GROUP = _group_table()


def spoil(word: str, check: int) -> str:
    """The word without the letter its checksum names, where SPOILED divides that."""
    if check % SPOILED:
        return word
    k = check % len(word)
    return word[:k] + word[k + 1 :]


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of a document, at least MIN_LENGTH long, with their occurrences."""
    text = text or ""
    text = text.lower() if text.isascii() else text.encode().lower().decode()
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(_RUN.findall(text)).items():
        check = crc32(run.encode(), start)
        if check % SPOILED == 0:
            run = spoil(run, check)
            if len(run) < MIN_LENGTH:
                continue
        found[run] += n
    return found


def count_words(docs: DataFrame) -> DataFrame:
    """word and n of all words; each task sends sums, a batch of words at a time."""

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"],
            )
            counts.clear()
            return batch

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, text in zip(ids, texts):
                counts.update(words_of(doc_id, text))
                if len(counts) > REMEMBERED:
                    yield flush()
        yield flush()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def vectors(words: list[str]) -> np.ndarray:
    """How many letters of each group; one row per word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    place = np.repeat(np.arange(len(words)), lengths) * GROUPS + _GROUP[letters]
    return np.bincount(place, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def _with_vectors(rows: DataFrame) -> DataFrame:
    """Adds the vector of the word to each row."""
    fields = list(rows.schema.fields)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.array(vectors(batch.column("word").to_pylist()).astype(np.int32).ravel())
            ends = pa.array(np.arange(batch.num_rows + 1) * GROUPS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, flat)],
                names=[*batch.schema.names, "vector"],
            )

    return rows.mapInArrow(run, f"{schema}, vector array<int>")


def _cut(rows: DataFrame, level: int) -> DataFrame:
    """Rows (with vectors) by one more count.  Words at home go where they are; those that ask go to
    each count their budget allows: `up` allows for one more of a letter, `down` for one less."""
    own = F.element_at("vector", level + 1)

    def towards(step: int) -> Column:
        return F.struct(
            F.concat("part", (own + step).cast("string"), F.lit(",")).alias("part"),
            (F.col("up") - max(step, 0)).cast("int").alias("up"),
            (F.col("down") - max(-step, 0)).cast("int").alias("down"),
        )

    asks = ~F.col("home")
    ways = F.array(
        towards(0),
        F.when(asks & (F.col("up") > 0), towards(1)),
        F.when(asks & (F.col("down") > 0) & (own > 0), towards(-1)),
    )
    rest = [c for c in rows.columns if c not in ("part", "up", "down")]
    cut = rows.select(*rest, F.explode(F.array_compact(ways)).alias("way"))
    return cut.select(*rest, "way.part", "way.up", "way.down")


def _halve(rows: DataFrame) -> DataFrame:
    """Rows whose counts are all used up, by halves of words: two words one edit apart have the
    same first or the same last letters, half as many as the shorter one has.  A word that asks
    knows by its budget whether it looks for shorter, equal or longer ones."""
    size = F.length("word")
    asked = F.when((F.col("up") == 1) & (F.col("down") == 0), size - 1).otherwise(size)
    cuts = F.when(F.col("home"), F.array(size, size - 1)).otherwise(F.array(asked))
    rest = [c for c in rows.columns if c != "part"]
    cut = rows.select(*rest, "part", F.explode(cuts).alias("cut"))
    half = F.floor(F.col("cut") / 2).cast("int")
    tail = F.col("cut") - half
    keys = F.array(
        F.concat("part", F.lit("<"), "cut", F.lit("<"), F.substring("word", F.lit(1), half)),
        F.concat("part", F.lit(">"), "cut", F.lit(">"), F.substring("word", -tail, tail)),
    )
    return cut.select(*rest, F.explode(keys).alias("part"))


def _parts(
    words: DataFrame, ws: Workspace, part_rows: int, first: int
) -> list[tuple[DataFrame, int]]:
    """The rows of the search, as (rows, level): parts cut by the first `level` counts, none with
    more than part_rows rows unless nothing is left to cut by."""
    rows = _with_vectors(words).select(
        "*",
        F.lit("").alias("part"),
        F.lit(1).alias("up"),
        F.lit(1).alias("down"),
        F.explode(F.array(F.lit(True), F.lit(False))).alias("home"),
    )
    for level in range(first):
        rows = _cut(rows, level)
    rows = ws.materialize(rows.drop("vector"), "parts")
    done, level = [], first
    while True:
        sizes = rows.groupBy("part").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("home").alias("at_home")
        )
        # Parts where no word is at home need not be asked.
        sizes = ws.materialize(sizes.filter("at_home > 0"), "sizes")
        large = sizes.filter(F.col("rows") > part_rows).select("part")
        last = level > GROUPS or large.isEmpty()
        small = sizes if last else sizes.filter(F.col("rows") <= part_rows)
        done.append((rows.join(small.select("part"), "part", "left_semi"), min(level, GROUPS)))
        if last:
            return done
        wide = rows.join(large, "part", "left_semi")
        if level < GROUPS:
            wide = _cut(_with_vectors(wide), level).drop("vector")
        else:
            wide = _halve(wide)
        rows = ws.materialize(wide, "parts")
        level += 1


class Trie:
    """Vectors as levels of nodes.  A node of a level is known by its parent and its count; the
    rows of a leaf lie together in `order`."""

    def __init__(self, rows: np.ndarray, start: np.ndarray, starts: int):
        """`start` numbers the root of each row, 0 to starts - 1."""
        self.order = np.lexsort([*rows.T[::-1], start])
        rows, node = rows[self.order], start[self.order]
        self.levels = []
        nodes = starts
        for counts in rows.T:
            key = node * self.BASE + counts
            keys, node = np.unique(key, return_inverse=True)
            parent = keys // self.BASE
            first = np.searchsorted(parent, np.arange(nodes + 1))
            self.levels.append((keys, first))
            nodes = len(keys)
        self.first = np.searchsorted(node, np.arange(nodes + 1))

    #: Above any count, so that parent and count make one number.
    BASE = 1 << 32

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position in `nodes`, child and count of every child."""
        keys, first = self.levels[level]
        at, child = _spread(first[nodes], first[nodes + 1])
        return at, child, keys[child] % self.BASE

    def child(self, level: int, nodes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child of each node with that count, and whether there is one."""
        keys, _ = self.levels[level]
        key = nodes * self.BASE + counts
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return at, keys[at] == key

    def rows(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position in `nodes` and row of every row of these leaves."""
        at, place = _spread(self.first[nodes], self.first[nodes + 1])
        return at, self.order[place]


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from low to below high, with the position of their interval."""
    size = high - low
    at = np.repeat(np.arange(len(low)), size)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    return at, low[at] + inside


def leaf_pairs(asking: Trie, holding: Trie, up: np.ndarray, down: np.ndarray) -> Iterator:
    """Pairs (asking leaf, holding leaf) whose vectors differ by the budget at most, in blocks.

    `up` and `down` are the budgets of the roots of `asking`; `holding` has one root.  Both tries
    are walked together, depth first: a block of node pairs with what is left of their budgets is
    taken from the stack, and the blocks of its children are put there."""
    depth = len(asking.levels)
    roots = np.arange(len(up))
    stack = [(0, roots, np.zeros_like(roots), up, down)]
    while stack:
        level, a, h, up, down = stack.pop()
        if level == depth:
            yield a, h
            continue
        at, child, counts = asking.children(level, a)
        found = []
        for step in (0, 1, -1):
            if step == 0:
                may = np.arange(len(at))
            elif step > 0:
                may = np.flatnonzero(up[at] > 0)
            else:
                may = np.flatnonzero((down[at] > 0) & (counts > 0))
            pair = at[may]
            other, there = holding.child(level, h[pair], counts[may] + step)
            may, pair = may[there], pair[there]
            found.append(
                (child[may], other[there], up[pair] - (step > 0), down[pair] - (step < 0))
            )
        columns = [np.concatenate(c) for c in zip(*found)]
        for k in range(0, len(columns[0]), BLOCK):
            stack.append((level + 1, *[c[k : k + BLOCK] for c in columns]))


class Halves:
    """Hashes of the halves of words.  Cut at half the length of the shorter word, one edit leaves
    the first or the last half as it is.  Each word has halves for its own length as the shorter
    one's and for one letter less."""

    def __init__(self, words: list[str]):
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        found = np.empty((2, 2, len(words)), dtype=np.int64)
        for less in (0, 1):
            cut = [(len(w) - less) // 2 for w in words]
            found[less, 0] = [hash(w[:k]) for w, k in zip(words, cut)]
            found[less, 1] = [hash(w[k + less :]) for w, k in zip(words, cut)]
        self.hash = found

    def of(self, rows: np.ndarray, shorter: np.ndarray, last: int) -> np.ndarray:
        return self.hash[(self.length[rows] > shorter).astype(np.int64), last, rows]


def _mixed(leaf: np.ndarray, kind: int, value: np.ndarray) -> np.ndarray:
    """One number of a leaf, a kind of half and its hash; equal ones of others are verified away."""
    left = (leaf.astype(np.uint64) * np.uint64(4) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (left ^ value.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def candidates(
    asking: Trie, holding: Trie, blocks: Iterator, ask: Halves, hold: Halves
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(asking row, holding row, shorter length, last) of the rows of leaf pairs that share a half;
    `last` tells whether it is the last half, the first ones being different.

    Holding rows are found by leaf and half, so that no pair of leaves is multiplied out."""
    at, rows = holding.rows(np.arange(len(holding.first) - 1))
    tables = {}
    for less in (0, 1):
        for last in (0, 1):
            key = _mixed(at, 2 * less + last, hold.hash[less, last, rows])
            order = np.argsort(key, kind="stable")
            tables[less, last] = key[order], rows[order]
    for a, h in blocks:
        # Words of one leaf have one length.
        own_length = ask.length[asking.order[asking.first[a]]]
        other_length = hold.length[holding.order[holding.first[h]]]
        shorter = np.minimum(own_length, other_length)
        less = (other_length > own_length).astype(np.int64)
        size = asking.first[a + 1] - asking.first[a]
        ends = np.concatenate([[0], np.cumsum(size)])
        low = 0
        while low < len(a):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + BLOCK, side="right")) - 1)
            at, row = asking.rows(a[low:high])
            leaf, cut, kind = h[low:high][at], shorter[low:high][at], less[low:high][at]
            low = high
            for last in (0, 1):
                value = ask.of(row, cut, last)
                for k in (0, 1):
                    own = np.flatnonzero(kind == k)
                    keys, held = tables[k, last]
                    key = _mixed(leaf[own], 2 * k + last, value[own])
                    start = np.searchsorted(keys, key)
                    hit, place = _spread(start, np.searchsorted(keys, key, side="right"))
                    one, two, size_of = row[own[hit]], held[place], cut[own[hit]]
                    if last:
                        new = ask.of(one, size_of, 0) != hold.of(two, size_of, 0)
                        one, two, size_of = one[new], two[new], size_of[new]
                    yield one, two, size_of, np.full(len(one), last)


def is_near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k, n = 0, len(a)
    while k < n and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def search_part(part: str, rows: pa.Table, level: int) -> pa.Table:
    """What the words that ask in one part find there: word, n_near, and the most frequent near word
    with its count."""
    home = rows.column("home").to_numpy()
    here, there = rows.filter(pa.array(home)), rows.filter(pa.array(~home))
    held, asked = here.column("word").to_pylist(), there.column("word").to_pylist()
    result = {"word": [], "n_near": [], "form": [], "form_n": []}
    if held and asked:
        n = here.column("n").to_numpy()
        # Most frequent first, ties in code-point order.
        ranked = sorted(range(len(held)), key=lambda k: (-n[k], held[k]))
        rank = np.empty(len(held), dtype=np.int64)
        rank[ranked] = np.arange(len(held))
        budget = there.column("up").to_numpy() * 2 + there.column("down").to_numpy()
        kinds, start = np.unique(budget, return_inverse=True)
        asking = Trie(vectors(asked)[:, level:], start, len(kinds))
        holding = Trie(vectors(held)[:, level:], np.zeros(len(held), dtype=np.int64), 1)
        blocks = leaf_pairs(asking, holding, kinds // 2, kinds % 2)
        # A part that is cut by halves answers only for its own half and length.
        half = next((mark for mark in "<>" if mark in part), None)
        cut = int(part.split(half)[1]) if half else 0
        found = np.zeros(len(asked), dtype=np.int64)
        best = np.full(len(asked), len(held), dtype=np.int64)
        for one, two, shorter, last in candidates(asking, holding, blocks, Halves(asked), Halves(held)):
            if half:
                own = (shorter == cut) & (last == (half == ">"))
                one, two = one[own], two[own]
            near = [is_near(asked[i], held[j]) for i, j in zip(one.tolist(), two.tolist())]
            near = np.array(near, dtype=bool)
            one, two = one[near], two[near]
            np.add.at(found, one, 1)
            np.minimum.at(best, one, rank[two])
        got = np.flatnonzero(found)
        form = [ranked[k] for k in best[got].tolist()]
        result = {
            "word": [asked[k] for k in got.tolist()],
            "n_near": found[got],
            "form": [held[k] for k in form],
            "form_n": n[form],
        }
    return pa.table(result, schema=_FOUND)


_FOUND = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())]
)


def _searcher(level: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        return search_part(key[0].as_py(), table, level)

    return run


def near_words(
    words: DataFrame, ws: Workspace, part_rows: int = PART_ROWS, first: int = FIRST
) -> DataFrame:
    """Of a written table (word, n) with distinct words: word, n_near, form and form_n of the words
    that have a near one; form is the most frequent of them."""
    answers = []
    for rows, level in _parts(words, ws, part_rows, first):
        answers.append(
            rows.groupBy("part").applyInArrow(
                _searcher(level), "word string, n_near long, form string, form_n long"
            )
        )
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (
        ws.materialize(found, "found")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))
    )


def follow(forms: DataFrame, ws: Workspace) -> DataFrame:
    """Of (word, form): word and root, the last of the chain of forms.  A form has RATIO times the
    count of its word, so that chains are shorter than 64 steps; each round doubles the step."""
    links = ws.materialize(forms.select("word", F.col("form").alias("root")), "links")
    for _ in range(6):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        step = ws.materialize(step, "links")
        if step.filter("moved").isEmpty():
            break
        links = step.drop("moved")
    return links


def group_variants(docs: DataFrame, ws: Workspace, **parts) -> DataFrame:
    """word, n, n_near, form, form_n and root of all words of `docs` (doc_id, text)."""
    words = ws.materialize(count_words(docs), "words")
    near = ws.materialize(near_words(words, ws, **parts), "near")
    known = words.join(near, "word", "left")
    is_form = F.col("form_n") >= RATIO * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    known = ws.materialize(known, "known")
    roots = follow(known.filter("form is not null").select("word", "form"), ws)
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = group_variants(docs, Workspace(spark))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
