"""Near-duplicates by SimHash fingerprints, found with vantage-point trees.

A bit of a fingerprint is set where more than half of the hashes of a text's shingles have it set.
Texts whose fingerprints differ in few bits are linked; components of links are the groups.

Search works on distinct fingerprints:

1. The 64 bits are cut into one block more than the bits that may differ.  Two linked
   fingerprints agree in one block at least, so the distance within that block is zero and the
   triangle bound of any vantage point puts both into the same cell of that block's space.  The
   cells (block, value) are the shards; they need no overlap.
2. Should a shard be too large, a vantage-point tree on whole fingerprints, fitted to a bounded
   sample, cuts all shards further.  A fingerprint goes to every leaf that the triangle bound
   |d(x, v) - radius| <= max_bits does not exclude, that is, also to the neighbouring shards whose
   boundary it is close to.
3. In a shard, again a vantage-point tree: the half inside a radius, the half outside, the near
   ones of each tried against the other.  Only leaves compare fingerprints, all of them exactly.

A shard reports one link per fingerprint that has any, to the smallest of its component there;
the components of these links are those of all pairs.  So a group of near copies never becomes
pairs.

A null text counts as empty, and a text without words has the fingerprint zero.  Texts are read whole,
whatever their length.  Rows that repeat have one fingerprint.  An empty table gives an empty result.
Stages pass on other columns, whatever their names and types.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloop.llm.common import OWN, Workspace, any_columns, read_table, share, sort_key
from ledgerloop.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: Fingerprints of a shard above which all shards are cut by the upper tree.
SHARD_ROWS = 200_000
#: Fingerprints the upper tree is fitted to.
SAMPLE = 50_000
#: Rows that one call of the search gets, unless one shard alone has more.
CALL_ROWS = 100_000
LEAF = 256


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, unsigned.  No words (or null): 0; fewer than a shingle: the words there are."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = [0, *(ends[: n - shingle_words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle_words - 1 :].tolist())],
        dtype=np.uint64,
    )
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 100_000):
        bits = np.unpackbits(hashes[k : k + 100_000].view(np.uint8), bitorder="little")
        votes += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    chosen = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(chosen.view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, name: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with the fingerprint of its text as a signed long."""

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signed)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, T.StructType(docs.schema.fields[:]).add(name, "long"))


def block_masks(blocks: int) -> list[int]:
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


class UpperTree:
    """A complete vantage-point tree; node k has the children 2k + 1 (inside) and 2k + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.depth = depth
        inner = (1 << depth) - 1
        self.vantage = np.zeros(inner, dtype=np.uint64)
        self.radius = np.full(inner, 64, dtype=np.int64)
        own = {0: sample}
        for k in range(inner):
            here = own.pop(k, sample[:0])
            if len(here):
                self.vantage[k] = here[rng.integers(len(here))]
                d = distance(here, self.vantage[k])
                self.radius[k] = int(np.median(d))
                own[2 * k + 1] = here[d <= self.radius[k]]
                own[2 * k + 2] = here[d > self.radius[k]]

    def places(self, x: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
        """Every (row, leaf) that the triangle bound does not exclude for a distance of `near`.

        Of two rows within `near`, on different sides of a radius, the outer one is within
        `near` of it, so it alone is sent to both sides."""
        row, node = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        visitor = np.zeros(len(x), dtype=bool)
        for _ in range(self.depth):
            d = distance(x[row], self.vantage[node])
            r = self.radius[node]
            inside = d <= r
            in_too = ~inside & (d - near <= r)
            out_too = inside & visitor & (d + near > r)
            row = np.concatenate([row, row[in_too], row[out_too]])
            visitor_next = np.concatenate([visitor, np.ones(in_too.sum() + out_too.sum(), bool)])
            node = np.concatenate(
                [
                    np.where(inside, 2 * node + 1, 2 * node + 2),
                    2 * node[in_too] + 1,
                    2 * node[out_too] + 2,
                ]
            )
            visitor = visitor_next
        return row, node - ((1 << self.depth) - 1)


def _all_links(x: np.ndarray, own: np.ndarray, guests: np.ndarray, near: int, out: list) -> None:
    """Links among own rows, and of guests with own rows, block by block; of each row one link to
    every component of own rows it touches."""
    for k in range(0, len(own), LEAF):
        block = own[k : k + LEAF]
        for others in (own[k:], guests):
            for j in range(0, len(others), 16 * LEAF):
                part = others[j : j + 16 * LEAF]
                a, b = np.nonzero(distance(x[block][:, None], x[part][None, :]) <= near)
                if len(a):
                    link = block[a] != part[b]
                    out.append(_thin(block[a][link], part[b][link]))


def _thin(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As many links as there are rows at most, with the same components."""
    if len(a) < 4 * LEAF:
        return np.stack([a, b])
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = local_components(len(nodes), where[: len(a)], where[len(a) :])
    move = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[label[move]], nodes[move]])


def tree_links(
    x: np.ndarray, own: np.ndarray, guests: np.ndarray, near: int, rng, out: list
) -> None:
    """Links of own rows with own rows and with guests, by a vantage-point tree over own rows."""
    while len(own) > LEAF:
        vantage = x[own[rng.integers(len(own))]]
        d = distance(x[own], vantage)
        radius = int(np.median(d))
        inside = d <= radius
        if inside.all():
            radius = int(d.max()) - 1
            inside = d <= radius
            if not inside.any():
                break  # all at one distance: nothing to cut by
        g = distance(x[guests], vantage)
        near_in = np.concatenate([guests[g - near <= radius], own[~inside & (d - near <= radius)]])
        tree_links(x, own[inside], near_in, near, rng, out)
        own, guests = own[~inside], guests[g + near > radius]
    _all_links(x, own, guests, near, out)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def shard_links(key: np.ndarray, x: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Of fingerprints sorted by shard: for each that has a link within its shard, a link to the
    first of its component."""
    found: list[np.ndarray] = []
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    rng = np.random.default_rng(3)
    for start, size in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist()):
        tree_links(x, np.arange(start, start + size), np.arange(0), near, rng, found)
    small = np.repeat(sizes <= LEAF, sizes)
    left = np.flatnonzero(np.repeat(np.cumsum(sizes) - 1, sizes) > np.arange(len(key)))
    left = left[small[left]]
    last = np.repeat(np.cumsum(sizes) - 1, sizes)
    shift = 1
    while len(left):
        other = left + shift
        hit = distance(x[left], x[other]) <= near
        if hit.any():
            found.append(np.stack([left[hit], other[hit]]))
        shift += 1
        left = left[left + shift <= last[left]]
    if not found:
        return np.arange(0), np.arange(0)
    links = np.concatenate(found, axis=1)
    label = local_components(len(x), links[0], links[1])
    node = np.flatnonzero(label != np.arange(len(x)))
    return label[node], node


def link_fingerprints(
    distinct: DataFrame, ws: Workspace, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Of a table of distinct fingerprints (fp long): (node, root) of all that have a link."""
    spark = distinct.sparkSession
    blocks = min(max_bits + 1, 64)
    masks = np.array(block_masks(blocks), dtype=np.uint64)
    total = distinct.count()
    values = F.array(*[F.col("fp").bitwiseAND(int(m.astype(np.int64))) for m in masks])
    largest = (
        distinct.select(F.posexplode(values).alias("block", "value"))
        .groupBy("block", "value")
        .count()
        .agg(F.max("count"))
        .first()[0]
        or 0
    )
    depth = max(0, int(largest // shard_rows).bit_length())
    sample = (
        np.array(
            [r.fp for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()],
            dtype=np.int64,
        ).view(np.uint64)
        if depth
        else np.zeros(0, dtype=np.uint64)
    )
    tree = share(spark, UpperTree(sample, depth))
    calls = max(1, -(-total * blocks // CALL_ROWS))

    def deal(batches: Iterator) -> Iterator[pa.RecordBatch]:
        upper = tree()
        for batch in batches:
            x = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            row, leaf = upper.places(x, max_bits)
            for block, mask in enumerate(masks):
                value = (x[row] & mask).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), block, dtype=np.int32)),
                        pa.array(value),
                        pa.array(leaf.astype(np.int64)),
                        pa.array(x[row].view(np.int64)),
                    ],
                    names=["block", "value", "leaf", "fp"],
                )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort((group["leaf"], group["value"], group["block"]))
        shard = group[["block", "value", "leaf"]].to_numpy()[order]
        x = group["fp"].to_numpy()[order].view(np.uint64)
        new = np.append(False, (shard[1:] != shard[:-1]).any(axis=1))
        a, b = shard_links(np.cumsum(new), x, max_bits)
        return pd.DataFrame({"a": x[a].view(np.int64), "b": x[b].view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "block int, value long, leaf long, fp long")
    call = F.pmod(F.xxhash64("block", "value", "leaf"), F.lit(calls))
    links = dealt.withColumn("call", call).groupBy("call").applyInPandas(search, "a long, b long")
    return components(ws.materialize(links, "shard-links"), ws)


def groups_of(prints: DataFrame, ws: Workspace, max_bits: int = MAX_BITS, **kw) -> DataFrame:
    """Of a written table (doc_id, fp): one row per fingerprint with component_id, the smallest
    doc_id of its component, root, and first, its own smallest doc_id.  Null ids have no part in the smallest; a component
    without any id has a null component_id."""
    distinct = ws.materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = link_fingerprints(distinct, ws, max_bits, **kw)
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    placed = ws.materialize(placed, "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    least = ws.materialize(least, "least")
    joined = placed.join(least, "root").select("fp", "root", "component_id", "first")
    return ws.materialize(joined, "groups")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    ws = Workspace(spark)
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    prints = ws.materialize(with_fingerprint(docs, "fp").select("doc_id", "fp"), "prints")
    groups = groups_of(prints, ws).drop("root", "first")
    return prints.join(groups, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@any_columns
def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group: the one with the smallest id, and of its rows in the group the
    one with the smallest fingerprint, then the smallest in all columns.  Documents without an id
    stay only where their whole group has none, one row per group."""
    ws = Workspace(spark)
    small = docs.select("doc_id", "text")
    prints = ws.materialize(with_fingerprint(small, "fp").select("doc_id", "fp"), "prints")
    groups = groups_of(prints, ws)
    keep = groups.filter("first = component_id").groupBy("root").agg(
        F.first("component_id").alias(f"{OWN}id"), F.min("fp").alias(f"{OWN}keep")
    )
    keep = ws.materialize(keep, "keep")
    # Ids whose rows differ in their fingerprints, and so may lie in several groups.
    several = (
        prints.filter("doc_id is not null")
        .groupBy(F.col("doc_id").alias(f"{OWN}id"))
        .agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .filter("low <> high")
        .select(f"{OWN}id")
    )
    several = ws.materialize(several, "several")

    def one_row(rows: DataFrame, *key: str) -> DataFrame:
        order = Window.partitionBy(*key).orderBy(*[sort_key(docs, c) for c in docs.columns])
        rows = rows.withColumn(f"{OWN}rank", F.row_number().over(order))
        return rows.filter(F.col(f"{OWN}rank") == 1)

    # The hint: one plan at every size, whose shuffle is that of the texts.
    single = keep.join(several, f"{OWN}id", "left_anti").hint("merge")
    named = docs.join(single, docs["doc_id"] == single[f"{OWN}id"], "left_semi")
    named = one_row(named, "doc_id")
    # Few ids repeat with other texts; no hint, so that few are not joined by a shuffle of all texts.
    mixed = docs.join(several, docs["doc_id"] == several[f"{OWN}id"], "left_semi")
    mixed = with_fingerprint(mixed, f"{OWN}fp")
    of_group = (mixed["doc_id"] == keep[f"{OWN}id"]) & (mixed[f"{OWN}fp"] == keep[f"{OWN}keep"])
    mixed = one_row(mixed.join(keep, of_group, "left_semi"), "doc_id", f"{OWN}fp")
    nameless = with_fingerprint(docs.filter("doc_id is null"), f"{OWN}fp")
    alone = groups.filter("component_id is null").select(
        F.col("fp").alias(f"{OWN}fp"), F.col("root").alias(f"{OWN}root")
    )
    nameless = one_row(nameless.join(alone, f"{OWN}fp"), f"{OWN}root")
    kept = [rows.select(*docs.columns) for rows in (named, mixed, nameless)]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])
