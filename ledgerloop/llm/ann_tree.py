"""Nearest neighbours with a hierarchical k-means tree and best-bin-first search.

The tree is fitted to a bounded sample; every vector is then filed under the leaf that it reaches by
always going to the nearest centre.  A query keeps a priority queue of branches by the distance
to their centres and opens the nearest one first, so it lists leaves in the order it would visit
them.  How many it visits is calibrated: for a bounded number of queries the true neighbours are
found by comparing with every vector, and visits are widened until the target share of them lies in
the visited leaves.  Where these hold fewer than k vectors besides those with the query's id, the
query goes on until they hold k.  Distances are those of the original vectors, in double precision.

A leaf with many vectors is cut into blocks, each of which meets the leaf's queries on its own;
only the best of each block go on.

Vectors that are null, all zero, or hold null or non-finite components take no part, neither do
those without an id and those whose length is not the commonest one (the smaller of equally common
ones).  Rows that repeat an id are vectors of their own; all rows with the query's id are left out.

Ties in distance go to the smaller vec_id.  An empty table gives an empty result.  Only vec_id and
embedding are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace, read_table, share

K = 10
QUERY_STEP = 100
#: Bounds of the sample the tree is fitted to: rows, and components in all.
SAMPLE_ROWS = 40_000
SAMPLE_NUMBERS = 16_000_000
BRANCHES = 8
#: A node of the sample is split further while it has more than this and its share of LEAVES, so the
#: number of leaves does not grow with the table.
LEAF_SAMPLE = 48
LEAVES = 100
#: Queries that calibrate the number of visits, and the share of true neighbours aimed at.
CALIBRATION = 256
TARGET_RECALL = 0.96
#: Components of a leaf's vectors that are searched together.
BLOCK_NUMBERS = 2_000_000
SEED = 7


@dataclass
class Tree:
    """Centres by node; children of a node are consecutive.  A node without children is a leaf."""

    centres: np.ndarray
    first_child: np.ndarray
    n_children: np.ndarray
    leaf: np.ndarray
    n_leaves: int

    @classmethod
    def fit(cls, sample: np.ndarray) -> Tree:
        rng = np.random.default_rng(SEED)
        dim = sample.shape[1]
        centres = [sample.mean(axis=0) if len(sample) else np.zeros(dim)]
        first, count = [0], [0]
        queue = [(0, np.arange(len(sample)))]
        small = max(LEAF_SAMPLE, len(sample) // LEAVES)
        while queue:
            node, own = queue.pop(0)
            if len(own) <= small:
                continue
            middles, of_row = _k_means(sample[own], BRANCHES, rng)
            if len(middles) < 2:
                continue
            first[node], count[node] = len(centres), len(middles)
            for k, middle in enumerate(middles):
                queue.append((len(centres), own[of_row == k]))
                centres.append(middle)
                first.append(0)
                count.append(0)
        n_children = np.array(count)
        leaf = np.where(n_children == 0, np.cumsum(n_children == 0) - 1, -1)
        return cls(np.array(centres), np.array(first), n_children, leaf, int(leaf.max()) + 1)

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(x), dtype=np.int64)
        open_ = np.flatnonzero(self.n_children[node] > 0)
        while len(open_):
            order = open_[np.argsort(node[open_], kind="stable")]
            edges = np.flatnonzero(np.diff(node[order], prepend=-1))
            for rows in np.split(order, edges[1:]):
                k = node[rows[0]]
                a = self.first_child[k]
                middle = self.centres[a : a + self.n_children[k]]
                near = (middle**2).sum(axis=1) - 2 * x[rows] @ middle.T
                node[rows] = a + near.argmin(axis=1)
            open_ = open_[self.n_children[node[open_]] > 0]
        return self.leaf[node]

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            n = self.n_children[node]
            if not n:
                yield int(self.leaf[node])
                continue
            a = self.first_child[node]
            far = ((self.centres[a : a + n] - query) ** 2).sum(axis=1)
            for k, d in enumerate(far.tolist()):
                heapq.heappush(queue, (d, int(a) + k))


def _k_means(x: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    middles = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(8):
        far = (middles**2).sum(axis=1) - 2 * x @ middles.T
        own = far.argmin(axis=1)
        used, own = np.unique(own, return_inverse=True)
        middles = np.array([x[own == j].mean(axis=0) for j in range(len(used))])
    far = (middles**2).sum(axis=1) - 2 * x @ middles.T
    used, own = np.unique(far.argmin(axis=1), return_inverse=True)
    return middles[used], own


def nearest(
    queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k nearest rows: (position of the query, id, distance).

    A matrix product tells which rows can be among them; their distances are then computed one
    component at a time, and ties go to the smaller id."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    norms = (x**2).sum(axis=1)
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        own = (part**2).sum(axis=1)
        square = own[:, None] + norms[None, :] - 2 * part @ x.T
        square[ids[None, :] == query_ids[start : start + 256, None]] = np.inf
        if len(x) > k:
            kth = np.partition(square, k - 1, axis=1)[:, k - 1]
        else:
            kth = np.full(len(part), np.inf)
        # Far above the rounding error of the product.
        slack = 1e-9 * (own + norms.max(initial=0))
        for q in range(len(part)):
            near = np.flatnonzero((square[q] <= kth[q] + slack[q]) & np.isfinite(square[q]))
            exact = np.sqrt(((x[near] - part[q]) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], exact))[:k]
            found.append((np.full(len(best), start + q), ids[near][best], exact[best]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(column) for column in zip(*found))


def valid_vectors(table: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and v (array of double) of the vectors that take part, and their length."""
    v = F.col("embedding").cast("array<double>")
    fine = (
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & F.exists(v, lambda c: c != 0)
    )
    good = table.filter(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("dim")
    )
    common = good.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    return good.filter(F.col("dim") == dim).drop("dim"), dim


def _matrix(column, dim: int) -> np.ndarray:
    """Of a binary column with doubles: rows by components."""
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(-1, max(dim, 1))


def build_index(table: DataFrame, ws: Workspace) -> tuple[DataFrame, Tree, int]:
    """A written table of leaf, vec_id and v (doubles as bytes), the tree, and the length."""
    spark = table.sparkSession
    good, dim = valid_vectors(table)
    rows = min(SAMPLE_ROWS, SAMPLE_NUMBERS // max(dim, 1))
    sample = good.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(rows)
    points = np.array([r.v for r in sample.select("v").collect()]).reshape(-1, max(dim, 1))
    tree = Tree.fit(points)
    shared = share(spark, tree)

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        tree = shared()
        for batch in batches:
            x = batch.column("v").flatten().to_numpy().reshape(-1, max(dim, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tree.file(x).astype(np.int32)),
                    batch.column("vec_id"),
                    pa.array([row.astype("<f8").tobytes() for row in x], pa.binary()),
                ],
                names=["leaf", "vec_id", "v"],
            )

    index = good.mapInArrow(run, "leaf int, vec_id long, v binary")
    return ws.materialize(index, "ann-index"), tree, dim


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "copy").orderBy("score", "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def calibrate(index: DataFrame, tree: Tree, dim: int, queries: DataFrame, k: int) -> int:
    """The leaf visits with which the true neighbours of sampled queries are found as often as
    aimed at.  Every vector is compared with them, partition by partition."""
    chosen = queries.orderBy(F.xxhash64("vec_id", F.lit(SEED + 1)), "vec_id").limit(CALIBRATION)
    asked = sorted((r.vec_id, bytes(r.v)) for r in chosen.collect())
    if not asked:
        return 1
    points = _matrix([v for _, v in asked], dim)
    ids = np.array([i for i, _ in asked])
    shared = share(index.sparkSession, (points, ids))

    def run(batches: Iterator) -> Iterator[pa.RecordBatch]:
        points, ids = shared()
        for batch in batches:
            own = batch.column("vec_id").to_numpy(zero_copy_only=False)
            leaf = batch.column("leaf").to_numpy(zero_copy_only=False)
            x = _matrix(batch.column("v").to_pylist(), dim)
            q, found, score = nearest(points, ids, x, own, k)
            of_id = dict(zip(own.tolist(), leaf.tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[q]),
                    pa.array(q.astype(np.int32)),
                    pa.array(found.astype(np.int64)),
                    pa.array(score),
                    pa.array([of_id[i] for i in found.tolist()], pa.int32()),
                ],
                names=["query_id", "copy", "vec_id", "score", "leaf"],
            )

    true = _best(
        index.mapInArrow(run, "query_id long, copy int, vec_id long, score double, leaf int"), k
    )
    wanted: dict[int, list[int]] = {}
    for row in true.select("copy", "leaf").collect():
        wanted.setdefault(row["copy"], []).append(row["leaf"])
    ranks: list[int] = []
    for q, leaves in wanted.items():
        place = {leaf: rank for rank, leaf in enumerate(tree.visits(points[q]))}
        ranks += [place[leaf] for leaf in leaves]
    if not ranks:
        return 1
    return int(np.quantile(ranks, TARGET_RECALL, method="higher")) + 1


def search(
    index: DataFrame, tree: Tree, dim: int, queries: DataFrame, ws: Workspace, k: int = K
) -> DataFrame:
    """query_id, copy (tells rows of one query id apart), rank, vec_id, score."""
    spark = index.sparkSession
    visits = calibrate(index, tree, dim, queries, k)
    # One number per leaf; there are no more than the sample has rows.
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    block = max(1, BLOCK_NUMBERS // max(dim, 1))
    blocks = np.array([-(-sizes.get(leaf, 0) // block) for leaf in range(tree.n_leaves)])
    filled = np.array([sizes.get(leaf, 0) for leaf in range(tree.n_leaves)])
    shared = share(spark, (tree, blocks, filled))

    def deal(batches: Iterator) -> Iterator[pa.RecordBatch]:
        tree, blocks, filled = shared()
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()
            copies, own = batch.column("copy").to_pylist(), batch.column("own").to_pylist()
            for start in range(0, len(ids), 64):
                rows = []
                for i in range(start, min(start + 64, len(ids))):
                    query = np.frombuffer(vectors[i], "<f8")
                    left_out = {o["leaf"]: o["n"] for o in own[i] or ()}
                    held = 0
                    for n, leaf in enumerate(tree.visits(query)):
                        if n >= visits and held >= k:
                            break
                        held += filled[leaf] - left_out.get(leaf, 0)
                        rows += [
                            (leaf, b, ids[i], copies[i], vectors[i]) for b in range(blocks[leaf])
                        ]
                leaf, block, query_id, copy, v = zip(*rows) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leaf, pa.int32()),
                        pa.array(block, pa.int32()),
                        pa.array(query_id, pa.int64()),
                        pa.array(copy, pa.int64()),
                        pa.array(v, pa.binary()),
                    ],
                    names=["leaf", "block", "query_id", "copy", "v"],
                )

    def meet(asked: pd.DataFrame, filed: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(filed):
            return pd.DataFrame({c: [] for c in ("query_id", "copy", "vec_id", "score")})
        q, found, score = nearest(
            _matrix(asked["v"], dim),
            asked["query_id"].to_numpy(),
            _matrix(filed["v"], dim),
            filed["vec_id"].to_numpy(),
            k,
        )
        return pd.DataFrame(
            {
                "query_id": asked["query_id"].to_numpy()[q],
                "copy": asked["copy"].to_numpy()[q],
                "vec_id": found,
                "score": score,
            }
        )

    # Per id how many of its rows each leaf holds; there are no more leaves than the sample has rows.
    per_leaf = index.groupBy("vec_id", "leaf").agg(F.count(F.lit(1)).alias("n"))
    own_rows = ws.materialize(
        per_leaf.groupBy("vec_id").agg(F.collect_list(F.struct("leaf", "n")).alias("own")), "ann-own"
    )
    known = queries.select("vec_id", "copy", "v").join(own_rows, "vec_id", "left")
    asked = known.select("vec_id", "copy", "v", "own").mapInArrow(
        deal, "leaf int, block int, query_id long, copy long, v binary"
    )
    of_leaf = F.element_at(F.array(*[F.lit(int(max(b, 1))) for b in blocks]), F.col("leaf") + 1)
    filed = index.withColumn("block", F.pmod(F.xxhash64("vec_id"), of_leaf).cast("int"))
    met = (
        asked.groupBy("leaf", "block")
        .cogroup(filed.groupBy("leaf", "block"))
        .applyInPandas(meet, "query_id long, copy long, vec_id long, score double")
    )
    return _best(ws.materialize(met, "ann-candidates"), k)


def op4_ann_tree(spark: SparkSession, folder: str) -> DataFrame:
    ws = Workspace(spark)
    index, tree, dim = build_index(read_table(spark, folder, "embeddings"), ws)
    queries = index.filter(F.col("vec_id") % QUERY_STEP == 0)
    # The written rows number the copies of an id alike in each run of a task.
    queries = ws.materialize(
        queries.withColumn("copy", F.monotonically_increasing_id()), "ann-queries"
    )
    found = search(index, tree, dim, queries, ws)
    return found.select("query_id", "rank", "vec_id", "score")
