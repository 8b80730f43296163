"""Connected components of an edge table, without any group in one task.

Alternates two steps until only stars are left: each node links its larger neighbours to the smallest
node it sees, then its smaller neighbours and itself.  The smallest neighbour is a grouped minimum
(combined before the shuffle); it meets the edges again in a join of two written tables, of which
Spark can split a hot side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.llm.common import Workspace

MAX_ROUNDS = 60


def _star(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """edges: (u, v), v != u.  Links every v, and u itself, to the smallest of v and u."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("m"))
    joined = edges.join(ws.materialize(least, f"{name}-least"), "u")
    return ws.materialize(joined.select("u", "v", "m"), name)


def _only_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node, and none to it, or none to a smaller one.

    Steps keep what is connected together, so that the smaller ends are then the roots."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return nodes.filter("up > 0 and n > 1").isEmpty()


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """Of (a, b) links of longs: (node, root) for every node that has a link, root the smallest
    node of its component.  Nulls must not occur; repeated and reversed links do no harm."""
    now = edges.filter("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now = ws.materialize(now.distinct(), "links")
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(ws.materialize(both, "both-ways"), ws, "large-star")
        linked = large.filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _star(ws.materialize(linked.distinct(), "large-links"), ws, "small-star")
        to_least = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        self_links = small.filter("u != m").select("u", F.col("m").alias("v"))
        now = ws.materialize(to_least.unionByName(self_links).distinct(), "small-links")
        if _only_stars(now):
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            itself = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return ws.materialize(roots.unionByName(itself), "roots")
    raise RuntimeError("components did not settle")
