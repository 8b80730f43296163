"""Drill-down into single cases: edges, steps and direct transfers between two accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.functions import paths


def case_edges(queue: DataFrame) -> DataFrame:
    """One row per hop of each case, numbered from 1; the path is closed if it is open."""
    return queue.select(
        "cycle_id", F.posexplode(paths.hops(F.col("accounts"))).alias("position", "hop")
    ).select(
        "cycle_id",
        (F.col("position") + 1).alias("step"),
        F.col("hop.source").alias("source"),
        F.col("hop.target").alias("target"),
    )


def case_steps(edges: DataFrame) -> DataFrame:
    return edges.select(
        "cycle_id",
        F.concat(F.lit("Transfer "), F.col("step").cast("string")).alias("transfer"),
        F.col("source").alias("sender"),
        F.col("target").alias("receiver"),
        F.concat("source", F.lit(" → "), "target").alias("flow"),
    )


def direct_edges(edges: DataFrame, a: str | None, b: str | None) -> DataFrame:
    """Hops between two chosen accounts in either direction; none unless they differ."""
    if not a or not b or a == b:
        return edges.limit(0)
    source, target = F.col("source"), F.col("target")
    return edges.where(
        ((source == a) & (target == b)) | ((source == b) & (target == a))
    )


def case_detail(queue: DataFrame) -> DataFrame:
    return queue.select(
        "cycle_id",
        F.col("cycle_length").alias("accounts"),
        F.size(paths.hops(F.col("accounts"))).alias("transfers"),
        "total_amount",
        "risk_score",
    )
