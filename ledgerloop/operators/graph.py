"""The account graph: labelled neighbourhood, pairs, nodes and summaries.

Accounts may be heavily skewed, so every aggregation here combines on the map side and no
row ever holds an unbounded group.  A table that is aggregated by the join key is written
before the join: joined in place it would share the exchange of the aggregation, and adaptive
execution splits a hot key only between two plain exchanges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.operators.cleaning import graph_edges
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import AMOUNT, TOTAL


def endpoints(edges: DataFrame, name: str = "account_id") -> DataFrame:
    """Distinct accounts on either side of an edge, in one pass."""
    return (
        edges.select(F.explode(F.array("source_account", "target_account")).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
    )


def labelled_accounts(edges: DataFrame) -> DataFrame:
    return endpoints(edges.where(F.col("is_laundering") == 1))


def labelled_subgraph(
    edges: DataFrame, ws: Workspace, require_labels: bool = False
) -> DataFrame:
    """Edges that touch a labelled account on either side, each once.

    Two left outer joins instead of an IN ... OR IN ... filter: the existence joins of the
    latter cannot be split when one account holds a large share of the edges.
    """
    accounts, found = ws.materialize_counted(labelled_accounts(edges), "labelled-accounts")
    if require_labels and not found:
        raise ValueError("no labelled accounts in the input")
    sources = accounts.select(F.col("account_id").alias("_labelled_source"))
    targets = accounts.select(F.col("account_id").alias("_labelled_target"))
    return (
        edges.join(sources, F.col("source_account") == F.col("_labelled_source"), "left")
        .join(targets, F.col("target_account") == F.col("_labelled_target"), "left")
        .where(F.col("_labelled_source").isNotNull() | F.col("_labelled_target").isNotNull())
        .select(*edges.columns)
    )


def label_totals(edges: DataFrame) -> DataFrame:
    totals = edges.agg(
        F.count(F.lit(1)).alias("edge_rows"),
        F.count_if(F.col("is_laundering") == 1).alias("labelled_rows"),
    )
    accounts = labelled_accounts(edges).agg(F.count(F.lit(1)))
    return totals.select("*", accounts.scalar().alias("labelled_accounts"))


def detection_input(transfers: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Complete rows without self-loops.

    `max_rows` takes the earliest rows first; it changes the answer and is off by default.
    """
    capped = transfers
    if max_rows:
        capped = transfers.orderBy("timestamp", "transaction_id").limit(max_rows)
    return graph_edges(
        capped.dropna(subset=["source_account", "target_account", "amount", "timestamp"])
    )


def detection_profile(edges: DataFrame) -> DataFrame:
    return edges.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("source_account").alias("source_accounts"),
        F.count_distinct("target_account").alias("target_accounts"),
        F.coalesce(F.sum("is_laundering"), F.lit(0)).alias("labelled_rows"),
    )


def edge_pairs(edges: DataFrame) -> DataFrame:
    """Parallel transfers collapsed to one row per (source, target).

    `first` is the earliest transfer, ties broken by its id.
    """
    first = F.min(F.struct("timestamp", "transaction_id", "amount", "transaction_type"))
    return (
        edges.groupBy("source_account", "target_account")
        .agg(
            first.alias("first"),
            F.count(F.lit(1)).alias("n_transfers"),
            F.sum("amount").cast(TOTAL).alias("total_amount"),
        )
        .select(
            F.col("source_account").alias("src"),
            F.col("target_account").alias("dst"),
            "first",
            "n_transfers",
            "total_amount",
        )
    )


def first_transfers(edges: DataFrame) -> DataFrame:
    """Earliest transfer of each (source, target)."""
    first = F.min(F.struct("timestamp", "transaction_id", "amount"))
    return (
        edges.groupBy("source_account", "target_account")
        .agg(first.alias("first"))
        .select(
            F.col("source_account").alias("src"),
            F.col("target_account").alias("dst"),
            F.col("first.transaction_id").alias("transaction_id"),
            F.col("first.timestamp").alias("timestamp"),
            F.col("first.amount").cast(AMOUNT).alias("amount"),
        )
    )


def pair_transfer_lists(edges: DataFrame) -> DataFrame:
    """Every transfer under its pair, one row each; edge_pairs has the totals.

    There is no array, so a pair may have any number of transfers.
    """
    return edges.select(
        F.col("source_account").alias("src"),
        F.col("target_account").alias("dst"),
        "timestamp",
        "transaction_id",
        "amount",
        "transaction_type",
    )


def graph_summary(edges: DataFrame) -> DataFrame:
    """Accounts, distinct pairs and directed density."""
    nodes = endpoints(edges).agg(F.count(F.lit(1)).alias("nodes"))
    pairs = (
        edges.select("source_account", "target_account")
        .distinct()
        .agg(F.count(F.lit(1)))
    )
    possible = F.col("nodes").cast("double") * (F.col("nodes") - 1)
    return nodes.select("nodes", pairs.scalar().alias("edges")).select(
        "nodes",
        "edges",
        F.when((F.col("edges") == 0) | (F.col("nodes") <= 1), 0.0)
        .otherwise(F.col("edges") / possible)
        .alias("density"),
    )
