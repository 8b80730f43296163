"""Property-graph tables: account nodes, transfer edges and idempotent merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.functions.text import bank_of
from ledgerloop.operators.motifs import adapt_edges
from ledgerloop.schema import AMOUNT

NODE_LABEL = "Account"  # fixed value

EDGE_COLUMNS = (
    "source_account",
    "target_account",
    "amount",
    "timestamp",
    "transaction_type",
    "is_laundering",
)


def export_edges(df: DataFrame) -> DataFrame:
    """Distinct edges on all six columns, without self-loops and missing accounts.

    Amounts and labels that are not numbers count as 0.
    """
    adapted = adapt_edges(df)
    return adapted.select(
        F.col("src").alias("source_account"),
        F.col("dst").alias("target_account"),
        F.coalesce("amount", F.lit(0)).cast(AMOUNT).alias("amount"),
        "timestamp",
        "transaction_type",
        F.coalesce("is_laundering", F.lit(0)).alias("is_laundering"),
    ).distinct()


def export_nodes(edges: DataFrame) -> DataFrame:
    """Distinct accounts of the edges with their bank."""
    return (
        edges.select(F.explode(F.array("source_account", "target_account")).alias("account_id"))
        .distinct()
        .select(
            "account_id",
            bank_of(F.col("account_id")).alias("bank_id"),
            F.lit(NODE_LABEL).alias("label"),
        )
    )


def not_in(new: DataFrame, old: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    n, o = new.alias("n"), old.alias("o")
    same = reduce(
        lambda x, y: x & y, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns]
    )
    return n.join(o, same, "left_anti")


def merge_nodes(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing nodes plus the new ones; (account_id, bank_id) is the key."""
    key = ("account_id", "bank_id")
    return existing.unionByName(not_in(incoming.dropDuplicates(list(key)), existing, key))


def merge_edges(existing: DataFrame, incoming: DataFrame, nodes: DataFrame) -> DataFrame:
    """Existing edges plus the new ones between known accounts; all six columns are the key.

    `nodes` is best a written table: its joins then have plain exchanges, which adaptive
    execution can split at a hot account.
    """
    known = known_edges(incoming, nodes)
    return existing.select(*EDGE_COLUMNS).unionByName(not_in(known, existing, EDGE_COLUMNS))


def known_edges(incoming: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct edges between known accounts."""
    accounts = nodes.select("account_id")
    return (
        incoming.select(*EDGE_COLUMNS)
        .join(accounts.withColumnRenamed("account_id", "source_account"), "source_account", "left_semi")
        .join(accounts.withColumnRenamed("account_id", "target_account"), "target_account", "left_semi")
        .select(*EDGE_COLUMNS)
        .distinct()
    )
