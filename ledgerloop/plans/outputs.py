"""Motif search and property-graph export as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloop.operators import cases, export, motifs
from ledgerloop.plans.workspace import Workspace
from ledgerloop.sources.readers import read_cases
from ledgerloop.sources.writers import write_single_csv, write_table

NODES_TABLE = "accounts_nodes"
EDGES_TABLE = "transactions_edges"
MOTIF_TABLE = "spark_detected_cycles"


def write_motifs(
    spark: SparkSession,
    edges: DataFrame,
    folder: str,
    max_export_rows: int | None = None,
    fmt: str = "csv",
) -> dict[int, int]:
    """Export two- and three-account cycles, all or the first; returns how many there are of each."""
    with Workspace(spark) as ws:
        counts = {
            row["cycle_length"]: int(row["cycles"]) for row in motifs.motif_counts(edges, ws).collect()
        }
        rows = motifs.motif_export(edges, ws, max_export_rows)
        write_table(rows, f"{folder.rstrip('/')}/{MOTIF_TABLE}", fmt)
    return counts


def download_cases(
    spark: SparkSession,
    cases_path: str,
    target: str,
    fmt: str = "csv",
    min_amount: float = 0.0,
    min_score: float = 0.0,
    lengths: tuple[int, int] | None = None,
    **chosen,
) -> None:
    """The filtered case queue, most urgent first, as one CSV file; a header alone where no case is
    left.  `chosen`: risks, priorities, statuses (see cases.filter_membership)."""
    queue = cases.case_queue(read_cases(spark, cases_path, fmt))
    kept = cases.filter_numeric(queue, min_amount, min_score, lengths)
    kept = cases.order_queue(cases.filter_membership(kept, **chosen)).drop("accounts")
    with Workspace(spark) as ws:
        write_single_csv(kept, target, ws)


def write_property_graph(
    spark: SparkSession, transfers: DataFrame, folder: str, fmt: str = "csv"
) -> None:
    """Node and edge tables; the distinct edges are computed once for both."""
    folder = folder.rstrip("/")
    with Workspace(spark) as ws:
        edges = ws.materialize(export.export_edges(transfers), "export-edges")
        write_table(
            export.export_nodes(edges).orderBy("account_id"), f"{folder}/{NODES_TABLE}", fmt
        )
        write_table(edges, f"{folder}/{EDGES_TABLE}", fmt)
