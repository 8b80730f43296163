"""Steps of the batch analysis, each readable and writable on its own."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.operators import cleaning, cycles, graph, scoring
from ledgerloop.operators.ordinal import with_file_order
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import TRANSFER
from ledgerloop.sources.readers import read_raw, read_transfers
from ledgerloop.sources.writers import write_table

STEPS = ("clean", "subgraph", "detect", "demo", "detect-demo", "all")

DEMO_ROWS = 100

# The injected loop (source, target, amount, minutes after the first row).
DEMO_LOOP = (
    ("DEMO_CYCLE_001", "DEMO_ACC_A", "DEMO_ACC_B", 100000, 0),
    ("DEMO_CYCLE_002", "DEMO_ACC_B", "DEMO_ACC_C", 98000, 20),
    ("DEMO_CYCLE_003", "DEMO_ACC_C", "DEMO_ACC_A", 97000, 40),
)


@dataclass(frozen=True)
class Layout:
    """Where the tables of one analysis live."""

    raw: str
    folder: str
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"


@dataclass(frozen=True)
class Settings:
    max_rows: int | None = None
    min_cycle_length: int = cycles.MIN_LENGTH
    max_cycle_length: int = cycles.MAX_LENGTH
    chunk_rows: int = cleaning.CHUNK_ROWS
    keep_zeros: bool = False
    rules: scoring.Rules = field(default_factory=scoring.Rules)


def normalized_rows(raw: DataFrame, ws: Workspace, cfg: Settings) -> DataFrame:
    """Raw rows to transfers numbered in file order, with their chunk number.

    The text is parsed once; what is staged to fix the numbering is already normalized.
    """
    parsed = cleaning.normalize_transfers(
        raw, keep_zeros=cfg.keep_zeros, extra=("_file", "_block")
    )
    number = F.col("ordinal")
    return with_file_order(parsed, ws).select(
        cleaning.transaction_id(number, cfg.chunk_rows).alias("transaction_id"),
        *[name for name in parsed.columns if name not in ("_file", "_block")],
        cleaning.chunk_id(number, cfg.chunk_rows).alias("chunk_id"),
    )


def find_cases(edges: DataFrame, ws: Workspace, cfg: Settings = Settings()) -> DataFrame:
    """Transfers to ranked cases."""
    chosen = graph.detection_input(edges, cfg.max_rows)
    if cfg.max_rows:
        # Read more than once below: rows that tie at the cap must be the same ones each time.
        chosen = ws.materialize(chosen, "capped")
    detected = cycles.detect_cycles(
        chosen,
        ws,
        cfg.min_cycle_length,
        cfg.max_cycle_length,
    )
    return scoring.rank_cases(scoring.score_cycles(detected, ws, cfg.rules))


def demo_transfers(subgraph: DataFrame) -> DataFrame:
    """A small input whose answer is known: the earliest rows, and DEMO_LOOP added to them.

    DEMO_LOOP is made up; keep the result apart from tables of real transfers.
    """
    head = subgraph.orderBy("timestamp", "transaction_id").limit(DEMO_ROWS)
    if head.isEmpty():
        raise ValueError("the subgraph is empty")
    start = F.coalesce(F.min("timestamp"), F.localtimestamp())
    rows = [
        F.struct(
            F.lit(name).alias("transaction_id"),
            F.lit(source).alias("source_account"),
            F.lit(target).alias("target_account"),
            F.lit(amount).cast(TRANSFER["amount"].dataType).alias("amount"),
            (F.col("start") + F.expr(f"INTERVAL {minutes} MINUTES")).alias("timestamp"),
            F.lit("ACH").alias("transaction_type"),
            F.lit(1).alias("is_laundering"),
        )
        for name, source, target, amount, minutes in DEMO_LOOP
    ]
    loop = head.agg(start.alias("start")).select(F.inline(F.array(*rows)))
    return head.unionByName(loop)


def _write_clean(spark: SparkSession, at: Layout, cfg: Settings, ws: Workspace) -> None:
    rows = normalized_rows(read_raw(spark, at.raw), ws, cfg)
    transfers = cleaning.clean_transfers(rows).drop("chunk_id")
    write_table(transfers, at.path("transactions_clean"), at.fmt, sort_within="timestamp")
    write_table(
        cleaning.graph_edges(transfers),
        at.path("transactions_graph_edges"),
        at.fmt,
        sort_within="timestamp",
    )
    write_table(
        cleaning.quality_report(rows).orderBy("chunk_id"), at.path("data_quality_report"), at.fmt
    )


def _write_subgraph(spark: SparkSession, at: Layout, ws: Workspace) -> None:
    edges = read_transfers(spark, at.path("transactions_graph_edges"), at.fmt)
    write_table(
        graph.labelled_subgraph(edges, ws, require_labels=True),
        at.path("transactions_laundering_subgraph"),
        at.fmt,
        sort_within="timestamp",
    )


def _write_cases(
    spark: SparkSession, at: Layout, source: str, cfg: Settings, ws: Workspace
) -> None:
    edges = read_transfers(spark, at.path(source), at.fmt)
    write_table(find_cases(edges, ws, cfg), at.path("suspicious_cycles"), at.fmt)


def _write_demo(spark: SparkSession, at: Layout) -> None:
    subgraph = read_transfers(spark, at.path("transactions_laundering_subgraph"), at.fmt)
    write_table(demo_transfers(subgraph), at.path("demo_cycle_transactions"), at.fmt)


def run(spark: SparkSession, step: str, at: Layout, cfg: Settings = Settings()) -> None:
    """Run one step, or `all`: clean, subgraph and detect."""
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}; one of {STEPS}")
    with Workspace(spark) as ws:
        if step in ("clean", "all"):
            _write_clean(spark, at, cfg, ws)
        if step in ("subgraph", "all"):
            _write_subgraph(spark, at, ws)
        if step in ("detect", "all"):
            _write_cases(spark, at, "transactions_laundering_subgraph", cfg, ws)
        if step == "demo":
            _write_demo(spark, at)
        if step == "detect-demo":
            _write_cases(spark, at, "demo_cycle_transactions", cfg, ws)
