"""Streaming twin of the clean step: every micro-batch is one chunk.

No watermark is needed, rows do not wait for each other.  Each batch overwrites its own batch_id
partition: a batch that is repeated after a failure replaces its rows instead of adding them twice.
The only state are running totals of the report, one row per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloop.operators import cleaning
from ledgerloop.operators.ordinal import with_file_order
from ledgerloop.plans.workspace import Workspace
from ledgerloop.sources.readers import RAW_PLACED, read_raw
from ledgerloop.sources.writers import write_table

TOTALS = "data_quality_totals"

# What the file stream carries: names of new files.  Their rows are read in the batch, by the
# names in each file's header.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def read_raw_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Names of the raw files in a folder, as they come in; their content is not read here."""
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder).select("path")


def _write_batch(batch: DataFrame, batch_id: int, out: str, keep_zeros: bool) -> None:
    spark = batch.sparkSession
    files = sorted(row["path"] for row in batch.collect())
    with Workspace(spark) as ws:
        chunk = F.lit(batch_id + 1).cast("long")
        raw = read_raw(spark, files) if files else spark.createDataFrame([], RAW_PLACED)
        parsed = cleaning.normalize_transfers(
            raw, keep_zeros=keep_zeros, extra=("_file", "_block")
        )
        rows = with_file_order(parsed, ws).select(
            F.format_string("T%04d_%07d", chunk, F.col("ordinal")).alias("transaction_id"),
            *[name for name in parsed.columns if name not in ("_file", "_block")],
            chunk.alias("chunk_id"),
        )
        transfers = cleaning.clean_transfers(rows).drop("chunk_id")
        part = f"batch_id={batch_id}"
        write_table(transfers, f"{out}/transactions_clean/{part}")
        write_table(
            cleaning.graph_edges(transfers), f"{out}/transactions_graph_edges/{part}"
        )
        write_table(cleaning.quality_report(rows), f"{out}/data_quality_report/{part}")
    _add_to_totals(spark, out, batch_id)


def _add_to_totals(spark: SparkSession, out: str, batch_id: int) -> None:
    """Running totals after each batch: those after the batch before, and this batch's report.

    They depend on the batch id alone, so a batch that is repeated, once or after later ones, leaves
    the same totals.  Each batch reads one row and its own report, never the whole history.
    """
    report = spark.read.parquet(f"{out}/data_quality_report/batch_id={batch_id}")
    totals = cleaning.quality_totals(report)
    if batch_id:
        before = spark.read.schema(totals.schema).parquet(f"{out}/{TOTALS}/batch_id={batch_id - 1}")
        totals = before.unionByName(totals).agg(*[F.sum(c).alias(c) for c in totals.columns])
    write_table(totals.coalesce(1), f"{out}/{TOTALS}/batch_id={batch_id}")


def running_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals after the last batch, one row."""
    every = spark.read.parquet(f"{out.rstrip('/')}/{TOTALS}")
    last = every.agg(F.max("batch_id").alias("batch_id"))
    return every.join(last, "batch_id").drop("batch_id")


def start_ingest(
    raw_stream: DataFrame, out: str, checkpoint: str, keep_zeros: bool = False
) -> StreamingQuery:
    """Process all files that are there, in batches, then stop."""
    return (
        raw_stream.writeStream.foreachBatch(
            lambda batch, batch_id: _write_batch(batch, batch_id, out.rstrip("/"), keep_zeros)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
