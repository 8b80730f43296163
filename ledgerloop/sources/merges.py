"""Idempotent merges into stored tables: rows with a new key are added, known ones stay.

A table lies in partitions by a hash of its key.  Only partitions that incoming rows fall into are
read, and only those that get a new row are written to, in one file each.  Nothing is ever rewritten
or deleted, so a crash leaves every partition as it was or with its new rows, and a second run adds
what is missing.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.operators.export import EDGE_COLUMNS, known_edges, not_in
from ledgerloop.plans.workspace import Workspace

PARTS = 64
NODE_KEY = ("account_id", "bank_id")


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_merged(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("part")


def merge_into(
    spark: SparkSession,
    folder: str,
    incoming: DataFrame,
    key: Sequence[str],
    ws: Workspace,
    parts: int = PARTS,
) -> int:
    """Add the rows whose key the table lacks; returns how many were added.

    Of incoming rows with one key one is taken.  `parts` has to stay the same for a table."""
    part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
    rows = ws.materialize(
        incoming.dropDuplicates(list(key)).withColumn("part", part), "incoming"
    )
    if _exists(spark, folder):
        stored = spark.read.schema(rows.schema).parquet(folder)
        # At most `parts` numbers; they tell which partitions are opened.
        touched = [r["part"] for r in rows.select("part").distinct().collect()]
        stored = stored.where(F.col("part").isin(touched)).select("part", *key)
        rows = not_in(rows, stored, ("part", *key))
    new, added = ws.materialize_counted(rows, "new")
    if added or not _exists(spark, folder):
        new.repartition("part").write.mode("append").partitionBy("part").parquet(folder)
    return added


def merge_nodes_into(spark: SparkSession, folder: str, incoming: DataFrame, ws: Workspace) -> int:
    return merge_into(spark, folder, incoming, NODE_KEY, ws)


def merge_edges_into(
    spark: SparkSession, folder: str, nodes_folder: str, incoming: DataFrame, ws: Workspace
) -> int:
    """Edges between accounts of the stored nodes; all six columns are the key."""
    known = known_edges(incoming, read_merged(spark, nodes_folder))
    return merge_into(spark, folder, known, EDGE_COLUMNS, ws)
