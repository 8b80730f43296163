"""Consecutive numbers without a global window.

Rows are range-partitioned and sorted, written once, and numbered from their partition's
offset.  No row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloop.plans.workspace import Workspace

_IN_PARTITION = (1 << 33) - 1


def _shift(written: DataFrame, offsets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add each row's position in its partition to the offset of that partition.  Spark picks the
    join by the size of the offsets."""
    return (
        written.join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_pos"))
        .drop("_pos", "_offset", *keys)
    )


def with_ordinal(df: DataFrame, by: list[Column], ws: Workspace, name: str = "ordinal") -> DataFrame:
    """Add `name`: 0, 1, 2, ... in the order of `by`, which must be a total order."""
    # Written first: to find the ranges, Spark reads its input once more.
    ordered = (
        ws.materialize(df, f"{name}-input").repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)))
    )
    written = ws.materialize(ordered, f"{name}-sorted")
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return _shift(written, ws.materialize(offsets, f"{name}-offsets"), ["_part"], name)


def rank_in_groups(
    df: DataFrame, keys: list[str], by: list[str], ws: Workspace, name: str = "rank"
) -> DataFrame:
    """Add `name`: 1, 2, 3, ... in each group of `keys`, in the order of `by`, which must be total
    in a group.

    Groups are numbered along with everything else, by range, and their first number is taken off:
    a group that holds most rows is sorted by many tasks.
    """
    order = [F.col(c) for c in (*keys, *by)]
    numbered = with_ordinal(df, order, ws, "_number")
    first = numbered.groupBy(*keys).agg(F.min("_number").alias("_first"))
    # Written first, so that adaptive execution can split a large group.
    return (
        numbered.join(ws.materialize(first, "group-starts"), keys)
        .withColumn(name, F.col("_number") - F.col("_first") + 1)
        .drop("_number", "_first")
    )


def with_file_order(df: DataFrame, ws: Workspace, name: str = "ordinal") -> DataFrame:
    """Add `name`: the row's position in the input files, in (path, offset) order.

    `df` must come from a file scan by projections only and keep the columns `_file` and
    `_block` (see sources.readers.read_raw): rows of a split are then in file order, and
    nothing has to be sorted.
    """
    placed = df.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id()
    )
    written = ws.materialize(placed, f"{name}-staged")
    splits = ws.materialize(
        written.groupBy("_part", "_file", "_block").agg(
            F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first")
        ),
        f"{name}-splits",
    )
    # Splits add up within their file, files among each other: one row per file in one task.
    files = splits.groupBy("_file").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed_splits = splits.withColumn("_in_file", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
    offsets = placed_splits.join(files, "_file").select(
        "_part",
        "_file",
        "_block",
        (F.col("_before") + F.col("_in_file") - F.col("first")).alias("_offset"),
    )
    keys = ["_part", "_file", "_block"]
    return _shift(written, ws.materialize(offsets, f"{name}-offsets"), keys, name)
