"""Scans with explicit schemas.  Inference would read bank 010 as the number 10."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloop.schema import CASE_REQUIRED, RAW, RAW_REQUIRED, TRANSFER, require_columns
from ledgerloop.sources.headers import check_header, files_by_header, files_of, scan

RAW_PLACED = T.StructType(
    [
        *RAW.fields,
        T.StructField("_file", T.StringType()),
        T.StructField("_block", T.LongType()),
    ]
)


def read_raw(spark: SparkSession, path: str | list[str], with_position: bool = True) -> DataFrame:
    """Raw transfer CSV, all columns as text and found by name in the header of each file.

    A file without a required column raises, with its name, before any job.  Columns that are not
    required may be missing (null) and unknown ones are left out.  `_file` and `_block` place every
    row in its input split (see operators.ordinal).
    """
    groups = files_by_header(spark, files_of(spark, path))
    for names, files in groups.items():
        check_header(names, RAW_REQUIRED, files[0])
    parts = [scan(spark, names, files, RAW) for names, files in groups.items()]
    raw = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RAW_PLACED)
    return raw if with_position else raw.drop("_file", "_block")


def read_transfers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Clean transfers or graph edges, Parquet or CSV with a header."""
    reader = spark.read.schema(TRANSFER)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)


def read_table(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Any edge table with a header, all columns as text; see operators.motifs.adapt_edges.

    `max_rows` keeps the first rows in the order of all columns; 0 and None keep all.
    """
    df = spark.read.option("header", True).csv(path)
    return df.orderBy(*df.columns).limit(max_rows) if max_rows else df


def read_cases(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Case table, checked for its required columns; numbers are coerced by case_queue."""
    df = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    return require_columns(df, CASE_REQUIRED)
