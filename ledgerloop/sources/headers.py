"""Headers of raw CSV files: which column stands where, file by file.

Exports differ in the order of their columns, in blanks around names and in columns that are left
out or added.  Columns are therefore found by name.  Only header lines reach the driver, a short read
per file; files with one header are scanned together.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTES_OF_A_HEADER = 1 << 16
READERS = 16
_MARK = "﻿"


def column_names(line: str) -> tuple[str, ...]:
    """Trimmed names of a header line.  A repeated name is numbered: Account, Account.1, ..."""
    seen: dict[str, int] = {}
    names = []
    for cell in next(csv.reader([line.removeprefix(_MARK)]), []):
        name = cell.strip()
        again = seen.get(name, 0)
        seen[name] = again + 1
        names.append(f"{name}.{again}" if again else name)
    return tuple(names)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, also of a compressed one; empty for an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(conf).open(where)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        text = jvm.org.apache.hadoop.io.Text()
        reader = jvm.org.apache.hadoop.util.LineReader(stream)
        reader.readLine(text, BYTES_OF_A_HEADER)
        return text.toString()
    finally:
        stream.close()


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The data files of a path, folder, pattern or list of these, in order."""
    return sorted(unquote(name) for name in spark.read.text(path).inputFiles())


def files_by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their column names; files without a line have no rows and are left out."""
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda file: first_line(spark, file), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line.removeprefix(_MARK).strip():
            groups.setdefault(column_names(line), []).append(file)
    return groups


def check_header(names: tuple[str, ...], required: Iterable[str], file: str) -> None:
    missing = [name for name in required if name not in names]
    if missing:
        raise ValueError(f"missing required columns: {missing}; {file} has {list(names)}")


def scan(
    spark: SparkSession, names: tuple[str, ...], files: list[str], wanted: T.StructType
) -> DataFrame:
    """The wanted columns of files with these column names, all read as text and by name; null
    where a file lacks one.  `_file` and `_block` tell the input split of each row."""
    where = {name: f"c{k}" for k, name in enumerate(names)}
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
    rows = spark.read.schema(schema).option("header", True).csv(files)
    columns = [
        (F.col(where[f.name]) if f.name in where else F.lit(None).cast("string")).alias(f.name)
        for f in wanted
    ]
    return rows.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
