"""Distributed sinks; an empty result still has its header or schema."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame

from ledgerloop.plans.workspace import Workspace

_MARK = b"\xef\xbb\xbf"


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    sort_within: str | None = None,
) -> None:
    """Parquet between steps, CSV with headers at the edges.

    `sort_within` sorts inside each output file only; it tightens Parquet statistics and
    needs no shuffle.
    """
    if sort_within:
        df = df.sortWithinPartitions(sort_within)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; use 'parquet' or 'csv'")


def write_single_csv(df: DataFrame, path: str, ws: Workspace) -> None:
    """One CSV file with a UTF-8 mark and one header, in the order of `df`; an empty result has its
    header.

    Tasks write parts; the file system then joins them as streams, so that no more than a block of
    the result is ever held.  The file appears under its name when it is whole.
    """
    spark, parts = df.sparkSession, ws.new_path("csv-parts")
    df.write.option("header", False).csv(parts)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, unfinished = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.unfinished"))
    source = jvm.org.apache.hadoop.fs.Path(parts)
    files = source.getFileSystem(conf)
    where = target.getFileSystem(conf)
    out = where.create(unfinished, True)
    try:
        out.write(_MARK + header.getvalue().encode())
        names = sorted(status.getPath().toString() for status in files.listStatus(source))
        for name in names:
            if name.rsplit("/", 1)[1].startswith("part-"):
                part = files.open(jvm.org.apache.hadoop.fs.Path(name))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                finally:
                    part.close()
    finally:
        out.close()
    where.delete(target, False)
    if not where.rename(unfinished, target):
        raise OSError(f"could not write {path}")
