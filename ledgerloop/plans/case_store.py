"""Cases that are found once and read until their input changes.

A version of the case table is named by the input's files, their sizes and times, and by the settings
of the search.  A version counts when its writing has ended; one that broke off is written again.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ledgerloop.plans import detection
from ledgerloop.plans.detection import Settings
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import CASE
from ledgerloop.sources.headers import READERS, files_of
from ledgerloop.sources.readers import read_transfers


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def version_of(spark: SparkSession, source: str, cfg: Settings) -> str:
    """A digest of file names, sizes and times, and of the settings."""

    def describe(file: str) -> str:
        files, path = _path(spark, file)
        status = files.getFileStatus(path)
        return f"{file}|{status.getLen()}|{status.getModificationTime()}"

    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(describe, files_of(spark, source)))
    return hashlib.sha256("\n".join([repr(cfg), *lines]).encode()).hexdigest()[:32]


def stored_cases(
    spark: SparkSession,
    source: str,
    store: str,
    cfg: Settings = Settings(),
    fmt: str = "parquet",
) -> DataFrame:
    """The ranked cases of the transfers in `source`, from `store` where they are there already."""
    folder = f"{store.rstrip('/')}/version={version_of(spark, source, cfg)}"
    files, done = _path(spark, f"{folder}/_SUCCESS")
    if not files.exists(done):
        with Workspace(spark) as ws:
            cases = detection.find_cases(read_transfers(spark, source, fmt), ws, cfg)
            cases.write.mode("overwrite").parquet(folder)
    return spark.read.schema(CASE).parquet(folder)
