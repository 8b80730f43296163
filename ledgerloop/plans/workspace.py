"""Where intermediate results are cut from their lineage.

Iterative operators write each step as a Parquet table below the folder that the session
names in spark.checkpoint.dir.  Such a table survives lost executors, can be read by column,
and has a known size, so Spark's own size check decides what may be broadcast.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


_local_folders: list[str] = []


def _local_folder() -> str:
    """A temporary folder of this process; local mode only."""
    if not _local_folders:
        folder = tempfile.mkdtemp(prefix="ledgerloop-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders.append(folder)
    return _local_folders[0]


def _base_folder(spark: SparkSession) -> str:
    named = spark.conf.get(SETTING, None)
    if named:
        return named
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    raise ValueError(
        f"set {SETTING} to a folder that every executor can reach (HDFS or an object store)"
    )


class Workspace:
    """One run's folder of intermediate tables."""

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        base = base or _base_folder(spark)
        self.folder = f"{base.rstrip('/')}/ledgerloop/{uuid.uuid4().hex}"
        self._steps = 0

    def new_path(self, name: str) -> str:
        self._steps += 1
        return f"{self.folder}/{self._steps:03d}-{name}"

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` and return the written table."""
        path = self.new_path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def materialize_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """As materialize, with the number of rows; it is counted while they are written."""
        seen = Observation()
        written = self.materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
        return written, seen.get["rows"]

    def close(self) -> None:
        """Delete the folder; call it once the results built on it have been written."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @staticmethod
    def sweep(spark: SparkSession, hours: float, base: str | None = None) -> int:
        """Delete the folders of runs in which nothing was written for that long; returns how many.

        For runs that ended without close(), such as queries whose result was read later."""
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{(base or _base_folder(spark)).rstrip('/')}/ledgerloop")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return 0
        oldest = time.time() * 1000 - hours * 3_600_000
        swept = 0
        for run in files.listStatus(root):
            times = [s.getModificationTime() for s in files.listStatus(run.getPath())]
            if max([run.getModificationTime(), *times]) < oldest:
                files.delete(run.getPath(), True)
                swept += 1
        return swept

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
