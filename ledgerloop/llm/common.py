"""What several operators of this subpackage share."""

from __future__ import annotations

import functools
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.plans.workspace import Workspace

#: Names of helper columns start like this, so that they meet no column of an input.
OWN = "__ll_"

#: A word of the contracts; bytes.split() cuts at exactly these six separators.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def process_state(name: str) -> dict:
    """A dictionary of this Python process that outlives a task: workers are used again, while
    the functions they run are unpickled anew for each task."""
    key = "ledgerloop_process_state"
    module = sys.modules.setdefault(key, types.ModuleType(key))
    return module.__dict__.setdefault(name, {})


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts a value of bounded size together with the code of its class; the result gives
    it back in a worker.  Every executor keeps it on disk, so it is compressed."""
    packed = spark.sparkContext.broadcast(zstandard.compress(cloudpickle.dumps(value), 1))
    return lambda: pickle.loads(zstandard.decompress(packed.value))


def rows(batches: Iterator, *columns: str) -> Iterator[tuple[list, ...]]:
    """Of each Arrow batch the named columns as lists; batches without rows are left out."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(batch.column(name).to_pylist() for name in columns)


#: Columns of documents that stages read by name.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def any_columns(stage: Callable) -> Callable:
    """A stage that passes on all columns, whatever their names.  Inside, columns that it does not
    read have numbered names, which need no quotes and meet none of its helper names."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        plain = [c if c in READ else f"{OWN}c{k}" for k, c in enumerate(docs.columns)]
        done = stage(spark, docs.toDF(*plain), folder)
        return done.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns)])

    return run


def sort_key(docs: DataFrame, column: str) -> Column:
    """The column, or its text where values of its type have no order (maps)."""
    kind = docs.schema[column].dataType.simpleString()
    plain = F.col(f"`{column}`")
    return plain.cast("string") if "map<" in kind or kind == "variant" else plain


def remainder_of_id(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def total(df: DataFrame, column: str) -> int:
    """The sum of a column, 0 for an empty table; one number reaches the driver."""
    return df.agg(F.sum(column)).first()[0] or 0


__all__ = [
    "OWN",
    "READ",
    "WORD",
    "Workspace",
    "any_columns",
    "process_state",
    "read_table",
    "remainder_of_id",
    "rows",
    "share",
    "shuffle_width",
    "sort_key",
    "total",
]
