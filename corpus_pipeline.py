"""Documents from raw to token ids: five stages, each a call of one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  Its result is written and read
again, so a stage never repeats the work of those before it.  All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloop.llm import bpe, line_dedup, mixing, quality, simhash
from ledgerloop.plans.workspace import Workspace

STAGES = [
    ("quality rules", quality.stage),
    ("line dedup", line_dedup.stage),
    ("simhash near-dedup", simhash.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: An isolation forest, fingerprints and merges are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of the mixed corpus."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
