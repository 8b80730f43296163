"""Stored lookup from accounts to cases.

Which cases hold an account is written once, in partitions by a hash of the account, and read for a
few accounts at a time: only their partitions are opened.  The number of partitions is part of the
table, so that readers need not know it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def _bucket(account: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(account), buckets).cast("int")


def write_case_index(queue: DataFrame, folder: str, buckets: int = BUCKETS) -> None:
    """One row per account and case, with the case's path, sorted by account in each file.

    An account in very many cases fills one partition, whose rows are written by as many tasks as
    read them: nothing is shuffled."""
    rows = queue.select(
        F.explode(F.array_distinct("accounts")).alias("account_id"), "cycle_id", "path"
    ).withColumn("buckets", F.lit(buckets))
    rows.withColumn("bucket", _bucket(F.col("account_id"), F.col("buckets"))).sortWithinPartitions(
        "bucket", "account_id"
    ).write.mode("overwrite").partitionBy("buckets", "bucket").parquet(folder)


_INDEX = "account_id string, cycle_id string, path string, buckets int, bucket int"


def cases_of_accounts(spark: SparkSession, folder: str, accounts: Sequence[str]) -> DataFrame:
    """cycle_id and path of the cases that hold all of these accounts."""
    wanted = sorted(set(accounts))
    if not wanted:
        raise ValueError("name at least one account")
    index = spark.read.schema(_INDEX).parquet(folder)
    # A condition on partition columns alone, so that other partitions are not even listed.
    own = [F.col("bucket") == _bucket(F.lit(a), F.col("buckets")) for a in wanted]
    found = index.where(reduce(lambda x, y: x | y, own)).where(F.col("account_id").isin(wanted))
    return (
        found.groupBy("cycle_id")
        .agg(F.count(F.lit(1)).alias("held"), F.min("path").alias("path"))
        .where(F.col("held") == len(wanted))
        .select("cycle_id", "path")
    )


def cases_of_two(
    spark: SparkSession, folder: str, queue: DataFrame, a: str | None, b: str | None
) -> DataFrame:
    """As cases.filter_two_accounts, by the index; no filter unless two different accounts are
    given."""
    if not a or not b or a == b:
        return queue.select("cycle_id", "path")
    return cases_of_accounts(spark, folder, (a, b))
