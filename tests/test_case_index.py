import glob

import pytest
from pyspark.sql import functions as F

from ledgerloop.operators import case_index, cases
from ledgerloop.plans.workspace import Workspace


@pytest.fixture(scope="module")
def queue(spark):
    rows = [
        ("C1", ["a", "b", "c"]), ("C2", ["a", "b"]), ("C3", ["b", "c", "b"]), ("C4", ["d", "a"]), ("C5", []),
    ]
    rows += [(f"H{i}", ["hub", f"n{i}"]) for i in range(400)]
    df = spark.createDataFrame(rows, "cycle_id string, accounts array<string>")
    with Workspace(spark) as ws:
        yield ws.materialize(df.withColumn("path", F.concat_ws(" -> ", "accounts")), "queue")


def pairs(df):
    return sorted((r["cycle_id"], r["path"]) for r in df.select("cycle_id", "path").collect())


@pytest.mark.parametrize("a, b", [("a", "b"), ("b", "a"), ("hub", "n7"), ("a", "hub"), ("x", "a"), ("b", "b"), (None, "a"), ("", "b")])
def test_same_rows_as_the_scan(spark, queue, tmp_path, a, b):
    folder = str(tmp_path / "index")
    case_index.write_case_index(queue, folder, 8)
    wanted = pairs(cases.filter_two_accounts(queue, a, b))
    assert pairs(case_index.cases_of_two(spark, folder, queue, a, b)) == wanted


def test_only_the_partitions_of_the_accounts_are_read(spark, queue, tmp_path):
    """Every other partition holds a file that cannot be read."""
    folder = str(tmp_path / "index")
    case_index.write_case_index(queue, folder, 64)
    rows = spark.read.parquet(folder).where(F.col("account_id").isin("a", "b"))
    own = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
    others = [p for p in glob.glob(f"{folder}/buckets=64/bucket=*") if int(p.rsplit("=")[-1]) not in own]
    assert len(others) > 30
    for part in others:
        (file, *_) = glob.glob(f"{part}/*.parquet")
        with open(file, "wb") as out:
            out.write(b"not a table")
    found = case_index.cases_of_accounts(spark, folder, ["a", "b"])
    assert pairs(found) == [("C1", "a -> b -> c"), ("C2", "a -> b")]
    assert "PartitionFilters: [" in found._jdf.queryExecution().executedPlan().toString()


def test_cases_of_one_and_of_three_accounts(spark, queue, tmp_path):
    folder = str(tmp_path / "index")
    case_index.write_case_index(queue, folder)
    assert case_index.cases_of_accounts(spark, folder, ["hub"]).count() == 400
    assert pairs(case_index.cases_of_accounts(spark, folder, ["c", "a", "b", "a"])) == [("C1", "a -> b -> c")]
    with pytest.raises(ValueError, match="at least one"):
        case_index.cases_of_accounts(spark, folder, [])
