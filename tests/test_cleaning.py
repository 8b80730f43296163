from decimal import Decimal

import pytest
from given import DATA
from pyspark.sql import functions as F

from ledgerloop.checks import tables
from ledgerloop.operators import cleaning
from ledgerloop.operators.ordinal import with_file_order, with_ordinal
from ledgerloop.plans.detection import Settings, normalized_rows
from ledgerloop.schema import RAW
from ledgerloop.sources.readers import read_raw

HEADER = (
    "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,"
    "Amount Paid,Payment Currency,Payment Format,Is Laundering\n"
)


def test_dirty_rows_golden(spark, small):
    raw = tables.raw_rows(spark, small)
    rows = cleaning.normalize_transfers(raw, F.lit("x")).withColumn("chunk_id", F.lit(1))
    (report,) = cleaning.quality_report(rows).collect()
    assert report.asDict() == {
        "rows_before": 6000,
        "rows_after_cleaning": 5550,
        "rows_removed": 450,
        "invalid_amount": 122,
        "invalid_timestamp": 111,
        "missing_accounts": 150,
        "self_loop_rows_kept_in_clean_data": 27,
        "graph_edge_rows": 5523,
        "amount_unfit_rows": 71,
        "chunk_id": 1,
    }
    clean = cleaning.clean_transfers(rows)
    total, labels = clean.agg(F.sum("amount"), F.sum("is_laundering")).first()
    # 42 times 1e15, 43 times 1e14, 32 times 4e-7 and the rest.
    assert (total, labels) == (Decimal("46300000287017443.3500128"), 150)
    assert cleaning.graph_edges(clean).count() == 5523


def test_missing_columns_fail_before_any_job(spark):
    df = spark.createDataFrame([("x",)], "Timestamp string")
    with pytest.raises(ValueError, match="From Bank"):
        cleaning.normalize_transfers(df, F.lit("x"))


def test_column_names_are_trimmed(spark):
    names = [f" {f.name} " for f in RAW.fields]
    df = spark.createDataFrame([tuple("x" for _ in names)], RAW).toDF(*names)
    assert cleaning.normalize_transfers(df, F.lit("id")).count() == 1


def _write_raw(path, start, count, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as out:
        out.write(HEADER)
        for i in range(start, start + count):
            out.write(f"2022/09/01 00:{i % 60:02d},010,A{i},20,B{i},1,USD,{i}.5,USD,Wire,0\n")


def test_raw_files_are_numbered_in_file_order(spark, ws, tmp_path):
    for i, (start, count) in enumerate([(1, 5), (6, 250), (256, 3)]):
        _write_raw(tmp_path / f"part-{i}.csv", start, count, bom=i == 0)
    raw = read_raw(spark, str(tmp_path))
    rows = normalized_rows(raw, ws, Settings(chunk_rows=100)).orderBy("transaction_id").collect()
    assert [r["source_account"] for r in rows] == [f"10_A{i}" for i in range(1, 259)]
    assert rows[0]["transaction_id"] == "T0001_0000000"
    assert rows[100]["transaction_id"] == "T0002_0000000"
    assert rows[257]["transaction_id"] == "T0003_0000057"
    assert [r["chunk_id"] for r in rows] == [i // 100 + 1 for i in range(258)]


def test_file_order_with_small_splits(spark, ws, tmp_path):
    _write_raw(tmp_path / "one.csv", 1, 3000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        raw = read_raw(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 4
        rows = with_file_order(raw, ws).orderBy("ordinal").select("Account", "ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [tuple(r) for r in rows] == [(f"A{i + 1}", i) for i in range(3000)]


def test_ordinal_is_consecutive_in_key_order(spark, ws):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    rows = with_ordinal(df, [F.desc("k")], ws).collect()
    assert sorted((r["ordinal"], r["k"]) for r in rows) == [(i, 4999 - i) for i in range(5000)]


def test_ordinal_of_nothing(spark, ws):
    assert with_ordinal(spark.range(0), [F.col("id")], ws).collect() == []


def test_self_loops_count_before_the_filter(spark):
    schema = (
        "transaction_id string, source_account string, target_account string, "
        "amount decimal(30,10), timestamp timestamp_ntz, transaction_type string, is_laundering int"
    )
    df = spark.createDataFrame([("t", "a", "a", None, None, None, 0)], schema)
    (row,) = cleaning.quality_report(df.withColumn("chunk_id", F.lit(1))).collect()
    assert (row["self_loop_rows_kept_in_clean_data"], row["rows_after_cleaning"]) == (1, 0)


def test_accounts_are_estimated_from_the_report(spark, ws):
    """Sketches per chunk, united for the totals; the rows are read once."""
    raw = ws.materialize(tables.raw_rows(spark, f"{DATA}/sf0.1"), "raw")
    rows = cleaning.normalize_transfers(raw, F.lit("x"))
    rows = rows.withColumn("chunk_id", F.spark_partition_id())
    report = cleaning.quality_report(rows, with_accounts=True)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    (totals,) = cleaning.quality_totals(ws.materialize(report, "report")).collect()
    assert totals["chunks"] > 1
    clean = cleaning.clean_transfers(rows)
    for side in ("source", "target"):
        exact = clean.select(f"{side}_account").distinct().count()
        assert abs(totals[f"about_{side}_accounts"] / exact - 1) < 0.02
    plain = cleaning.quality_totals(cleaning.quality_report(rows))
    assert totals.asDict().items() >= plain.first().asDict().items()
