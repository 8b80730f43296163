import pytest
from test_cleaning import HEADER

from ledgerloop.streaming.ingest import read_raw_stream, start_ingest


def line(i, bank="10"):
    return f"2022/09/01 00:{i:02d},{bank},A{i},20,B{i},1,USD,{i + 1},USD,Wire,0\n"


@pytest.mark.parametrize("per_batch, batches", [(1, 2), (None, 1)])
def test_files_become_batches_once(spark, tmp_path, per_batch, batches):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEADER + line(0) + line(1))
    (tmp_path / "in" / "b.csv").write_text(HEADER + line(2, bank="") + line(3))

    def ingest():
        stream = read_raw_stream(spark, source, per_batch)
        assert start_ingest(stream, out, state).awaitTermination(120)

    ingest()
    clean = spark.read.parquet(f"{out}/transactions_clean")
    assert sorted(r["source_account"] for r in clean.collect()) == ["10_A0", "10_A1", "10_A3"]
    assert clean.select("transaction_id").distinct().count() == 3
    report = spark.read.parquet(f"{out}/data_quality_report")
    assert report.count() == batches
    assert report.groupBy().sum("rows_before", "missing_accounts").first()[:2] == (4, 1)

    ingest()  # nothing new
    assert spark.read.parquet(f"{out}/transactions_clean").count() == 3

    (tmp_path / "in" / "c.csv").write_text(HEADER + line(4))
    ingest()
    assert spark.read.parquet(f"{out}/transactions_clean").count() == 4
    edges = spark.read.parquet(f"{out}/transactions_graph_edges")
    assert edges.select("batch_id").distinct().count() == batches + 1
