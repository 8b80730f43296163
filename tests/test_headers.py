"""Raw files are read by the names in their headers."""

import gzip
import os

import pytest
from test_cleaning import HEADER
from test_streaming import line

from ledgerloop.schema import RAW
from ledgerloop.sources.headers import column_names, files_by_header, files_of
from ledgerloop.sources.readers import read_raw
from ledgerloop.streaming.ingest import read_raw_stream, running_totals, start_ingest

NAMES = RAW.fieldNames()
SWAPPED = "Is Laundering, Payment Format ,Amount Paid,Extra,Account,From Bank,Account,To Bank,Timestamp"
SWAPPED_ROW = '1,ACH,"1,234.50",x,A9,010,B9,20,2022/09/01 00:09'


def test_names_are_trimmed_and_numbered():
    assert list(column_names("﻿" + HEADER.strip())) == NAMES
    assert column_names(' a ,"b, c",a,a') == ("a", "b, c", "a.1", "a.2")
    assert column_names("") == ()


def raw_folder(tmp_path):
    folder = tmp_path / "raw files"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + line(0) + line(1), encoding="utf-8-sig")
    (folder / "b.csv").write_text(f"{SWAPPED}\r\n{SWAPPED_ROW}\r\n")
    with gzip.open(folder / "c.csv.gz", "wt") as out:
        out.write(HEADER + line(2))
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text(HEADER)
    return str(folder)


def test_a_swapped_header_reads_right(spark, tmp_path):
    folder = raw_folder(tmp_path)
    groups = files_by_header(spark, files_of(spark, folder))
    assert sorted(len(files) for files in groups.values()) == [1, 3]
    raw = read_raw(spark, folder)
    assert raw.columns == [*NAMES, "_file", "_block"]
    rows = {r["Account"]: r for r in raw.collect()}
    assert sorted(rows) == ["A0", "A1", "A2", "A9"]
    nine = rows["A9"]
    assert (nine["Timestamp"], nine["From Bank"], nine["To Bank"], nine["Account.1"]) == (
        "2022/09/01 00:09", "010", "20", "B9",
    )
    assert (nine["Amount Paid"], nine["Payment Format"], nine["Is Laundering"]) == ("1,234.50", "ACH", "1")
    assert nine["Amount Received"] is None and nine["_file"].endswith("b.csv")
    assert rows["A2"]["Amount Paid"] == "3"
    assert read_raw(spark, folder, with_position=False).columns == NAMES


def test_only_needed_columns_are_read(spark, tmp_path):
    plan = read_raw(spark, raw_folder(tmp_path)).select("Account")._jdf.queryExecution().toString()
    scans = [row for row in plan.split("ReadSchema: ")[1:]]
    assert scans and all(scan.startswith("struct<c") and "," not in scan.split(">")[0] for scan in scans)


def test_a_missing_column_raises_with_its_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + line(0))
    (tmp_path / "b.csv").write_text(HEADER.replace("Payment Format", "Format") + line(1))
    with pytest.raises(ValueError, match=r"\['Payment Format'\].*b\.csv"):
        read_raw(spark, str(tmp_path))


def test_one_account_column_is_not_two(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER.replace("To Bank,Account", "To Bank,Receiver") + line(0))
    with pytest.raises(ValueError, match=r"Account\.1"):
        read_raw(spark, str(tmp_path))


def test_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    raw = read_raw(spark, str(tmp_path))
    assert raw.columns == [*NAMES, "_file", "_block"] and raw.collect() == []


@pytest.fixture
def stream(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def ingest(per_batch=1):
        found = read_raw_stream(spark, source, per_batch)
        start_ingest(found, out, state).awaitTermination(120)
        return out

    return ingest


def test_a_stream_reads_by_name(spark, tmp_path, stream):
    (tmp_path / "in" / "a.csv").write_text(HEADER + line(0))
    (tmp_path / "in" / "b.csv").write_text(f"{SWAPPED}\n{SWAPPED_ROW}\n")
    clean = spark.read.parquet(f"{stream()}/transactions_clean")
    assert {r["source_account"]: float(r["amount"]) for r in clean.collect()} == {"10_A0": 1.0, "10_A9": 1234.5}


def test_a_stream_stops_at_a_missing_column(spark, tmp_path, stream):
    (tmp_path / "in" / "a.csv").write_text(HEADER.replace("Is Laundering", "Label") + line(0))
    with pytest.raises(Exception, match="Is Laundering"):
        stream()


def test_totals_run_over_batches_and_repeats(spark, tmp_path, stream):
    from ledgerloop.streaming import ingest

    for k in range(3):
        rows = "".join(line(i, bank="" if i == k else "10") for i in range(k + 2))
        file = tmp_path / "in" / f"{k}.csv"
        file.write_text(HEADER + rows)
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
    out = stream()
    files = [str(tmp_path / "in" / f"{k}.csv") for k in range(3)]
    batches = spark.read.parquet(f"{out}/data_quality_report").count()
    assert batches == 3

    def totals():
        return running_totals(spark, out).first().asDict()

    wanted = totals()
    assert (wanted["chunks"], wanted["rows_before"], wanted["missing_accounts"]) == (3, 9, 3)
    first = spark.read.parquet(f"{out}/data_quality_totals/batch_id=1").first()["rows_before"]
    assert first == 5
    # The last batch again, as after a failure between its tables; then an old one.
    for batch_id in (2, 2, 0):
        path = spark.createDataFrame([(files[batch_id],)], "path string")
        ingest._write_batch(path, batch_id, out, False)
        assert totals() == wanted
    report = spark.read.parquet(f"{out}/data_quality_report")
    assert report.groupBy().sum("rows_before").first()[0] == wanted["rows_before"]
