import csv
import glob

from ledgerloop.plans.outputs import download_cases, write_motifs, write_property_graph
from ledgerloop.sources.readers import read_cases, read_table
from ledgerloop.sources.writers import write_single_csv

ROWS = [("1_a", "2_b", 5, 0), ("2_b", "1_a", 6, 1), ("2_b", "3_c", 7, 2), ("3_c", "1_a", 8, 3)]


def test_motif_files(spark, make_transfers, tmp_path):
    counts = write_motifs(spark, make_transfers(ROWS), str(tmp_path))
    assert counts == {2: 1, 3: 1}
    rows = read_table(spark, f"{tmp_path}/spark_detected_cycles").collect()
    assert sorted((r["path"], float(r["total_amount"])) for r in rows) == [
        ("1_a -> 2_b -> 1_a", 11.0),
        ("1_a -> 2_b -> 3_c -> 1_a", 20.0),
    ]


def test_motif_files_without_motifs(spark, make_transfers, tmp_path):
    assert write_motifs(spark, make_transfers(ROWS[:1]), str(tmp_path)) == {2: 0, 3: 0}
    assert read_table(spark, f"{tmp_path}/spark_detected_cycles").count() == 0


def test_property_graph_files(spark, make_transfers, tmp_path):
    write_property_graph(spark, make_transfers(ROWS + ROWS), str(tmp_path))
    nodes = [tuple(r) for r in read_table(spark, f"{tmp_path}/accounts_nodes").collect()]
    assert sorted(nodes) == [
        ("1_a", "1", "Account"), ("2_b", "2", "Account"), ("3_c", "3", "Account"),
    ]
    edges = read_table(spark, f"{tmp_path}/transactions_edges")
    assert edges.count() == 4
    # The files are themselves an accepted edge table.
    assert write_motifs(spark, edges, str(tmp_path / "again")) == {2: 1, 3: 1}


def case_file(spark, tmp_path):
    rows = [(f"C{i}", f"a{i} -> b -> a{i}", float(i), i, i, ["Low", "Medium", "High"][i % 3]) for i in range(90)]
    names = "cycle_id string, path string, total_amount double, duration_minutes int, risk_score int, risk_level string"
    path = str(tmp_path / "cases")
    spark.createDataFrame(rows, names).repartition(4).write.option("header", True).csv(path)
    return path


def test_a_filtered_queue_is_one_file(spark, tmp_path):
    target = str(tmp_path / "out" / "queue.csv")
    download_cases(spark, case_file(spark, tmp_path), target, min_amount=10, min_score=40, risks=("High", "Low"))
    with open(target, "rb") as out:
        assert out.read(3) == b"\xef\xbb\xbf"
    with open(target, encoding="utf-8-sig") as out:
        rows = list(csv.DictReader(out))
    wanted = [i for i in range(40, 90) if i % 3 != 1]
    assert sorted(int(float(r["risk_score"])) for r in rows) == wanted
    urgency = [(r["priority"], -float(r["risk_score"])) for r in rows]
    assert urgency == sorted(urgency) and len(set(r["priority"] for r in rows)) == 2
    assert not glob.glob(f"{target}.*")
    again = {r["cycle_id"]: r["path"] for r in read_cases(spark, target).collect()}
    assert again == {f"C{i}": f"a{i} -> b -> a{i}" for i in wanted}


def test_an_empty_queue_has_its_header(spark, tmp_path):
    target = str(tmp_path / "queue.csv")
    for _ in range(2):
        download_cases(spark, case_file(spark, tmp_path / str(_)), target, min_amount=1e9)
    found = read_cases(spark, target)
    assert "case_status" in found.columns and found.count() == 0


def test_single_files_keep_order_quotes_and_letters(spark, ws, tmp_path):
    df = spark.range(5000).selectExpr("id", "concat('Ưu tiên, \"', id, '\" →') as `a, b`").orderBy("id")
    target = str(tmp_path / "one.csv")
    write_single_csv(df, target, ws)
    rows = spark.read.option("header", True).option("escape", "\\").csv(target).collect()
    assert rows[0].asDict().keys() == {"id", "a, b"}
    assert [int(r["id"]) for r in rows] == list(range(5000))
    assert rows[7]["a, b"] == 'Ưu tiên, "7" →'
