import os

import pytest
from test_cleaning import HEADER

from ledgerloop.plans import detection
from ledgerloop.plans.detection import Layout, Settings
from ledgerloop.plans.workspace import Workspace
from ledgerloop.sources.readers import read_cases, read_table, read_transfers

LINES = """\
2022/09/01 00:20,010,A,20,B,1,USD,"100,000.00",USD,ACH,1
2022/09/01 00:25,20,B,30,C,1,USD,98000,USD,ACH,0
2022/09/01 00:30,30,C,10,A,1,USD,97000,USD,ACH,0
2022/09/01 00:31,30,C,30,C,1,USD,5,USD,ACH,0
2022/09/01 00:32,40,D,50,E,1,USD,5,USD,ACH,0
bad,40,D,50,E,1,USD,5,USD,ACH,0
2022/09/01 00:33,40,,50,E,1,USD,-1,USD,ACH,0
"""


@pytest.fixture(params=["parquet", "csv"])
def layout(request, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text(HEADER + LINES, encoding="utf-8-sig")
    return Layout(str(raw), str(tmp_path / "out"), request.param)


def read(spark, layout, table):
    if layout.fmt == "csv":
        return spark.read.option("header", True).csv(layout.path(table))
    return spark.read.parquet(layout.path(table))


def test_all_steps(spark, layout):
    detection.run(spark, "all", layout)
    assert read_transfers(spark, layout.path("transactions_clean"), layout.fmt).count() == 5
    assert read(spark, layout, "transactions_graph_edges").count() == 4
    assert read(spark, layout, "transactions_laundering_subgraph").count() == 3
    report = read(spark, layout, "data_quality_report").first().asDict()
    assert {k: int(v) for k, v in report.items()} == {
        "rows_before": 7, "rows_after_cleaning": 5, "rows_removed": 2, "invalid_amount": 1,
        "invalid_timestamp": 1, "missing_accounts": 1, "self_loop_rows_kept_in_clean_data": 1,
        "chunk_id": 1, "graph_edge_rows": 4, "amount_unfit_rows": 0,
    }
    cases = read_cases(spark, layout.path("suspicious_cycles"), layout.fmt).collect()
    assert [(r["path"], int(r["risk_score"])) for r in cases] == [
        ("10_A -> 20_B -> 30_C -> 10_A", 80)
    ]
    detection.run(spark, "demo", layout)
    detection.run(spark, "detect-demo", layout)
    cases = read_cases(spark, layout.path("suspicious_cycles"), layout.fmt).collect()
    assert [(r["path"].split(" -> ")[0], int(r["risk_score"])) for r in cases] == [
        ("10_A", 80),
        ("DEMO_ACC_A", 80),
    ]


def test_length_bounds_leave_an_empty_table_with_columns(spark, layout):
    detection.run(spark, "clean", layout)
    detection.run(spark, "subgraph", layout)
    detection.run(spark, "detect", layout, Settings(min_cycle_length=4))
    cases = read(spark, layout, "suspicious_cycles")
    assert cases.count() == 0
    if layout.fmt == "parquet":
        assert "risk_level" in cases.columns


def test_unknown_step(spark, layout):
    with pytest.raises(ValueError, match="unknown step"):
        detection.run(spark, "everything", layout)


def test_workspace_uses_the_session_folder_and_cleans_up(spark):
    with Workspace(spark) as ws:
        written, rows = ws.materialize_counted(spark.range(10), "numbers")
        assert rows == 10 and written.count() == 10
        assert ws.folder.startswith(spark.conf.get("spark.checkpoint.dir", "") or "/")
        assert os.path.isdir(ws.folder)
    assert not os.path.exists(ws.folder)


def test_table_cap_is_ordered(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).selectExpr("cast(id as string) src", "'x' dst").write.option(
        "header", True
    ).csv(path)
    assert [r["src"] for r in read_table(spark, path, 3).collect()] == ["0", "1", "10"]
    assert read_table(spark, path, 0).count() == 20


def test_case_files_need_their_columns(spark, tmp_path):
    path = str(tmp_path / "cases")
    spark.range(1).selectExpr("'C1' cycle_id").write.option("header", True).csv(path)
    with pytest.raises(ValueError, match="risk_level"):
        read_cases(spark, path)


def test_clusters_must_name_a_shared_folder():
    class Session:
        class conf:
            values = {"spark.master": "yarn"}
            get = staticmethod(lambda key, default=None: Session.conf.values.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Workspace(Session())
    Session.conf.values["spark.master"] = "local[2]"
    assert os.path.isdir(Workspace(Session()).folder.split("/ledgerloop/")[0])


def test_old_runs_are_swept(spark, tmp_path):
    base = str(tmp_path)
    old, new = Workspace(spark, base), Workspace(spark, base)
    for ws in (old, new):
        ws.materialize(spark.range(3), "numbers")
    for folder, _, _ in os.walk(old.folder):
        os.utime(folder, (1_000_000_000, 1_000_000_000))
    assert Workspace.sweep(spark, 24, base) == 1
    assert not os.path.exists(old.folder) and os.path.exists(new.folder)
    assert Workspace.sweep(spark, 24, base) == 0 == Workspace.sweep(spark, 1, str(tmp_path / "none"))
