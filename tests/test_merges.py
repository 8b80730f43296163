import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerloop.operators import export
from ledgerloop.sources import merges


def state(folder):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{folder}/part=*/*.parquet")}


def nodes(spark, ids, label="Account"):
    return spark.createDataFrame([(i, "1", label) for i in ids], "account_id string, bank_id string, label string")


def test_a_second_run_changes_no_file(spark, ws, tmp_path):
    folder = str(tmp_path / "nodes")
    ids = [f"a{i}" for i in range(500)]
    assert merges.merge_nodes_into(spark, folder, nodes(spark, ids + ids), ws) == 500
    before = state(folder)
    assert merges.merge_nodes_into(spark, folder, nodes(spark, ids, "Client"), ws) == 0
    assert state(folder) == before
    assert merges.read_merged(spark, folder).where("label = 'Account'").count() == 500


def test_only_partitions_with_new_rows_get_a_file(spark, ws, tmp_path):
    folder = str(tmp_path / "nodes")
    merges.merge_nodes_into(spark, folder, nodes(spark, [f"a{i}" for i in range(500)]), ws)
    before = state(folder)
    assert merges.merge_nodes_into(spark, folder, nodes(spark, ["a1", "new"]), ws) == 1
    after = state(folder)
    assert before.items() <= after.items() and len(after) == len(before) + 1


def test_a_run_that_broke_off_is_completed(spark, ws, tmp_path):
    """Some partitions have their new rows, others not: the next run adds what is missing."""
    folder = str(tmp_path / "nodes")
    merges.merge_nodes_into(spark, folder, nodes(spark, [f"a{i}" for i in range(100)]), ws)
    old = state(folder)
    incoming = nodes(spark, [f"a{i}" for i in range(50, 300)])
    merges.merge_nodes_into(spark, folder, incoming, ws)
    new = sorted(set(state(folder)) - set(old))
    for file in new[::2]:
        os.remove(file)
    left = state(folder)
    merges.merge_nodes_into(spark, folder, incoming, ws)
    assert left.items() <= state(folder).items()
    found = merges.read_merged(spark, folder)
    assert found.count() == found.select("account_id").distinct().count() == 300


def test_same_as_the_merge_of_tables(spark, ws, tmp_path, make_transfers):
    rows = [("1_a", "2_b", 5, 0), ("2_b", "1_a", 6, 1), ("2_b", "3_c", 7, 2), ("3_c", "9_z", 8, 3), (None, "1_a", 1, 1)]
    edges = export.export_edges(make_transfers(rows + rows))
    known = export.export_nodes(edges).where("bank_id <> '9'")
    at, of_edges = str(tmp_path / "nodes"), str(tmp_path / "edges")
    merges.merge_nodes_into(spark, at, known, ws)
    first = edges.where("amount < 6")
    assert merges.merge_edges_into(spark, of_edges, at, first, ws) == 1
    assert merges.merge_edges_into(spark, of_edges, at, edges, ws) == 2
    assert merges.merge_edges_into(spark, of_edges, at, edges, ws) == 0
    wanted = export.merge_edges(first, edges, known)
    columns = list(export.EDGE_COLUMNS)
    assert sorted(merges.read_merged(spark, of_edges).select(columns).collect()) == sorted(wanted.select(columns).collect())


def test_null_keys_are_one_key(spark, ws, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", None, 1), (None, None, 2)], "account_id string, bank_id string, label int")
    assert merges.merge_nodes_into(spark, folder, rows, ws) == 2
    assert merges.merge_nodes_into(spark, folder, rows, ws) == 0


def test_an_empty_first_run_leaves_a_table_or_nothing_to_read(spark, ws, tmp_path):
    folder = str(tmp_path / "t")
    assert merges.merge_nodes_into(spark, folder, nodes(spark, ["a"]).limit(0), ws) == 0
    assert merges.merge_nodes_into(spark, folder, nodes(spark, ["a"]), ws) == 1
    assert merges.read_merged(spark, folder).count() == 1


@pytest.mark.parametrize("kept", [0, 3])
def test_incoming_partitions_are_the_only_ones_read(spark, ws, tmp_path, kept):
    folder = str(tmp_path / "nodes")
    merges.merge_nodes_into(spark, folder, nodes(spark, [f"a{i}" for i in range(500)]), ws)
    own = {
        r[0]
        for r in nodes(spark, [f"a{i}" for i in range(kept)])
        .select(F.pmod(F.xxhash64("account_id", "bank_id"), F.lit(merges.PARTS)))
        .collect()
    }
    for part in glob.glob(f"{folder}/part=*"):
        if int(part.rsplit("=")[-1]) not in own:
            (file,) = glob.glob(f"{part}/*.parquet")
            with open(file, "wb") as out:
                out.write(b"not a table")
    assert merges.merge_nodes_into(spark, folder, nodes(spark, [f"a{i}" for i in range(kept)]), ws) == 0
