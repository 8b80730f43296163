import pytest
from pyspark.sql import functions as F

from ledgerloop.checks import tables
from ledgerloop.operators import graph


@pytest.fixture
def edges(spark, small):
    return graph.detection_input(tables.ring_transfers(spark, small))


def test_ring_transfers_golden(spark, ws, small, edges):
    assert tables.ring_transfers(spark, small).count() == 6000
    (summary,) = graph.graph_summary(edges).collect()
    assert (summary["nodes"], summary["edges"]) == (1475, 5977)
    assert summary["density"] == pytest.approx(0.002749120345882299, abs=1e-14)
    (totals,) = graph.label_totals(edges).collect()
    assert (totals["labelled_rows"], totals["labelled_accounts"]) == (153, 268)
    assert graph.labelled_subgraph(edges, ws).count() == 2430


def test_subgraph_needs_labels_on_request(ws, edges):
    none = edges.withColumn("is_laundering", F.lit(0))
    assert graph.labelled_subgraph(none, ws).count() == 0
    with pytest.raises(ValueError, match="labelled"):
        graph.labelled_subgraph(none, ws, require_labels=True)


def test_empty_and_single_node_density(edges):
    (row,) = graph.graph_summary(edges.limit(0)).collect()
    assert tuple(row) == (0, 0, 0.0)


def test_pairs_keep_the_earliest_transfer(make_transfers):
    df = make_transfers([("a", "b", 5, 9), ("a", "b", 7, 2), ("a", "b", 6, 2)])
    (row,) = graph.edge_pairs(df).collect()
    assert (row["first"]["transaction_id"], row["n_transfers"]) == ("t0001", 3)
    assert float(row["total_amount"]) == 18.0


def test_a_pair_lists_each_of_its_transfers_once(make_transfers):
    rows = [("a", "b", i + 1, i) for i in range(2500)] + [("b", "a", 1, 0)]
    lists = graph.pair_transfer_lists(make_transfers(rows)).collect()
    names = [r["transaction_id"] for r in lists if (r["src"], r["dst"]) == ("a", "b")]
    assert sorted(names) == [f"t{i:04d}" for i in range(2500)]
    assert len(lists) == 2501


def test_input_cap_takes_the_earliest_rows(make_transfers):
    df = make_transfers([("a", "b", 1, 3), ("b", "a", 1, 1), ("c", "c", 1, 0), ("a", "c", 1, 2)])
    ids = [r[0] for r in graph.detection_input(df, 3).select("transaction_id").collect()]
    assert sorted(ids) == ["t0001", "t0003"]
    assert graph.detection_input(df).count() == 3


def test_rows_with_nulls_are_not_searched(make_transfers):
    df = make_transfers([("a", "b"), (None, "b"), ("a", None)])
    assert graph.detection_input(df).count() == 1
