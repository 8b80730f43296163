import random

import pytest
from brute import motif_rows
from pyspark.sql import functions as F

from ledgerloop.operators import export, motifs


@pytest.fixture
def multigraph(make_transfers):
    rng = random.Random(11)
    rows = [
        (f"a{rng.randrange(6)}", f"a{rng.randrange(6)}", rng.randrange(1, 50), rng.randrange(9))
        for _ in range(60)
    ]
    # One pair holds a third of all rows.
    rows += [("a1", "a2", i, i % 4) for i in range(30)]
    rows.append(rows[0])
    return rows, make_transfers(rows)


def plain(df):
    return sorted((r["path"], float(r["total_amount"])) for r in df.collect())


def expected(rows, length):
    return sorted(
        (path, float(sum(amount for _, amount in choice))) for path, choice in motif_rows(rows, length)
    )


def test_motifs_list_every_choice_of_transfers(multigraph, ws):
    rows, df = multigraph
    assert plain(motifs.two_account_cycles(df, ws)) == expected(rows, 2)
    assert plain(motifs.three_account_cycles(df, ws)) == expected(rows, 3)
    union = motifs.motif_union(df, ws)
    assert plain(union) == sorted(expected(rows, 2) + expected(rows, 3))
    assert union.select("cycle_id").distinct().count() == union.count()


def test_counts_without_listing(multigraph, ws):
    rows, df = multigraph
    counts = {r["cycle_length"]: r["cycles"] for r in motifs.motif_counts(df, ws).collect()}
    assert counts == {2: len(expected(rows, 2)), 3: len(expected(rows, 3))}


@pytest.mark.parametrize("n", [1, 7, 40, 100, 100_000])
def test_export_takes_the_first_rows(multigraph, ws, n):
    rows, df = multigraph
    ordered = [
        (length, path, choice)
        for length in (2, 3)
        for path, choice in motif_rows(rows, length)
    ][:n]
    wanted = sorted((path, float(sum(a for _, a in choice))) for _, path, choice in ordered)
    assert plain(motifs.motif_export(df, ws, n)) == wanted


def test_adapter_names_and_defaults(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), (None, "b")], "src string, dst string")
    assert [tuple(r) for r in motifs.adapt_edges(df).collect()] == [("a", "b", 0, "", "", 0)]
    with pytest.raises(ValueError, match="source_account"):
        motifs.adapt_edges(df.withColumnRenamed("src", "from"))


def test_dedup_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", "b", "5", "t", "Wire", 0), ("a", "b", "5", "t", "ACH", 1)],
        "src string, dst string, amount string, timestamp string, transaction_type string, is_laundering int",
    )
    (row,) = motifs.dedup_edges(motifs.adapt_edges(df)).collect()
    assert (row["transaction_type"], row["is_laundering"]) == ("ACH", 1)


def test_patterns_have_every_rotation(multigraph, ws):
    rows, df = multigraph
    edges = export.export_edges(df)
    assert motifs.closed_pattern(edges, 2, ws).count() == 2 * len(expected(rows, 2))
    three = motifs.closed_pattern(edges, 3, ws)
    assert three.count() == 3 * len(expected(rows, 3))
    first = [tuple(map(str, r)) for r in motifs.closed_pattern(edges, 3, ws, 5).collect()]
    assert first == sorted(tuple(map(str, r)) for r in three.orderBy("path", "timestamps", "amounts").limit(5).collect())


def test_merges_are_idempotent(spark, make_transfers):
    edges = export.export_edges(make_transfers([("1_a", "2_b"), ("2_b", "1_a"), ("1_a", "x")]))
    nodes = export.export_nodes(edges)
    assert {tuple(r) for r in nodes.collect()} == {
        ("1_a", "1", "Account"), ("2_b", "2", "Account"), ("x", "UNKNOWN", "Account"),
    }
    once = export.merge_nodes(nodes.limit(0), nodes)
    assert export.merge_nodes(once, nodes).count() == 3
    known = nodes.where(F.col("account_id") != "x")
    merged = export.merge_edges(edges.limit(0), edges, known)
    assert merged.count() == 2
    assert export.merge_edges(merged, edges, known).count() == 2


def test_export_edges_drop_bad_rows_and_coerce(spark):
    df = spark.createDataFrame(
        [("a", "b", "x", "y"), ("a", "b", "x", "y"), (None, "b", "1", "1"), ("c", "c", "1", "1")],
        "source_account string, target_account string, amount string, is_laundering string",
    )
    (row,) = export.export_edges(df).collect()
    assert (float(row["amount"]), row["is_laundering"], row["timestamp"]) == (0.0, 0, "")
