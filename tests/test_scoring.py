import pytest

from ledgerloop.checks import registry, tables
from ledgerloop.operators import cycles, graph, scoring
from ledgerloop.plans.detection import find_cases

LOOP = [
    ("DEMO_ACC_A", "DEMO_ACC_B", 100000, 0),
    ("DEMO_ACC_B", "DEMO_ACC_C", 98000, 20),
    ("DEMO_ACC_C", "DEMO_ACC_A", 97000, 40),
]


def one_case(ws, df):
    (row,) = find_cases(df, ws).collect()
    return row


def test_only_pairs_on_a_cycle_are_looked_up(spark, ws, make_transfers):
    """All other first transfers stay out of the table that hops are joined with."""
    edges = make_transfers([*LOOP, *[(f"x{i}", f"y{i}", 5, i) for i in range(20)]])
    found = cycles.bounded_cycles(cycles.account_pairs(edges), ws).select("path")
    hops = scoring.cycle_hops(found, graph.first_transfers(edges), ws)
    assert hops.count() == 3 and hops.where("transaction_id is null").isEmpty()
    assert spark.read.parquet(f"{ws.folder}/*first-transfers").count() == 3


def test_scores_of_queries_cover_rings_of_five_and_six(spark):
    """Cycles of up to six accounts are scored, not only those of up to four."""
    rows = registry.risk_score(spark, "/root/testdata/sf0.001").select("path").collect()
    lengths = {r["path"].count(" -> ") for r in rows}
    assert {2, 3, 4, 5, 6} <= lengths


def test_demo_loop(ws, make_transfers):
    row = one_case(ws, make_transfers(LOOP))
    assert row["path"] == "DEMO_ACC_A -> DEMO_ACC_B -> DEMO_ACC_C -> DEMO_ACC_A"
    assert (row["total_amount"], row["duration_minutes"]) == (295000.0, 40)
    assert row["amount_variance"] == 0.0305
    assert (row["risk_score"], row["risk_level"], row["cycle_id"]) == (80, "High", "C001")
    assert "ring of 3" in row["explanation"] and "over in 40 min" in row["explanation"]


def ring(n, amount, gap):
    return [(f"n{i}", f"n{(i + 1) % n}", amount, gap * i) for i in range(n)]


@pytest.mark.parametrize(
    "n, amount, gap, score, level",
    [
        (2, 10_000_000, 1, 65, "Medium"),
        (3, 10_000_000, 1, 100, "High"),
        (5, 10_000_000, 1, 100, "High"),
        (6, 10_000_000, 1, 80, "High"),
        (3, 100, 720, 65, "Medium"),
        (3, 100, 721, 40, "Medium"),
        (2, 100, 1441, 20, "Low"),
        (2, 5_000_000, 1440, 65, "Medium"),
    ],
)
def test_rules_and_ceilings(ws, make_transfers, n, amount, gap, score, level):
    row = one_case(ws, make_transfers(ring(n, amount, gap)))
    assert (row["risk_score"], row["risk_level"]) == (score, level)


def test_no_rule_fires(ws, make_transfers):
    row = one_case(ws, make_transfers([("a", "b", 1, 0), ("b", "a", 100, 5000)]))
    assert (row["risk_score"], row["risk_level"]) == (0, "Low")
    assert "otherwise ordinary" in row["explanation"]


def test_cycle_against_time_order_is_scored(ws, make_transfers):
    row = one_case(ws, make_transfers([("a", "b", 1, 50), ("b", "c", 1, 20), ("c", "a", 1, 0)]))
    assert row["duration_minutes"] == 50


def test_partly_and_never_matched_cycles(spark, ws, make_transfers):
    known = graph.first_transfers(make_transfers([("a", "b", 100, 0), ("b", "c", 100, 10)]))
    found = spark.createDataFrame([(["a", "b", "c"],), (["x", "y"],)], "path array<string>")
    cases = scoring.score_cycles(scoring.measure_cycles(found, known, ws), ws)
    rows = {r["cycle_id"]: r for r in cases.collect()}
    none, part = rows["C001"], rows["C002"]
    assert (none["total_amount"], none["duration_minutes"], none["amount_variance"]) == (
        0.0, None, None,
    )
    assert (none["risk_score"], none["risk_level"]) == (0, "Low")
    assert "transfers missing" in none["explanation"]
    assert (part["total_amount"], part["duration_minutes"], part["risk_score"]) == (200.0, 10, 80)


def test_carried_measures_equal_joined_measures(spark, ws, small):
    edges = graph.detection_input(tables.ring_transfers(spark, small))
    found = cycles.detect_cycles(edges, ws)
    joined = scoring.measure_cycles(found.select("path"), graph.first_transfers(edges), ws)
    columns = ["path", "n_accounts", "total", "low", "high", "first_time", "last_time"]
    key = lambda r: r["path"]
    assert sorted(found.select(*columns).collect(), key=key) == sorted(
        joined.select(*columns).collect(), key=key
    )


def test_golden_levels_and_order(spark, ws, small):
    rows = find_cases(tables.ring_transfers(spark, small), ws).collect()
    levels = [r["risk_level"] for r in rows]
    assert {x: levels.count(x) for x in set(levels)} == {"High": 43, "Medium": 343, "Low": 450}
    order = [(-r["risk_score"], -r["total_amount"], r["path"]) for r in rows]
    assert order == sorted(order)
    assert sorted(r["cycle_id"] for r in rows) == [f"C{i:03d}" for i in range(1, 837)]


def test_case_ids_grow_past_three_digits(spark, ws):
    df = spark.range(1, 1202).selectExpr(
        "array(lpad(cast(id as string), 5, '0'), 'x') as path", "2 as n_accounts"
    )
    ids = {r["cycle_id"] for r in scoring.with_case_ids(df, ws).collect()}
    assert {"C001", "C999", "C1000", "C1201"} <= ids and len(ids) == 1201


def test_no_cycles_give_an_empty_case_table(ws, make_transfers):
    cases = find_cases(make_transfers([("a", "b"), ("b", "c"), ("a", "a")]), ws)
    assert cases.collect() == []
    assert cases.columns[:3] == ["cycle_id", "path", "total_amount"]


def test_own_thresholds(ws, make_transfers):
    rules = scoring.Rules(min_total=200_000)
    measured = cycles.detect_cycles(make_transfers(LOOP), ws)
    (row,) = scoring.score_cycles(measured, ws, rules).collect()
    assert row["risk_score"] == 100 and "200,000" in row["explanation"]
