import pytest

from ledgerloop.functions import labels
from ledgerloop.operators import cases, investigate

ROWS = [
    ("C001", "A -> B -> A", "1500000", "30", "65", "Medium"),
    ("C002", "A -> B -> C -> A", "2e9", None, "120", "high"),
    ("C003", "['D', 'E', 'F']", "oops", "5", "75", "Low"),
    ("C004", None, "10", "5", "-3", "??"),
    ("C005", "A -> C -> A", "1500000", "30", "65", "Medium"),
]


@pytest.fixture
def queue(spark):
    df = spark.createDataFrame(
        ROWS,
        "cycle_id string, path string, total_amount string, duration_minutes string, "
        "risk_score string, risk_level string",
    )
    return cases.case_queue(df)


def by_id(df):
    return {r["cycle_id"]: r for r in df.collect()}


def test_coercion_and_derived_columns(queue):
    rows = by_id(queue)
    assert (rows["C002"]["risk_score"], rows["C002"]["duration_minutes"]) == (100.0, 0.0)
    assert (rows["C003"]["total_amount"], rows["C004"]["risk_score"]) == (0.0, 0.0)
    assert rows["C003"]["accounts"] == ["D", "E", "F"]
    assert (rows["C004"]["cycle_length"], rows["C004"]["risk_level_norm"]) == (0, "Unknown")
    words = labels.ENGLISH
    assert rows["C003"]["priority"] == words.p1  # low level, high score
    assert rows["C001"]["case_status"] == words.in_review
    assert rows["C004"]["case_status"] == words.monitoring
    assert "2.00 billion VND" in rows["C002"]["case_explanation"]
    assert "Stops: " in rows["C001"]["case_explanation"]


def test_order(queue, ws):
    expected = ["C002", "C003", "C001", "C005", "C004"]
    assert [r["cycle_id"] for r in cases.order_queue(queue).collect()] == expected
    ranked = cases.rank_queue(queue, ws).orderBy("queue_rank").collect()
    assert [(r["queue_rank"], r["cycle_id"]) for r in ranked] == list(enumerate(expected, 1))


def test_filters(queue):
    words = labels.ENGLISH

    def ids(df):
        return sorted(by_id(df))

    assert ids(cases.filter_numeric(queue, 1e6, 65, (2, 2))) == ["C001", "C005"]
    assert ids(cases.filter_membership(queue)) == sorted(by_id(queue))
    assert ids(cases.filter_membership(queue, risks=[words.low], priorities=[words.p1])) == ["C003"]
    assert ids(cases.filter_lengths(queue, (3,))) == ["C002", "C003"]
    assert ids(cases.filter_two_accounts(queue, "A", "C")) == ["C002", "C005"]
    assert len(ids(cases.filter_two_accounts(queue, "A", "A"))) == 5
    assert len(ids(cases.filter_two_accounts(queue, "A", None))) == 5


def test_overview(queue):
    (kpis,) = cases.queue_kpis(queue).collect()
    assert kpis.asDict() == {
        "cases": 5, "total_amount": 2003000010.0, "mean_score": 61.0, "accounts": 6,
    }
    risks = [tuple(r) for r in cases.risk_distribution(queue).collect()]
    assert risks == [(1, "Low", 1), (2, "Medium", 2), (3, "High", 1)]
    lengths = [tuple(r) for r in cases.length_distribution(queue).collect()]
    assert lengths == [(0, 1), (2, 2), (3, 2)]
    (domains,) = cases.filter_domains(queue).collect()
    assert domains["risk_options"] == ["Low", "Medium", "High"]
    assert (domains["min_length"], domains["max_length"]) == (0, 3)
    header = cases.queue_header(queue).first()
    assert tuple(header) == (5, 2, 2)


def test_overview_of_nothing(queue):
    none = queue.limit(0)
    assert cases.queue_kpis(none).first().asDict() == {
        "cases": 0, "total_amount": 0.0, "mean_score": 0.0, "accounts": 0,
    }
    assert [r["cases"] for r in cases.risk_distribution(none).collect()] == [0, 0, 0]
    assert cases.filter_domains(none).first()["max_amount"] == 1.0


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="risk_score"):
        cases.case_queue(spark.createDataFrame([("C1", "A")], "cycle_id string, path string"))


def test_investigation(queue):
    edges = investigate.case_edges(queue)
    one = [tuple(r) for r in edges.where("cycle_id = 'C002'").orderBy("step").collect()]
    assert one == [("C002", 1, "A", "B"), ("C002", 2, "B", "C"), ("C002", 3, "C", "A")]
    opened = edges.where("cycle_id = 'C003'").orderBy("step").collect()
    assert tuple(opened[-1])[2:] == ("F", "D")
    assert edges.where("cycle_id = 'C004'").count() == 0
    direct = investigate.direct_edges(edges, "B", "A")
    assert sorted((r["cycle_id"], r["source"]) for r in direct.collect()) == [
        ("C001", "A"), ("C001", "B"), ("C002", "A"),
    ]
    assert investigate.direct_edges(edges, "A", "A").count() == 0
    detail = by_id(investigate.case_detail(queue))["C002"]
    assert (detail["accounts"], detail["transfers"]) == (3, 3)
    steps = investigate.case_steps(edges.where("cycle_id = 'C001'")).orderBy("transfer").collect()
    assert (steps[0]["transfer"], steps[0]["flow"]) == ("Transfer 1", "A → B")
