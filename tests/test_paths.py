from pyspark.sql import functions as F

from ledgerloop.functions import labels, paths


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    rows = df.select("i", expression(F.col("c")).alias("x")).orderBy("i").collect()
    return [row["x"] for row in rows]


def test_parse_path_shapes(spark):
    cases = {
        "A -> B -> A": ["A", "B", "A"],
        "'A' -> \"B\"": ["A", "B"],
        "['A', 'B', 'A']": ["A", "B", "A"],
        "('A', \"B\")": ["A", "B"],
        "['A, x', 'B']": ["A, x", "B"],
        "[1, 2]": ["1", "2"],
        "[]": [],
        "A, B,, A": ["A", "B", "A"],
        "[A, B": ["A", "B"],
        " ": [],
        "": [],
        "A": ["A"],
    }
    assert apply(spark, [*cases, None], paths.parse_path) == [*cases.values(), []]


def test_cycle_length_counts_different_accounts(spark):
    lengths = apply(
        spark, ["A -> B -> A", "A", None], lambda c: paths.cycle_length(paths.parse_path(c))
    )
    assert lengths == [2, 1, 0]


def test_hops_close_open_paths(spark):
    values = [["A", "B"], ["A", "B", "A"], ["A"], []]
    found = [
        [tuple(h) for h in hops] for hops in apply(spark, values, paths.hops, "array<string>")
    ]
    assert found == [[("A", "B"), ("B", "A")], [("A", "B"), ("B", "A")], [], []]


def test_canonical_rotation_keeps_the_direction(spark):
    values = [["C", "A", "B"], ["B", "A", "C"], ["A"], []]
    assert apply(spark, values, paths.canonical_rotation, "array<string>") == [
        ["A", "B", "C"], ["A", "C", "B"], ["A"], [],
    ]


def test_format_money(spark):
    values = [None, 0.0, 999.5, 2.5, 1234567.0, -2.5e9, 999999.6]
    assert apply(spark, values, labels.format_money, "double") == [
        "0 VND", "0 VND", "1,000 VND", "2 VND", "1.23 million VND", "-2.50 billion VND",
        "1,000,000 VND",
    ]
    assert apply(
        spark, [2e9, 3e6], lambda c: labels.format_money(c, labels.VIETNAMESE), "double"
    ) == ["2.00 tỷ VND", "3.00 triệu VND"]


def test_normalize_risk_level(spark):
    values = [" HIGH", "cao", "Trung Bình", "trung binh", "THẤP", "thap", "?", None]
    assert apply(spark, values, labels.normalize_risk_level) == [
        "High", "High", "Medium", "Medium", "Low", "Low", "Unknown", "Unknown",
    ]


def test_level_or_score_decides_the_priority(spark):
    df = spark.createDataFrame(
        [("Low", 75.0), ("High", 0.0), ("Low", 40.0), ("Unknown", 10.0)], "l string, s double"
    )
    found = df.select(labels.priority(F.col("l"), F.col("s"))).collect()
    words = labels.ENGLISH
    assert [r[0] for r in found] == [words.p1, words.p1, words.p2, words.p3]
