from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloop.functions import text


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    rows = df.select("i", expression(F.col("c")).alias("x")).orderBy("i").collect()
    return [row["x"] for row in rows]


def test_clean_text(spark):
    values = ["  ACH ", "", "   ", "nan", "None", "NaN", "none", None, "\tWire\n", " x\xa0"]
    assert apply(spark, values, text.clean_text) == [
        "ACH", None, None, None, None, "NaN", "none", None, "Wire", "x",
    ]


def test_parse_amount(spark):
    values = [" 1,234.50", "1e3", "abc", "", None, "NaN", "inf", "12d", "-5.00", "0.000001", ".5"]
    assert apply(spark, values, text.parse_amount) == [
        Decimal("1234.5"), Decimal(1000), None, None, None, None, None, None,
        Decimal(-5), Decimal("0.000001"), Decimal("0.5"),
    ]


def test_parse_timestamp(spark):
    values = [
        "2022/09/01 00:20", " 2022/9/1 0:20 ", "2022-09-01 00:20:05", "09/13/2022 10:00",
        "not-a-date", "", None, "2022/02/30 10:00",
    ]
    assert apply(spark, values, text.parse_timestamp) == [
        datetime(2022, 9, 1, 0, 20), datetime(2022, 9, 1, 0, 20), datetime(2022, 9, 1, 0, 20, 5),
        datetime(2022, 9, 13, 10, 0), None, None, None, None,
    ]


def test_parse_timestamp_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 does not exist there on that day.
        assert apply(spark, ["2024/03/10 02:30"], text.parse_timestamp) == [
            datetime(2024, 3, 10, 2, 30)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_parse_label(spark):
    values = ["1", "0", "1.9", "x", None, "", "99999999999", "nan"]
    assert apply(spark, values, text.parse_label) == [1, 0, 1, 0, 0, 0, 0, 0]


@pytest.mark.parametrize("keep_zeros, expected", [(False, "10_8000A"), (True, "010_8000A")])
def test_account_key(spark, keep_zeros, expected):
    df = spark.createDataFrame(
        [(" 010 ", "8000A"), (None, "8000A"), ("010", "None")], "b string, a string"
    )
    key = text.account_key(F.col("b"), F.col("a"), keep_zeros)
    assert [r[0] for r in df.select(key).collect()] == [expected, None, None]


def test_canonical_bank_keeps_a_lone_zero(spark):
    assert apply(spark, ["000", "0", "00a"], text.canonical_bank) == ["0", "0", "00a"]


def test_bank_of(spark):
    values = ["10_8000A", "10_8_9", "plain", "_x", None]
    assert apply(spark, values, text.bank_of) == ["10", "10", "UNKNOWN", "", "UNKNOWN"]


def test_amounts_of_any_size(spark):
    wanted = {
        "1e14": ("1E+14", False),
        "1,000,000,000,000,000.5": ("1000000000000000.5", False),
        "4e-7": ("4E-7", False),
        "0.0000000001": ("1E-10", False),
        "99999999999999999999.9999999999": ("99999999999999999999.9999999999", False),
        "1e20": (None, True),
        "-1e25": (None, True),
        "1e-12": ("0", True),
        "0": ("0", False),
        "0.000": ("0", False),
        "abc": (None, False),
        "NaN": (None, False),
        "": (None, False),
        None: (None, False),
    }
    df = spark.createDataFrame([(k,) for k in wanted], "t string")
    found = df.select("t", text.parse_amount(F.col("t")).alias("amount"), text.unfit_amount(F.col("t")).alias("unfit"))
    for row in found.collect():
        amount, unfit = wanted[row["t"]]
        assert row["unfit"] == unfit, row
        assert row["amount"] == (None if amount is None else Decimal(amount)), row
