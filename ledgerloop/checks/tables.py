"""Transfer-shaped tables derived from the given TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.schema import AMOUNT

# Account numbers per customer in ring_transfers, and suppliers' share of the customers' numbers.
BRANCHES = 10
CUSTOMERS_PER_SUPPLIER = 15
# Account numbers per user in event_transfers.
PURSES = 20


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    # Both tables grow with the data: shuffled, never broadcast.
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)


def _minute_offset():
    late = F.when(F.col("l_partkey") % 5 == 0, 2880).otherwise(0)
    return (F.col("l_partkey") * 37 + F.col("l_linenumber") * 11) % 90 + late


def _time():
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", _minute_offset().cast("int"), start)


def _label():
    return F.when(
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.col("l_discount") >= 0.09),
        1,
    ).otherwise(0)


def transfer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all_transfers and ring_transfers read, for queries that write it to read it often."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        _label().alias("is_laundering"),
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    return joined.drop("o_orderkey")


def _line_type(first: str, second: str, third: str, fourth: str, fifth: str, other: str):
    kind = F.lit(other)
    for number, name in enumerate((first, second, third, fourth, fifth), start=1):
        kind = F.when(F.col("l_linenumber") == number, name).otherwise(kind)
    return kind


def _transfers(lines: DataFrame, source: Column, target: Column) -> DataFrame:
    amount = F.when(
        F.col("l_partkey") % 3 == 0, F.round(F.col("l_extendedprice") * 30, 2)
    ).otherwise(F.round(F.col("l_extendedprice") + 2500000, 2))
    return lines.select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "transaction_id"
        ),
        source.alias("source_account"),
        target.alias("target_account"),
        amount.cast("decimal(18,2)").cast(AMOUNT).alias("amount"),
        _time().alias("timestamp"),
        _line_type("ACH", "Wire", "Cheque", "Cash", "Credit Card", "Credit Card").alias(
            "transaction_type"
        ),
        "is_laundering",
    )


def all_transfers(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """Every order line as a transfer from the customer's to the supplier's account number.
    `lines` are those of transfer_lines, where they have been written."""
    return _transfers(
        lines or transfer_lines(spark, sf_dir),
        F.concat_ws("_", F.col("o_custkey") % 25, "o_custkey"),
        F.concat_ws("_", F.col("l_suppkey") % 25, "l_suppkey"),
    )


def ring_transfers(
    spark: SparkSession, sf_dir: str, lines: DataFrame | None = None
) -> DataFrame:
    """Every order line as a transfer between many more accounts; `lines` as in all_transfers.

    A customer has ten accounts, told apart by the order, and a supplier those of fifteen
    customers, told apart by the part.  An account then has about four transfers in and out at
    any scale, so the number of cycles of up to six accounts stays near a thousand.
    """
    customer = F.col("l_suppkey") * CUSTOMERS_PER_SUPPLIER + F.col("l_partkey") % (
        CUSTOMERS_PER_SUPPLIER
    )
    from_branch = F.col("l_orderkey") % BRANCHES
    to_branch = (F.col("l_partkey") + F.col("l_linenumber")) % BRANCHES
    return _transfers(
        lines or transfer_lines(spark, sf_dir),
        F.concat_ws("_", F.col("o_custkey") % 25, F.col("o_custkey") * BRANCHES + from_branch),
        F.concat_ws("_", customer % 25, customer * BRANCHES + to_branch),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a raw text row, with defects of each kind on some orders."""
    order = F.col("l_orderkey")

    def defect(modulus: int, value):
        return order % modulus == 0, value

    def with_defects(value, *defects):
        for when, bad in reversed(defects):
            value = F.when(when, bad).otherwise(value)
        return value

    bank = F.concat(F.lit("0"), F.col("o_custkey") % 25)
    return _lines(spark, sf_dir).select(
        order.alias("l_orderkey"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        with_defects(
            F.date_format(_time().cast("timestamp"), "yyyy/MM/dd HH:mm"),
            defect(103, F.lit("not-a-date")),
            defect(107, F.lit("")),
        ).alias("Timestamp"),
        with_defects(
            bank,
            defect(109, F.lit(None).cast("string")),
            defect(5, F.concat(F.lit(" "), bank, F.lit(" "))),
        ).alias("From Bank"),
        with_defects(F.col("o_custkey").cast("string"), defect(113, F.lit("None"))).alias("Account"),
        F.concat(F.lit("0"), F.col("l_suppkey") % 25).alias("To Bank"),
        with_defects(F.col("l_suppkey").cast("string"), defect(127, F.lit("nan"))).alias("Account.1"),
        with_defects(
            F.concat(F.lit(" "), F.format_number("l_extendedprice", 2)),
            defect(131, F.lit("abc")),
            defect(137, F.lit("0")),
            defect(139, F.lit("-5.00")),
            defect(151, F.lit("1e14")),
            defect(157, F.lit("1,000,000,000,000,000")),
            defect(163, F.lit("4e-7")),
            defect(167, F.lit("1e25")),
            defect(173, F.lit("1e-12")),
        ).alias("Amount Paid"),
        _line_type(" ACH", "Wire ", "Cheque", "Cash", "", "Credit Card").alias("Payment Format"),
        with_defects(_label().cast("string"), defect(149, F.lit("x"))).alias("Is Laundering"),
    )


def dirty_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a case row of text, as from a file that people have edited: words for numbers,
    scores out of range, unknown levels, levels against the score, and paths of several shapes."""
    key = F.col("o_orderkey")
    a, b = F.concat(F.lit("1_"), "o_custkey"), F.concat(F.lit("2_"), (key % 97).cast("string"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    shape = key % 4
    level = F.get(
        F.array(
            *[F.lit(w) for w in (" HIGH ", "Cao", "trung bình", "medium", "Thap", "low", "weird", None)]
        ),
        (key % 8).cast("int"),
    )
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.lit("C"), key).alias("cycle_id"),
        F.when(shape == 0, F.concat(F.lit("['"), a, F.lit("', '"), b, F.lit("', '3_x']")))
        .when(shape == 1, F.concat(F.lit(" "), a, F.lit(" -> "), b, F.lit(" -> "), a))
        .when(shape == 2, F.concat(a, F.lit(',"'), b, F.lit('",,')))
        .otherwise(F.lit(" "))
        .alias("path"),
        F.when(key % 5 == 0, "n/a")
        .when(key % 7 == 0, "-12.5")
        .when(key % 11 == 0, F.concat(F.lit("  "), price.cast("string"), F.lit(" ")))
        .otherwise((price * 10000).cast("decimal(24,2)").cast("string"))
        .alias("total_amount"),
        F.when(key % 13 == 0, "soon")
        .when(key % 17 == 0, F.lit(None))
        .otherwise((key % 5000).cast("string"))
        .alias("duration_minutes"),
        F.when(key % 19 == 0, "high")
        .when(key % 23 == 0, "55.5")
        .otherwise((key % 141 - 20).cast("string"))
        .alias("risk_score"),
        level.alias("risk_level"),
    )


def event_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transfer to the user of the next event, in real time order.

    A user has twenty accounts, told apart by the event and, on the receiving side, by the
    number in its properties.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("long")
    after = events.select(
        (F.col("event_id") - 1).alias("event_id"),
        (F.col("user_id") * PURSES + k % PURSES).alias("receiver"),
    )
    sender = F.col("user_id") * PURSES + F.col("event_id") % PURSES
    # Both sides grow with the data: shuffled, never broadcast.
    return events.join(after.hint("merge"), "event_id").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat_ws("_", sender % 10, sender).alias("source_account"),
        F.concat_ws("_", F.col("receiver") % 10, "receiver").alias("target_account"),
        F.col("value").cast(AMOUNT).alias("amount"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.lit("event").alias("transaction_type"),
        F.lit(0).alias("is_laundering"),
    )
