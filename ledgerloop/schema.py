"""Fixed schemas; nothing in this package infers a schema from data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Exact amounts make sums independent of the row order.  Ten decimals keep the smallest
# crypto-currency transfers above zero, twenty digits hold the largest ones.  What still does not
# fit is counted (`amount_unfit`) apart from text that is no number.
AMOUNT = T.DecimalType(30, 10)
TOTAL = T.DecimalType(36, 10)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Raw files carry two columns called "Account"; the second one is "Account.1" here (see
# sources.headers).
RAW = _struct(
    *[
        (name, T.StringType())
        for name in (
            "Timestamp",
            "From Bank",
            "Account",
            "To Bank",
            "Account.1",
            "Amount Received",
            "Receiving Currency",
            "Amount Paid",
            "Payment Currency",
            "Payment Format",
            "Is Laundering",
        )
    ]
)

RAW_REQUIRED = (
    "Timestamp",
    "From Bank",
    "Account",
    "To Bank",
    "Account.1",
    "Amount Paid",
    "Payment Format",
    "Is Laundering",
)

TRANSFER = _struct(
    ("transaction_id", T.StringType()),
    ("source_account", T.StringType()),
    ("target_account", T.StringType()),
    ("amount", AMOUNT),
    ("timestamp", T.TimestampNTZType()),
    ("transaction_type", T.StringType()),
    ("is_laundering", T.IntegerType()),
)

CASE = _struct(
    ("cycle_id", T.StringType()),
    ("path", T.StringType()),
    ("total_amount", T.DoubleType()),
    ("duration_minutes", T.LongType()),
    ("amount_variance", T.DoubleType()),
    ("risk_score", T.IntegerType()),
    ("risk_level", T.StringType()),
    ("explanation", T.StringType()),
)

CASE_REQUIRED = (
    "cycle_id",
    "path",
    "total_amount",
    "duration_minutes",
    "risk_score",
    "risk_level",
)

MOTIF = _struct(
    ("cycle_id", T.StringType()),
    ("path", T.StringType()),
    ("cycle_length", T.IntegerType()),
    ("total_amount", T.DoubleType()),
    ("detection_method", T.StringType()),
)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail on the driver, before any job, when a column is absent."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; found: {df.columns}")
    return df
