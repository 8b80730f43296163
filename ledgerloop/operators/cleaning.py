"""Raw rows to clean transfers, edges and a data-quality report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloop.functions import text
from ledgerloop.schema import RAW_REQUIRED, require_columns

CHUNK_ROWS = 100_000
UNFIT = "amount_unfit"
_AMOUNT = "_amount"


def transaction_id(ordinal: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    """T0001_0000000, T0001_0000001, ...: chunk from 1, row in the chunk from 0."""
    chunk = F.floor(ordinal / chunk_rows).cast("long") + 1
    return F.format_string("T%04d_%07d", chunk, ordinal % chunk_rows)


def chunk_id(ordinal: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    return F.floor(ordinal / chunk_rows).cast("long") + 1


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def normalize_transfers(
    raw: DataFrame,
    id_column: Column | None = None,
    keep_zeros: bool = False,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Raw text rows to the transfer schema and `amount_unfit`; projections, no shuffle.

    Without `id_column` the rows get no transaction_id yet.  Write the result before filtering
    it: a filter is pushed below the projections and would parse the text a second time.
    """
    df = require_columns(trim_names(raw), RAW_REQUIRED)
    stripped = df.withColumns({name: text.strip(F.col(f"`{name}`")) for name in RAW_REQUIRED})
    # Numbers and amounts become columns first, like the stripped texts: each is then made once.
    stripped = stripped.withColumn("Amount Paid", text.as_number(F.col("Amount Paid")))
    stripped = stripped.withColumn(_AMOUNT, text.as_amount(F.col("Amount Paid")))
    identity = [] if id_column is None else [id_column.alias("transaction_id")]
    source = text.as_account(F.col("From Bank"), F.col("Account"), keep_zeros)
    target = text.as_account(F.col("To Bank"), F.col("`Account.1`"), keep_zeros)
    return stripped.select(
        *identity,
        source.alias("source_account"),
        target.alias("target_account"),
        F.col(_AMOUNT).alias("amount"),
        text.as_timestamp(F.col("Timestamp")).alias("timestamp"),
        text.as_value(F.col("Payment Format")).alias("transaction_type"),
        text.as_label(F.col("Is Laundering")).alias("is_laundering"),
        text.is_unfit(F.col("Amount Paid"), F.col(_AMOUNT)).alias(UNFIT),
        *extra,
    )


def _has_bad_amount(unfit: Column) -> Column:
    return (F.col("amount").isNull() | (F.col("amount") <= 0)) & ~unfit


def _has_missing_account() -> Column:
    return F.col("source_account").isNull() | F.col("target_account").isNull()


def _is_valid() -> Column:
    return (
        F.col("source_account").isNotNull()
        & F.col("target_account").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.coalesce(F.col("amount") > 0, F.lit(False))
    )


def _is_self_loop() -> Column:
    return F.col("source_account") == F.col("target_account")


def clean_transfers(normalized: DataFrame) -> DataFrame:
    """Valid rows only; transfers of an account to itself stay."""
    return normalized.where(_is_valid()).drop(UNFIT)


def graph_edges(transfers: DataFrame) -> DataFrame:
    """Transfers between two different accounts."""
    return transfers.where(F.col("source_account") != F.col("target_account"))


# 2^14 registers: estimates are off by less than 1 % as a rule.
_SKETCH_BITS = 14


def quality_report(
    normalized: DataFrame, by: str = "chunk_id", with_accounts: bool = False
) -> DataFrame:
    """One row per chunk over the rows before the filter.

    The counters overlap, and self-loops count invalid rows too, so they need not add up to
    the number of removed rows.  Numbers that no amount can hold are counted on their own.
    `with_accounts` adds sketches of the accounts of valid rows, from which quality_totals estimates
    how many there are without reading the rows again.
    """
    sketches = {
        f"{side}s_sketch": F.hll_sketch_agg(F.when(_is_valid(), F.col(side)), _SKETCH_BITS)
        for side in ("source_account", "target_account")
        if with_accounts
    }
    valid = _is_valid()
    unfit = F.col(UNFIT) if UNFIT in normalized.columns else F.lit(False)
    return (
        normalized.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(valid).alias("rows_after_cleaning"),
            F.count_if(_has_bad_amount(unfit)).alias("invalid_amount"),
            F.count_if(F.col("timestamp").isNull()).alias("invalid_timestamp"),
            F.count_if(_has_missing_account()).alias("missing_accounts"),
            F.count_if(_is_self_loop()).alias("self_loop_rows_kept_in_clean_data"),
            F.count_if(valid & ~_is_self_loop()).alias("graph_edge_rows"),
            F.count_if(unfit).alias("amount_unfit_rows"),
            *[sketch.alias(name) for name, sketch in sketches.items()],
        )
        .select(
            "rows_before",
            "rows_after_cleaning",
            (F.col("rows_before") - F.col("rows_after_cleaning")).alias("rows_removed"),
            "invalid_amount",
            "invalid_timestamp",
            "missing_accounts",
            "self_loop_rows_kept_in_clean_data",
            by,
            "graph_edge_rows",
            "amount_unfit_rows",
            *sketches,
        )
    )


def quality_totals(report: DataFrame) -> DataFrame:
    counters = [
        "rows_before",
        "rows_after_cleaning",
        "rows_removed",
        "invalid_amount",
        "invalid_timestamp",
        "missing_accounts",
        "self_loop_rows_kept_in_clean_data",
        "graph_edge_rows",
        "amount_unfit_rows",
    ]
    sketches = [name for name in report.columns if name.endswith("_sketch")]
    return report.agg(
        F.count(F.lit(1)).alias("chunks"),
        *[F.sum(name).alias(name) for name in counters],
        *[
            F.hll_sketch_estimate(F.hll_union_agg(name)).alias(
                f"about_{name.removesuffix('_sketch')}"
            )
            for name in sketches
        ],
    )
