"""Rule-based risk score of cycles, explanations and ranking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloop.functions import labels, paths
from ledgerloop.operators.ordinal import with_ordinal
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import TOTAL


@dataclass(frozen=True)
class Rules:
    """Thresholds (inclusive) and points of the score."""

    min_accounts: int = 3
    max_accounts: int = 5
    accounts_points: int = 20
    max_minutes: int = 24 * 60
    duration_points: int = 25
    max_spread: float = 0.10
    spread_points: int = 20
    min_total: int = 10_000_000
    total_points: int = 20
    fast_minutes: int = 60
    fast_min_accounts: int = 3
    fast_points: int = 15
    cap: int = 100


def cycle_hops(cycles: DataFrame, first: DataFrame, ws: Workspace) -> DataFrame:
    """One row per hop of each cycle with its representative transfer, null where there is none.

    `first` has one row per pair.  Only pairs on a cycle are looked up in it: where these are few,
    Spark drops all other transfers before it looks for the first of each pair.  They are written
    before the join, so that a hop shared by many cycles can be split.
    """
    steps = cycles.select(
        "path", F.posexplode(paths.hops(F.col("path"))).alias("position", "hop")
    ).select(
        "path",
        (F.col("position") + 1).alias("hop"),
        F.col("hop.source").alias("src"),
        F.col("hop.target").alias("dst"),
    )
    steps = ws.materialize(steps, "cycle-steps")
    wanted = ws.materialize(steps.select("src", "dst").distinct(), "cycle-pairs")
    known = ws.materialize(first.join(wanted, ["src", "dst"], "left_semi"), "first-transfers")
    return steps.join(known, ["src", "dst"], "left").select(
        "path", "hop", "src", "dst", "transaction_id", "timestamp", "amount"
    )


def measure_hops(hops: DataFrame) -> DataFrame:
    """Measures of each cycle over the hops that have a transfer."""
    return hops.groupBy("path").agg(
        F.count(F.lit(1)).cast("int").alias("n_accounts"),
        F.count("transaction_id").alias("n_found"),
        F.sum("amount").cast(TOTAL).alias("total"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


def measure_cycles(cycles: DataFrame, first: DataFrame, ws: Workspace) -> DataFrame:
    return measure_hops(cycle_hops(cycles, first, ws))


def _found(df: DataFrame) -> Column:
    """Number of hops with a transfer; all of them when the cycles carry their own measures."""
    return F.col("n_found") if "n_found" in df.columns else F.col("n_accounts").cast("long")


def with_measures(measured: DataFrame) -> DataFrame:
    """Add duration_minutes (whole minutes, rounded down) and the unrounded amount spread."""
    seconds = F.timestamp_diff("SECOND", F.col("first_time"), F.col("last_time"))
    total = F.col("total").cast("double")
    spread = (F.col("high") - F.col("low")).cast("double") / (total / _found(measured))
    return measured.withColumns(
        {
            "duration_minutes": F.floor(seconds / 60).cast("long"),
            "spread": F.when(_found(measured) > 0, F.when(total == 0, 1.0).otherwise(spread)),
        }
    )


def _reasons(rules: Rules) -> list[tuple[Column, int, Column]]:
    """(rule, points, sentence part) in the order in which they are reported."""
    minutes, accounts = F.col("duration_minutes"), F.col("n_accounts")
    return [
        (
            accounts.between(rules.min_accounts, rules.max_accounts),
            rules.accounts_points,
            F.concat(F.lit("ring of "), accounts.cast("string")),
        ),
        (
            minutes <= rules.max_minutes,
            rules.duration_points,
            F.concat(F.lit("over in "), minutes.cast("string"), F.lit(" min")),
        ),
        (
            F.col("spread") <= rules.max_spread,
            rules.spread_points,
            F.lit(f"even amounts (spread up to {rules.max_spread:.0%})"),
        ),
        (
            F.col("total") >= rules.min_total,
            rules.total_points,
            F.concat(
                F.lit("sum "),
                F.format_number(F.col("total").cast("double"), 0),
                F.lit(f" (from {rules.min_total:,})"),
            ),
        ),
        (
            (minutes <= rules.fast_minutes) & (accounts >= rules.fast_min_accounts),
            rules.fast_points,
            F.lit("quick relay"),
        ),
    ]


def score_measured(measured: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add risk_score, risk_level and the reasons of the rules that fired."""
    df = with_measures(measured)
    found = _found(df) > 0
    score, reasons = F.lit(0), []
    for rule, points, sentence in _reasons(rules):
        fired = F.coalesce(rule, F.lit(False)) & found
        score = score + F.when(fired, points).otherwise(0)
        reasons.append(F.when(fired, sentence))
    return df.withColumns(
        {
            "risk_score": F.least(score, F.lit(rules.cap)).cast("int"),
            "reasons": F.array_compact(F.array(*reasons)),
        }
    ).withColumn("risk_level", labels.risk_level(F.col("risk_score")))


def finding(df: DataFrame) -> Column:
    """What an explanation says after the case id."""
    return (
        F.when(_found(df) == 0, F.lit(": transfers missing"))
        .when(
            F.size("reasons") > 0,
            F.concat(F.lit(" / "), "risk_level", F.lit(" / "), F.concat_ws(", ", "reasons")),
        )
        .otherwise(F.lit(": a ring, otherwise ordinary"))
    )


def with_case_ids(scored: DataFrame, ws: Workspace) -> DataFrame:
    """C001, C002, ... by number of accounts and path, before any ranking; the path becomes text."""
    named = scored.withColumn("path", paths.display(F.col("path")))
    numbered = with_ordinal(named, [F.col("n_accounts"), F.col("path")], ws, "case_number")
    return numbered.withColumn(
        "cycle_id", F.format_string("C%03d", F.col("case_number") + 1)
    ).drop("case_number")


def score_cycles(measured: DataFrame, ws: Workspace, rules: Rules = Rules()) -> DataFrame:
    """Measured cycles to unranked cases: the eight public columns."""
    scored = score_measured(measured, rules)
    # Numbering sorts and writes its rows: they hold what a case shows and no more.
    shown = scored.select(
        "path",
        "n_accounts",
        F.coalesce(F.round("total", 2).cast("double"), F.lit(0.0)).alias("total_amount"),
        "duration_minutes",
        F.round("spread", 4).alias("amount_variance"),
        "risk_score",
        "risk_level",
        finding(scored).alias("finding"),
    )
    return with_case_ids(shown, ws).select(
        "cycle_id",
        "path",
        "total_amount",
        "duration_minutes",
        "amount_variance",
        "risk_score",
        "risk_level",
        F.concat("cycle_id", "finding").alias("explanation"),
    )


def rank_cases(cases: DataFrame) -> DataFrame:
    return cases.orderBy(F.desc("risk_score"), F.desc("total_amount"), "path")


def top_cases(cases: DataFrame, n: int = 10) -> DataFrame:
    return rank_cases(cases).limit(n)
