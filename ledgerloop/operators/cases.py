"""The analyst's case queue: derived columns, filters and overview figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloop.functions import labels, paths
from ledgerloop.functions.labels import ENGLISH, Wording
from ledgerloop.functions.text import plain_number, strip
from ledgerloop.operators.ordinal import with_ordinal
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import CASE_REQUIRED, TOTAL, require_columns


def _number(name: str):
    return F.coalesce(plain_number(strip(F.col(name))).try_cast("double"), F.lit(0.0))


def case_queue(cases: DataFrame, words: Wording = ENGLISH) -> DataFrame:
    """Cases with path accounts, normalized level, priority, status, action and a sentence."""
    require_columns(cases, CASE_REQUIRED)
    level, score = F.col("risk_level_norm"), F.col("risk_score")
    return (
        cases.withColumns(
            {
                "cycle_id": F.col("cycle_id").cast("string"),
                "path": F.col("path").cast("string"),
                "total_amount": _number("total_amount"),
                "duration_minutes": _number("duration_minutes"),
                "risk_score": F.greatest(
                    F.lit(0.0), F.least(F.lit(100.0), _number("risk_score"))
                ),
                "accounts": paths.parse_path(F.col("path")),
                "risk_level_norm": labels.normalize_risk_level(F.col("risk_level"), words),
            }
        )
        .withColumn("cycle_length", paths.cycle_length(F.col("accounts")))
        .withColumns(
            {
                "priority": labels.priority(level, score, words),
                "case_status": labels.status(level, score, words),
                "recommended_action": labels.recommended_action(level, score, words),
                "case_explanation": labels.explain_case(
                    F.col("accounts"),
                    F.col("cycle_length"),
                    F.col("total_amount"),
                    F.col("duration_minutes"),
                    level,
                    score,
                    words,
                ),
            }
        )
    )


def _queue_order(words: Wording) -> list:
    return [
        labels.priority_rank(F.col("priority"), words),
        F.desc("risk_score"),
        F.desc("total_amount"),
        F.col("cycle_id"),
    ]


def order_queue(queue: DataFrame, words: Wording = ENGLISH) -> DataFrame:
    return queue.orderBy(*_queue_order(words))


def rank_queue(queue: DataFrame, ws: Workspace, words: Wording = ENGLISH) -> DataFrame:
    """Add queue_rank, 1 for the most urgent case."""
    ranked = with_ordinal(queue, _queue_order(words), ws, "queue_rank")
    return ranked.withColumn("queue_rank", F.col("queue_rank") + 1)


def filter_numeric(
    queue: DataFrame,
    min_amount: float = 0.0,
    min_score: float = 0.0,
    lengths: tuple[int, int] | None = None,
) -> DataFrame:
    kept = queue.where(
        (F.col("total_amount") >= min_amount) & (F.col("risk_score") >= min_score)
    )
    return kept.where(F.col("cycle_length").between(*lengths)) if lengths else kept


def filter_membership(
    queue: DataFrame,
    risks: Sequence[str] = (),
    priorities: Sequence[str] = (),
    statuses: Sequence[str] = (),
) -> DataFrame:
    """An empty selection does not filter."""
    for name, chosen in (
        ("risk_level_norm", risks),
        ("priority", priorities),
        ("case_status", statuses),
    ):
        if chosen:
            queue = queue.where(F.col(name).isin(*chosen))
    return queue


def filter_lengths(queue: DataFrame, lengths: Sequence[int] = ()) -> DataFrame:
    """View mode: (2, 3), (2,), (3,), or () for all."""
    return queue.where(F.col("cycle_length").isin(*lengths)) if lengths else queue


def filter_two_accounts(queue: DataFrame, a: str | None, b: str | None) -> DataFrame:
    """Cases that contain both accounts; no filter unless two different accounts are given."""
    if not a or not b or a == b:
        return queue
    return queue.where(F.array_contains("accounts", a) & F.array_contains("accounts", b))


def queue_projection(queue: DataFrame) -> DataFrame:
    return queue.select(
        F.col("cycle_id").alias("case_id"),
        "priority",
        F.col("case_status").alias("status"),
        F.col("risk_level_norm").alias("risk_level"),
        "risk_score",
        F.col("cycle_length").alias("accounts"),
        "total_amount",
        "duration_minutes",
        "recommended_action",
    )


def queue_detail(queue: DataFrame) -> DataFrame:
    return queue.select(
        F.col("cycle_id").alias("case_id"),
        "path",
        F.col("case_explanation").alias("explanation"),
        F.col("recommended_action").alias("recommendation"),
    )


def queue_header(queue: DataFrame) -> DataFrame:
    return queue.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(F.col("cycle_length") == 2).alias("two_account_cases"),
        F.count_if(F.col("cycle_length") == 3).alias("three_account_cases"),
    )


def _total_amount():
    # Summed as decimals: the result does not depend on the order of the rows.
    return F.coalesce(F.sum(F.col("total_amount").cast(TOTAL)).cast("double"), F.lit(0.0))


def queue_kpis(queue: DataFrame) -> DataFrame:
    accounts = accounts_in_cases(queue).agg(F.count(F.lit(1)))
    return queue.agg(
        F.count(F.lit(1)).alias("cases"),
        _total_amount().alias("total_amount"),
        F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("mean_score"),
    ).select("*", accounts.scalar().alias("accounts"))


def risk_distribution(queue: DataFrame, words: Wording = ENGLISH) -> DataFrame:
    """Cases per level in fixed order, with zero rows for absent levels."""
    counts = [
        F.count_if(F.col("risk_level_norm") == level).alias(f"n{i}")
        for i, level in enumerate(words.risk_order)
    ]
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(level).alias("risk_level"),
            F.col(f"n{i}").alias("cases"),
        )
        for i, level in enumerate(words.risk_order)
    ]
    return queue.agg(*counts).select(F.inline(F.array(*rows)))


def length_distribution(queue: DataFrame) -> DataFrame:
    return (
        queue.groupBy("cycle_length")
        .agg(F.count(F.lit(1)).alias("cases"))
        .orderBy("cycle_length")
    )


def status_distribution(queue: DataFrame) -> DataFrame:
    return (
        queue.groupBy("case_status")
        .agg(F.count(F.lit(1)).alias("cases"))
        .orderBy(F.desc("cases"), "case_status")
    )


def amount_vs_score(queue: DataFrame) -> DataFrame:
    """Points of the amount/score view."""
    return queue.select(
        "cycle_id",
        "total_amount",
        "risk_score",
        "cycle_length",
        "risk_level_norm",
        "priority",
        "case_status",
    )


def filter_domains(queue: DataFrame, words: Wording = ENGLISH) -> DataFrame:
    """Bounds and options offered by the filters, in one pass."""

    def options(name: str):
        return F.sort_array(F.collect_set(name))  # a handful of fixed labels

    return queue.agg(
        F.greatest(F.coalesce(F.max("total_amount"), F.lit(0.0)), F.lit(1.0)).alias("max_amount"),
        F.min("cycle_length").alias("min_length"),
        F.max("cycle_length").alias("max_length"),
        F.collect_set("risk_level_norm").alias("_risks"),
        options("priority").alias("priority_options"),
        options("case_status").alias("status_options"),
    ).select(
        "max_amount",
        "min_length",
        "max_length",
        F.filter(
            F.array(*[F.lit(level) for level in words.risk_order]),
            lambda level: F.array_contains("_risks", level),
        ).alias("risk_options"),
        "priority_options",
        "status_options",
    )


def case_summary(queue: DataFrame, words: Wording = ENGLISH) -> DataFrame:
    """The same figures as key and value rows."""
    figures = queue.agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(F.col("cycle_length") == 2).alias("two"),
        F.count_if(F.col("cycle_length") == 3).alias("three"),
        _total_amount().alias("total"),
    )
    rows = [
        ("Cases", F.col("cases").cast("string")),
        ("Two-account cycles", F.col("two").cast("string")),
        ("Three-account cycles", F.col("three").cast("string")),
        ("Total amount", labels.format_money(F.col("total"), words)),
    ]
    return figures.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in rows]
            )
        )
    )


def account_case_membership(queue: DataFrame) -> DataFrame:
    """(account, case) once each; the lookup table behind account searches."""
    return queue.select(
        F.explode(F.array_distinct("accounts")).alias("account_id"), "cycle_id"
    )


def accounts_in_cases(queue: DataFrame) -> DataFrame:
    return account_case_membership(queue).select("account_id").distinct()


def sorted_accounts(queue: DataFrame) -> DataFrame:
    return accounts_in_cases(queue).orderBy("account_id")
