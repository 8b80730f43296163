"""One callable per operator: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.checks import tables
from ledgerloop.functions import labels, paths, text
from ledgerloop.operators import (
    case_index,
    cases,
    cleaning,
    cycles,
    export,
    graph,
    investigate,
    motifs,
    scoring,
)
from ledgerloop.operators.ordinal import with_ordinal
from ledgerloop.plans.detection import Settings, find_cases
from ledgerloop.plans.workspace import Workspace
from ledgerloop.sources import merges

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CHUNK_ROWS = 10_000
TOP_ROWS = 1_000
EXPORT_ROWS = 500
# Longest cycle that is listed in the dense graph of all transfers; longer ones are counted there.
CASE_ACCOUNTS = 4


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- shared inputs ---------------------------------------------------------------------------


KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _raw(spark: SparkSession, d: str) -> DataFrame:
    """The raw rows as a stored text table, which is what the cleaning steps read."""
    raw = tables.raw_rows(spark, d).withColumn("row_key", F.concat_ws("_", *KEYS))
    return Workspace(spark).materialize(raw, "raw")


def _normalized(spark: SparkSession, d: str) -> DataFrame:
    parsed = cleaning.normalize_transfers(_raw(spark, d), F.col("row_key"))
    return Workspace(spark).materialize(parsed, "normalized")


def _chunked(spark: SparkSession, d: str) -> DataFrame:
    parsed = cleaning.normalize_transfers(_raw(spark, d), extra=(*KEYS, "row_key"))
    number = F.col("ordinal")
    return with_ordinal(parsed, [F.col(key) for key in KEYS], Workspace(spark)).withColumns(
        {
            "transaction_id": cleaning.transaction_id(number, CHUNK_ROWS),
            "chunk_id": cleaning.chunk_id(number, CHUNK_ROWS),
        }
    )


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """What transfers are made from, written for queries that read both kinds or read them often."""
    return Workspace(spark).materialize(tables.transfer_lines(spark, d), "lines")


def _edges(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return cleaning.graph_edges(tables.all_transfers(spark, d, lines))


def _rings(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return graph.detection_input(tables.ring_transfers(spark, d, lines))


def _cycles(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """The scored cycles: those of 2 to 4 accounts of all transfers."""
    return cycles.detect_cycles(_edges(spark, d, lines), Workspace(spark), 2, CASE_ACCOUNTS)


def _cases(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    return scoring.score_cycles(_cycles(spark, d, lines), Workspace(spark))


def _queue(spark: SparkSession, d: str) -> DataFrame:
    return cases.case_queue(_cases(spark, d))


def _two_accounts(queue: DataFrame) -> tuple[str, str]:
    """The first two accounts of the most urgent case."""
    top = cases.order_queue(queue).select("accounts").first()
    return top["accounts"][0], top["accounts"][1]


def _money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def _time_text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _plain(df: DataFrame) -> DataFrame:
    """Transfers with plain output types."""
    return df.select(
        *[
            _money(c) if c == "amount" else _time_text(c) if c == "timestamp" else F.col(c)
            for c in df.columns
        ]
    )


# -- cleaning --------------------------------------------------------------------------------


@query
def assign_transaction_id(spark, d):
    return _chunked(spark, d).select("row_key", "transaction_id", "chunk_id")


@query
def clean_text(spark, d):
    return _raw(spark, d).select(
        "row_key",
        text.clean_text(F.col("Account")).alias("account"),
        text.clean_text(F.col("`Account.1`")).alias("target"),
        text.clean_text(F.col("Payment Format")).alias("payment_format"),
    )


@query
def account_key(spark, d):
    bank, account = F.col("From Bank"), F.col("Account")
    return _raw(spark, d).select(
        "row_key",
        text.account_key(bank, account).alias("source_account"),
        text.account_key(bank, account, keep_zeros=True).alias("source_with_zeros"),
    )


@query
def parse_amount(spark, d):
    paid = F.col("Amount Paid")
    return _raw(spark, d).select(
        "row_key",
        text.parse_amount(paid).cast("double").alias("amount"),
        text.unfit_amount(paid).alias("amount_unfit"),
    )


@query
def parse_timestamp(spark, d):
    return _raw(spark, d).select(
        "row_key", text.parse_timestamp(F.col("Timestamp")).cast("string").alias("timestamp")
    )


@query
def parse_label(spark, d):
    return _raw(spark, d).select(
        "row_key", text.parse_label(F.col("Is Laundering")).alias("is_laundering")
    )


@query
def normalize_transfers(spark, d):
    return _plain(cleaning.normalize_transfers(_raw(spark, d), F.col("row_key")))


@query
def clean_transfers(spark, d):
    return _plain(cleaning.clean_transfers(_normalized(spark, d)))


@query
def graph_edges(spark, d):
    return _plain(cleaning.graph_edges(cleaning.clean_transfers(_normalized(spark, d))))


@query
def quality_report(spark, d):
    return cleaning.quality_report(_chunked(spark, d))


@query
def quality_totals(spark, d):
    return cleaning.quality_totals(cleaning.quality_report(_chunked(spark, d)))


# -- graph -----------------------------------------------------------------------------------


@query
def labelled_accounts(spark, d):
    return graph.labelled_accounts(_edges(spark, d))


@query
def labelled_subgraph(spark, d):
    return _plain(graph.labelled_subgraph(_edges(spark, d), Workspace(spark)))


@query
def label_totals(spark, d):
    return graph.label_totals(_edges(spark, d))


@query
def edge_pairs(spark, d):
    return graph.edge_pairs(_edges(spark, d)).select(
        "src",
        "dst",
        F.col("first.transaction_id").alias("first_id"),
        F.col("first.amount").cast("double").alias("first_amount"),
        F.col("first.timestamp").cast("string").alias("first_time"),
        F.col("first.transaction_type").alias("first_type"),
        "n_transfers",
        _money("total_amount"),
    )


@query
def pair_transfer_lists(spark, d):
    listed = graph.pair_transfer_lists(_edges(spark, d))
    return listed.select("src", "dst", "transaction_id", _money("amount"), _time_text("timestamp"))


@query
def first_transfer_per_pair(spark, d):
    return _plain(graph.first_transfers(_edges(spark, d)))


@query
def account_nodes(spark, d):
    return graph.endpoints(_edges(spark, d))


@query
def graph_summary(spark, d):
    return graph.graph_summary(_edges(spark, d))


@query
def detect_profile(spark, d):
    return graph.detection_profile(graph.detection_input(tables.all_transfers(spark, d)))


@query
def detect_input_topn(spark, d):
    return _plain(graph.detection_input(tables.all_transfers(spark, d), TOP_ROWS))


# -- cycles ----------------------------------------------------------------------------------


@query
def bounded_cycles(spark, d):
    found = cycles.bounded_cycles(cycles.account_pairs(_rings(spark, d)), Workspace(spark))
    return found.select(paths.display(F.col("path")).alias("path"), "n_accounts")


@query
def short_cycles_all_transfers(spark, d):
    """Cycles of 2 to 4 accounts in the dense graph of all_transfers."""
    found = cycles.bounded_cycles(
        cycles.account_pairs(_edges(spark, d)), Workspace(spark), 2, 4
    )
    return found.select(paths.display(F.col("path")).alias("path"), "n_accounts")


@query
def cycle_counts_all_transfers(spark, d):
    """How many cycles of 2 to 6 accounts all transfers hold, none of them listed."""
    counts = cycles.count_cycles(cycles.account_pairs(_edges(spark, d)), Workspace(spark))
    return counts.withColumn("cycles", F.col("cycles").cast("long"))


@query
def event_cycles(spark, d):
    edges = graph.detection_input(tables.event_transfers(spark, d))
    found = cycles.detect_cycles(edges, Workspace(spark))
    return found.select(
        paths.display(F.col("path")).alias("path"),
        "n_accounts",
        F.col("total").cast("double").alias("total"),
        F.col("first_time").cast("string").alias("first_time"),
        F.col("last_time").cast("string").alias("last_time"),
    )


@query
def canonical_rotation(spark, d):
    ring = F.array("target_account", "source_account", "transaction_type", "transaction_id")
    return tables.all_transfers(spark, d).select(
        "transaction_id", F.concat_ws("|", paths.canonical_rotation(ring)).alias("ring")
    )


@query
def closed_trails(spark, d):
    found = cycles.closed_trails(_rings(spark, d), Workspace(spark))
    return found.select(
        "n_hops",
        paths.display(F.col("path")).alias("path"),
        F.concat_ws(",", "transaction_ids").alias("transaction_ids"),
    )


# -- motifs ----------------------------------------------------------------------------------


@query
def edge_adapter(spark, d):
    other = tables.all_transfers(spark, d).select(
        F.col("source_account").alias("src"), F.col("target_account").alias("dst"), "timestamp"
    )
    return motifs.adapt_edges(other).withColumn("amount", _money("amount"))


@query
def dedup_edges(spark, d):
    return motifs.dedup_edges(motifs.adapt_edges(tables.all_transfers(spark, d))).withColumn(
        "amount", _money("amount")
    )


@query
def motif_two_account(spark, d):
    return motifs.two_account_cycles(tables.all_transfers(spark, d), Workspace(spark))


@query
def motif_three_account(spark, d):
    return motifs.three_account_cycles(tables.all_transfers(spark, d), Workspace(spark))


@query
def motif_union(spark, d):
    return motifs.motif_union(tables.all_transfers(spark, d), Workspace(spark))


@query
def motif_counts(spark, d):
    counts = motifs.motif_counts(tables.all_transfers(spark, d), Workspace(spark))
    return counts.withColumn("cycles", F.col("cycles").cast("long"))


@query
def motif_export_topn(spark, d):
    return motifs.motif_export(tables.all_transfers(spark, d), Workspace(spark), EXPORT_ROWS)


def _pattern(spark, d, length):
    edges = export.export_edges(tables.all_transfers(spark, d))
    return motifs.closed_pattern(edges, length, Workspace(spark)).select(
        "path",
        F.concat_ws(",", "timestamps").alias("timestamps"),
        F.concat_ws(",", F.col("amounts").cast("array<string>")).alias("amounts"),
    )


@query
def pattern_two_hop(spark, d):
    return _pattern(spark, d, 2)


@query
def pattern_three_hop(spark, d):
    return _pattern(spark, d, 3)


# -- scoring ---------------------------------------------------------------------------------


def _found_cycles(spark, d):
    pairs = cycles.account_pairs(_edges(spark, d))
    return cycles.bounded_cycles(pairs, Workspace(spark), 2, CASE_ACCOUNTS).select("path")


@query
def cycle_hops(spark, d):
    first = graph.first_transfers(_edges(spark, d))
    hops = scoring.cycle_hops(_found_cycles(spark, d), first, Workspace(spark))
    return _plain(hops.withColumn("path", paths.display(F.col("path"))))


@query
def cycle_measures(spark, d):
    measured = scoring.measure_cycles(
        _found_cycles(spark, d), graph.first_transfers(_edges(spark, d)), Workspace(spark)
    )
    return scoring.with_measures(measured).select(
        paths.display(F.col("path")).alias("path"),
        "n_accounts",
        F.col("total").cast("double").alias("total_amount"),
        "duration_minutes",
        F.round("spread", 4).alias("amount_variance"),
    )


def _scored(spark, d):
    """Cycles of 2 to 4 accounts of all transfers, and those of 2 to 6 of the ring transfers."""
    lines = _lines(spark, d)
    rings = cycles.detect_cycles(_rings(spark, d, lines), Workspace(spark))
    return scoring.score_measured(_cycles(spark, d, lines).unionByName(rings))


@query
def risk_score(spark, d):
    return _scored(spark, d).select(
        paths.display(F.col("path")).alias("path"), "risk_score", "risk_level"
    )


@query
def risk_level_counts(spark, d):
    return _scored(spark, d).groupBy("risk_level").agg(F.count(F.lit(1)).alias("cycles"))


@query
def risk_explanation(spark, d):
    return _cases(spark, d).select("cycle_id", "explanation")


@query
def score_missing_hops(spark, d):
    """Cycles of all transfers, scored on the hops that were not paid in cash."""
    known = _edges(spark, d).where(F.col("transaction_type") != "Cash")
    ws = Workspace(spark)
    measured = scoring.measure_cycles(_found_cycles(spark, d), graph.first_transfers(known), ws)
    return scoring.score_cycles(measured, ws)


@query
def case_ids(spark, d):
    return _cases(spark, d).select("cycle_id", "path")


@query
def ranked_cases(spark, d):
    settings = Settings(max_cycle_length=CASE_ACCOUNTS)
    return find_cases(tables.all_transfers(spark, d), Workspace(spark), settings)


@query
def ranked_ring_cases(spark, d):
    """Cases of 2 to 6 accounts."""
    return find_cases(tables.ring_transfers(spark, d), Workspace(spark))


@query
def top_cases(spark, d):
    lines = _lines(spark, d)
    rings = cycles.detect_cycles(_rings(spark, d, lines), Workspace(spark))
    ring_cases = scoring.score_cycles(rings, Workspace(spark))
    return scoring.top_cases(_cases(spark, d, lines).unionByName(ring_cases))


# -- labels and paths ------------------------------------------------------------------------


def _levels(spark, d):
    word = F.col("o_orderpriority")
    spelled = (
        F.when(word == "1-URGENT", " HIGH ")
        .when(word == "2-HIGH", "Cao")
        .when(word == "3-MEDIUM", "trung bình")
        .when(word == "5-LOW", "Thap")
        .otherwise(word)
    )
    return spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey",
        spelled.alias("level"),
        (F.col("o_totalprice") * F.pow(F.lit(10.0), F.col("o_orderkey") % 6 - 1)).alias("value"),
    )


@query
def normalize_risk_level(spark, d):
    return _levels(spark, d).select(
        "o_orderkey",
        labels.normalize_risk_level(F.col("level")).alias("risk_level"),
        labels.normalize_risk_level(F.col("level"), labels.VIETNAMESE).alias("risk_level_vi"),
    )


@query
def format_money(spark, d):
    return _levels(spark, d).select("o_orderkey", labels.format_money(F.col("value")).alias("money"))


@query
def bank_id(spark, d):
    return tables.all_transfers(spark, d).select(
        "transaction_id",
        text.bank_of(F.col("source_account")).alias("source_bank"),
        text.bank_of(F.col("target_account")).alias("target_bank"),
        text.bank_of(F.col("transaction_type")).alias("no_bank"),
    )


def _path_texts(spark, d):
    a, b, c = "source_account", "target_account", "transaction_id"
    shape = F.col("transaction_type")
    return tables.all_transfers(spark, d).select(
        "transaction_id",
        F.when(shape == "ACH", F.format_string("['%s', '%s', '%s']", a, b, c))
        .when(shape == "Wire", F.format_string(" %s -> %s -> %s", a, b, a))
        .when(shape == "Cheque", F.format_string("%s, \"%s\",,%s ", a, b, a))
        .when(shape == "Cash", F.format_string("(\"%s\", '%s')", a, b))
        .otherwise(" ")
        .alias("path"),
    )


@query
def parse_path(spark, d):
    return _path_texts(spark, d).select(
        "transaction_id", F.concat_ws("|", paths.parse_path(F.col("path"))).alias("accounts")
    )


@query
def cycle_length(spark, d):
    return _path_texts(spark, d).select(
        "transaction_id", paths.cycle_length(paths.parse_path(F.col("path"))).alias("cycle_length")
    )


# -- case queue ------------------------------------------------------------------------------


@query
def case_queue(spark, d):
    return _queue(spark, d).drop("accounts")


@query
def dirty_case_queue(spark, d):
    """The queue of a case table with bad numbers, unknown levels and scores out of range."""
    queue = cases.case_queue(tables.dirty_cases(spark, d))
    return queue.drop("path", "accounts", "risk_level")


@query
def case_queue_localized(spark, d):
    queue = cases.case_queue(_cases(spark, d), labels.VIETNAMESE)
    return queue.select("cycle_id", "risk_level_norm", "priority", "case_status")


@query
def case_priority(spark, d):
    return _queue(spark, d).select("cycle_id", "risk_level_norm", "risk_score", "priority")


@query
def case_explanation(spark, d):
    return _queue(spark, d).select("cycle_id", "case_explanation")


@query
def queue_order(spark, d):
    return cases.rank_queue(_queue(spark, d), Workspace(spark)).select("queue_rank", "cycle_id")


@query
def queue_projection(spark, d):
    return cases.queue_projection(_queue(spark, d))


@query
def queue_detail(spark, d):
    return cases.queue_detail(_queue(spark, d))


@query
def queue_header(spark, d):
    return cases.queue_header(_queue(spark, d))


@query
def queue_filter_numeric(spark, d):
    return cases.filter_numeric(_queue(spark, d), 9e6, 40.0, (3, 5)).select(
        "cycle_id", "total_amount", "risk_score", "cycle_length"
    )


@query
def queue_filter_membership(spark, d):
    kept = cases.filter_membership(
        _queue(spark, d),
        risks=(labels.ENGLISH.high, labels.ENGLISH.medium),
        statuses=(labels.ENGLISH.in_review,),
    )
    return kept.select("cycle_id", "risk_level_norm", "priority", "case_status")


@query
def queue_mode_filter(spark, d):
    return cases.filter_lengths(_queue(spark, d), (2, 3)).select("cycle_id", "cycle_length")


@query
def cases_with_two_accounts(spark, d):
    queue = _queue(spark, d)
    return cases.filter_two_accounts(queue, *_two_accounts(queue)).select("cycle_id", "path")


@query
def indexed_cases_with_two_accounts(spark, d):
    """The same by the stored index of accounts."""
    ws = Workspace(spark)
    queue = ws.materialize(_queue(spark, d), "queue")
    folder = ws.new_path("case-index")
    case_index.write_case_index(queue, folder)
    return case_index.cases_of_two(spark, folder, queue, *_two_accounts(queue))


@query
def queue_kpis(spark, d):
    return cases.queue_kpis(_queue(spark, d))


@query
def risk_distribution(spark, d):
    return cases.risk_distribution(_queue(spark, d))


@query
def length_distribution(spark, d):
    return cases.length_distribution(_queue(spark, d))


@query
def status_distribution(spark, d):
    return cases.status_distribution(_queue(spark, d))


@query
def amount_vs_score(spark, d):
    return cases.amount_vs_score(_queue(spark, d))


@query
def filter_domains(spark, d):
    found = cases.filter_domains(_queue(spark, d))
    options = ("risk_options", "priority_options", "status_options")
    return found.select(
        "max_amount",
        "min_length",
        "max_length",
        *[F.concat_ws("|", name).alias(name) for name in options],
    )


@query
def case_summary(spark, d):
    return cases.case_summary(_queue(spark, d))


@query
def accounts_in_cases(spark, d):
    return cases.sorted_accounts(_queue(spark, d))


@query
def account_case_membership(spark, d):
    return cases.account_case_membership(_queue(spark, d))


@query
def case_edges(spark, d):
    return investigate.case_edges(_queue(spark, d))


@query
def case_steps(spark, d):
    return investigate.case_steps(investigate.case_edges(_queue(spark, d)))


@query
def direct_edges(spark, d):
    queue = _queue(spark, d)
    return investigate.direct_edges(investigate.case_edges(queue), *_two_accounts(queue))


@query
def case_detail(spark, d):
    return investigate.case_detail(_queue(spark, d))


# -- property graph --------------------------------------------------------------------------


@query
def export_edges(spark, d):
    return export.export_edges(tables.all_transfers(spark, d)).withColumn(
        "amount", _money("amount")
    )


@query
def export_nodes(spark, d):
    return export.export_nodes(export.export_edges(tables.all_transfers(spark, d)))


@query
def merge_nodes(spark, d):
    transfers = tables.all_transfers(spark, d)
    ach = transfers.where(F.col("transaction_type") == "ACH")
    # Known accounts: some of the incoming ones under another label, and many that do not come in.
    existing = (
        export.export_nodes(export.export_edges(ach))
        .unionByName(export.export_nodes(export.export_edges(tables.ring_transfers(spark, d))))
        .select("account_id", "bank_id", F.lit("Client").alias("label"))
        .distinct()
    )
    incoming = export.export_nodes(export.export_edges(transfers))
    return export.merge_nodes(existing, incoming)


@query
def merged_nodes_table(spark, d):
    """merge_nodes into a stored table, the incoming nodes twice."""
    transfers = tables.all_transfers(spark, d)
    ws = Workspace(spark)
    folder = ws.new_path("nodes")
    ach = transfers.where(F.col("transaction_type") == "ACH")
    known = export.export_nodes(export.export_edges(ach)).withColumn("label", F.lit("Client"))
    merges.merge_nodes_into(spark, folder, known, ws)
    incoming = ws.materialize(export.export_nodes(export.export_edges(transfers)), "incoming")
    for _ in range(2):
        merges.merge_nodes_into(spark, folder, incoming, ws)
    return merges.read_merged(spark, folder)


@query
def merge_edges(spark, d):
    transfers = tables.all_transfers(spark, d)
    # Known transfers: some of the incoming ones, and some that do not come in.
    existing = export.export_edges(
        transfers.where(F.col("transaction_type") == "ACH").unionByName(
            tables.ring_transfers(spark, d).where(F.col("transaction_type") == "Wire")
        )
    )
    # Accounts of half the banks are known.
    known = Workspace(spark).materialize(
        export.export_nodes(export.export_edges(transfers)).where(
            F.col("bank_id").cast("int") < 12
        ),
        "nodes",
    )
    merged = export.merge_edges(existing, export.export_edges(transfers), known)
    return merged.withColumn("amount", _money("amount"))
