"""Two- and three-account cycles with one row per combination of transfers.

Account cycles are found first, on distinct pairs; transfers are joined to their hops only
afterwards.  Counting and top-n export never list the combinations of a hot pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloop.functions import paths
from ledgerloop.operators.cycles import bounded_cycles
from ledgerloop.operators.ordinal import rank_in_groups
from ledgerloop.plans.workspace import Workspace
from ledgerloop.schema import AMOUNT, TOTAL


_METHOD = {2: "spark_2_cycle", 3: "spark_3_cycle"}  # fixed values
_PREFIX = {2: "S2_", 3: "S3_"}  # fixed values

_NAME_PAIRS = (("source_account", "target_account"), ("src", "dst"))


def endpoint_names(df: DataFrame) -> tuple[str, str]:
    for source, target in _NAME_PAIRS:
        if {source, target} <= set(df.columns):
            return source, target
    raise ValueError(
        f"need source_account and target_account, or src and dst; found: {df.columns}"
    )


def adapt_edges(df: DataFrame) -> DataFrame:
    """Any accepted edge table as src, dst, amount, timestamp, transaction_type, is_laundering.

    The last four are optional and get typed defaults when the column is absent.
    """
    source, target = endpoint_names(df)

    def optional(name: str, kind, default) -> Column:
        value = F.col(name).try_cast(kind) if name in df.columns else F.lit(default).cast(kind)
        return value.alias(name)

    return df.select(
        F.col(source).cast("string").alias("src"),
        F.col(target).cast("string").alias("dst"),
        optional("amount", AMOUNT, 0),
        optional("timestamp", "string", ""),
        optional("transaction_type", "string", ""),
        optional("is_laundering", "int", 0),
    ).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))
    )


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One row per (src, dst, amount, timestamp); the smallest (type, label) is kept."""
    kept = F.min(F.struct("transaction_type", "is_laundering"))
    return (
        edges.groupBy("src", "dst", "amount", "timestamp")
        .agg(kept.alias("kept"))
        .select(
            "src", "dst", "amount", "timestamp", "kept.transaction_type", "kept.is_laundering"
        )
    )


def account_cycles(adapted: DataFrame, low: int, high: int, ws: Workspace) -> DataFrame:
    """Account cycles of low..high accounts, written once; columns path, n_accounts."""
    pairs = adapted.select("src", "dst").distinct()
    return ws.materialize(bounded_cycles(pairs, ws, low, high), "account-cycles")


def _on_cycles(adapted: DataFrame, cycles: DataFrame, ws: Workspace) -> DataFrame:
    """Only the transfers that lie on a cycle; everything after this step works on these."""
    hops = (
        cycles.select(F.explode(paths.hops(F.col("path"))).alias("hop"))
        .select(F.col("hop.source").alias("src"), F.col("hop.target").alias("dst"))
        .distinct()
    )
    # Written first, so that adaptive execution can split a pair with many transfers.
    return adapted.join(ws.materialize(hops, "hops"), ["src", "dst"], "left_semi")


def _cycles_and_edges(
    df: DataFrame, low: int, high: int, ws: Workspace
) -> tuple[DataFrame, DataFrame]:
    # Written once: it is read for the pairs and again for the transfers on cycles.
    adapted = ws.materialize(adapt_edges(df), "adapted")
    cycles = account_cycles(adapted, low, high, ws)
    edges = ws.materialize(dedup_edges(_on_cycles(adapted, cycles, ws)), "edges-on-cycles")
    return cycles, edges


def _of_length(cycles: DataFrame, length: int) -> DataFrame:
    return cycles.where(F.col("n_accounts") == length)


def _node(i: int, length: int) -> Column:
    return F.element_at("path", i % length + 1)


def _attach(cycles: DataFrame, length: int, table: DataFrame, names: list[str], extra=None):
    """Join `table` (src, dst, ...) to every hop; its columns get the hop number appended."""
    result = cycles
    for i in range(length):
        hop = table.select(
            F.col("src").alias("_s"),
            F.col("dst").alias("_d"),
            *[F.col(name).alias(f"{name}_{i + 1}") for name in names],
        )
        on = (_node(i, length) == F.col("_s")) & (_node(i + 1, length) == F.col("_d"))
        if extra is not None:
            on = on & extra(i + 1)
        result = result.join(hop, on).drop("_s", "_d")
    return result


def _motif_rows(combined: DataFrame, length: int) -> DataFrame:
    amounts = [F.col(f"amount_{i + 1}") for i in range(length)]
    total = sum(amounts[1:], amounts[0].cast(TOTAL)).cast(TOTAL)
    path = paths.display(F.col("path"))
    parts = [path]
    for i in range(length):
        parts += [F.col(f"timestamp_{i + 1}"), F.col(f"amount_{i + 1}").cast("string")]
    # The key is unique, edges being deduplicated on it; ids do not depend on partitioning.
    identity = F.concat(
        F.lit(_PREFIX[length]),
        F.md5(F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in parts])),
    )
    return combined.select(
        identity.alias("cycle_id"),
        path.alias("path"),
        F.lit(length).alias("cycle_length"),
        total.cast("double").alias("total_amount"),
        F.lit(_METHOD[length]).alias("detection_method"),
    )


def _motifs(cycles: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    chosen = _attach(_of_length(cycles, length), length, edges, ["amount", "timestamp"])
    return _motif_rows(chosen, length)


def two_account_cycles(df: DataFrame, ws: Workspace) -> DataFrame:
    """One row per two-account cycle and choice of one transfer for each hop."""
    return _motifs(*_cycles_and_edges(df, 2, 2, ws), 2)


def three_account_cycles(df: DataFrame, ws: Workspace) -> DataFrame:
    """One row per three-account cycle and choice of one transfer for each hop."""
    return _motifs(*_cycles_and_edges(df, 3, 3, ws), 3)


def motif_union(df: DataFrame, ws: Workspace) -> DataFrame:
    cycles, edges = _cycles_and_edges(df, 2, 3, ws)
    return _motifs(cycles, edges, 2).unionByName(_motifs(cycles, edges, 3))


def _combinations(length: int) -> Column:
    product = F.col("n_1").cast("decimal(38,0)")
    for i in range(2, length + 1):
        product = (product * F.col(f"n_{i}")).cast("decimal(38,0)")
    return product


def _pair_sizes(edges: DataFrame, ws: Workspace) -> DataFrame:
    return ws.materialize(
        edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")), "pair-sizes"
    )


def _counted_cycles(cycles: DataFrame, sizes: DataFrame, length: int) -> DataFrame:
    counted = _attach(_of_length(cycles, length), length, sizes, ["n"])
    return counted.withColumn("combinations", _combinations(length))


def motif_counts(df: DataFrame, ws: Workspace) -> DataFrame:
    """Number of motif rows per length, from pair sizes instead of the rows themselves."""
    cycles, edges = _cycles_and_edges(df, 2, 3, ws)
    sizes = _pair_sizes(edges, ws)
    counts = [
        _counted_cycles(cycles, sizes, length)
        .agg(F.coalesce(F.sum("combinations"), F.lit(0)).cast("decimal(38,0)").alias("cycles"))
        .select(F.lit(length).alias("cycle_length"), "cycles")
        for length in (2, 3)
    ]
    return counts[0].unionByName(counts[1])


def motif_export(df: DataFrame, ws: Workspace, max_rows: int | None = None) -> DataFrame:
    """The first `max_rows` motif rows, ordered by length, path and then the hops' transfers; all
    of them, in no order, where it is None.

    Work is bounded by `max_rows`: running totals of the combination counts tell which
    combinations are needed, and each is looked up by the rank of its transfers.
    """
    if max_rows is None:
        return motif_union(df, ws)
    cycles, edges = _cycles_and_edges(df, 2, 3, ws)
    sizes = _pair_sizes(edges, ws)
    exported, taken = [], 0
    for length in (2, 3):
        room = max_rows - taken
        first = (
            _counted_cycles(cycles, sizes, length)
            .withColumn("_order", paths.display(F.col("path")))
            .orderBy("_order")
            .limit(room)
        )
        # At most `room` rows remain, so one sorted task is enough for the running total.
        before = F.coalesce(
            F.sum("combinations").over(
                Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        )
        needed = ws.materialize(
            first.withColumn("_before", before)
            .where(F.col("_before") < room)
            .withColumn("_take", F.least("combinations", F.lit(room) - F.col("_before"))),
            f"motif-export-{length}",
        )
        choices = needed.select(
            "*",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("_take").cast("long") - 1)).alias("_k"),
        )
        # _k read as a mixed-radix number, the last hop changing fastest.
        block = F.lit(1).cast("decimal(38,0)")
        for i in range(length, 0, -1):
            k = F.col("_k").cast("decimal(38,0)")
            # Divided without a rest: the quotient of decimals is rounded to six places.
            rank = ((k - k % block) / block).cast("decimal(38,0)") % F.col(f"n_{i}")
            choices = choices.withColumn(f"_rank_{i}", (rank + 1).cast("long"))
            block = (block * F.col(f"n_{i}")).cast("decimal(38,0)")
        ranked = rank_in_groups(
            _on_cycles(edges, needed, ws), ["src", "dst"], ["timestamp", "amount"], ws
        ).where(F.col("rank") <= max_rows)
        combined = _attach(
            choices,
            length,
            ranked,
            ["amount", "timestamp", "rank"],
            lambda i: F.col(f"_rank_{i}") == F.col(f"rank_{i}"),
        )
        exported.append(_motif_rows(combined, length))
        taken += int(needed.agg(F.coalesce(F.sum("_take"), F.lit(0))).first()[0])
        if taken >= max_rows:
            break
    return exported[0] if len(exported) == 1 else exported[0].unionByName(exported[1])


def closed_pattern(
    df: DataFrame, length: int, ws: Workspace, limit: int | None = None
) -> DataFrame:
    """Closed chains of 2 or 3 transfers, one row for every start account.

    `df` is a table of distinct edges.  `limit` keeps the first rows by path and transfers.
    """
    adapted = ws.materialize(adapt_edges(df), "adapted")
    cycles = account_cycles(adapted, length, length, ws)
    edges = ws.materialize(_on_cycles(adapted, cycles, ws), "edges-on-cycles")
    rows = _attach(cycles, length, edges, ["amount", "timestamp"])

    def hop_values(name: str) -> Column:
        return F.array(*[F.col(f"{name}_{i}") for i in range(1, length + 1)])

    turned = rows.select(
        "path",
        hop_values("amount").alias("amounts"),
        hop_values("timestamp").alias("timestamps"),
        F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("turn"),
    ).select(
        paths.display(paths.rotate(F.col("path"), F.col("turn"))).alias("path"),
        paths.rotate(F.col("timestamps"), F.col("turn")).alias("timestamps"),
        paths.rotate(F.col("amounts"), F.col("turn")).alias("amounts"),
    )
    return turned.orderBy("path", "timestamps", "amounts").limit(limit) if limit else turned
