"""One key with a third of all rows: the joins must be split at run time."""

import pytest
from pyspark.sql import functions as F

from ledgerloop.operators import cycles, graph, motifs, scoring
from ledgerloop.operators.ordinal import rank_in_groups

ROWS = 60_000

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    # Splits follow the map outputs, so there have to be several of them.
    "spark.sql.files.maxPartitionBytes": "128k",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture
def splitting(spark):
    old = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hub(spark, ws, splitting):
    """A third of all transfers leave one account."""

    def pick(salt, n):
        return F.concat(F.lit("a"), F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("string"))

    rows = spark.range(ROWS).select(
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hub").otherwise(pick("s", 9000)).alias("source_account"),
        F.when(F.col("id") % 50 == 1, "hub").otherwise(pick("d", 9000)).alias("target_account"),
        (F.col("id") % 97 + 1).cast("decimal(30,10)").alias("amount"),
        F.timestamp_add(
            "MINUTE", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")
        ).alias("timestamp"),
        F.lit("ACH").alias("transaction_type"),
        (F.col("id") % 20 == 0).cast("int").alias("is_laundering"),
    )
    return ws.materialize(rows.repartition(12), "hub")


def was_split(df):
    rows = df.collect()
    return len(rows), "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_degrees(ws, hub):
    pairs = ws.materialize(cycles.account_pairs(hub).repartition(12), "pairs")
    rows, split = was_split(cycles._with_degrees(pairs, ws, trim=True))
    assert split and rows > 0


def test_labelled_subgraph(ws, hub):
    rows, split = was_split(graph.labelled_subgraph(hub, ws))
    assert split
    labelled = {r[0] for r in graph.labelled_accounts(hub).collect()}
    assert rows == hub.where(
        F.col("source_account").isin(*labelled) | F.col("target_account").isin(*labelled)
    ).count()


def test_transfers_on_cycles(spark, ws, hub):
    hot = hub.withColumn(
        "target_account",
        F.when(F.col("source_account") == "hub", "a1").otherwise(F.col("target_account")),
    )
    found = spark.createDataFrame([(["a1", "hub"],), (["a2", "a3"],)], "path array<string>")
    rows, split = was_split(motifs._on_cycles(motifs.adapt_edges(hot), found, ws))
    assert split and rows >= ROWS // 3


def test_hop_shared_by_many_cycles(spark, ws, hub):
    found = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.array(F.lit("hub"), F.lit("a1"), F.concat(F.lit("x"), "id")))
        .otherwise(F.array(F.concat(F.lit("y"), "id"), F.concat(F.lit("z"), "id")))
        .alias("path")
    )
    stored = ws.materialize(found.repartition(12), "cycles")
    rows, split = was_split(scoring.cycle_hops(stored, graph.first_transfers(hub), ws))
    assert split and rows == 10_000 * 3 + 10_000 * 2


def test_cycles_through_the_hub_are_complete(ws, hub):
    two = cycles.bounded_cycles(cycles.account_pairs(hub), ws, 2, 2)
    pairs = {tuple(r) for r in cycles.account_pairs(hub).collect()}
    assert {tuple(r["path"]) for r in two.collect()} == {
        (s, d) for s, d in pairs if s < d and (d, s) in pairs
    }


@pytest.fixture
def hot_pair(spark, ws, splitting):
    """A third of all transfers go from one account to one other; some come back."""
    rows = spark.range(ROWS).select(
        F.concat(F.lit("t"), F.col("id")).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 500)).alias("source_account"),
        F.when(F.col("id") % 3 == 0, "pair")
        .when(F.col("id") % 500 == 1, "hot")
        .otherwise(F.concat(F.lit("b"), F.col("id") % 400))
        .alias("target_account"),
        (F.col("id") + 1).cast("decimal(30,10)").alias("amount"),
        F.timestamp_add("MINUTE", (F.col("id") % 9000).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("timestamp"),
        F.lit("ACH").alias("transaction_type"),
        F.lit(0).alias("is_laundering"),
    )
    back = rows.where("transaction_id in ('t0', 't3', 't6')").select(
        "transaction_id",
        F.lit("pair").alias("source_account"),
        F.lit("hot").alias("target_account"),
        *rows.columns[3:],
    )
    return ws.materialize(rows.unionByName(back), "hot-pair")


def test_the_rank_of_a_hot_pair_is_found_by_many_tasks(spark, ws, hot_pair):
    edges = motifs.dedup_edges(motifs.adapt_edges(hot_pair))
    ranked = rank_in_groups(edges, ["src", "dst"], ["timestamp", "amount"], ws)
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()
    rows = ranked.where("src = 'hot'").select("rank", "timestamp", "amount").orderBy("timestamp", "amount").collect()
    assert [r["rank"] for r in rows] == list(range(1, ROWS // 3 + 1))
    placed = spark.read.parquet(f"{ws.folder}/*-_number-sorted").where("src = 'hot'")
    most = placed.groupBy("_part").count().agg(F.max("count")).first()[0]
    assert most < 0.6 * ROWS / 3
    others = ranked.where("src <> 'hot'").groupBy("src", "dst").agg(F.max("rank").alias("top"), F.count("*").alias("n"))
    assert others.where("top <> n").isEmpty()


def test_the_first_motifs_of_a_hot_pair(spark, ws, hot_pair):
    n = 10_000
    found = motifs.motif_export(hot_pair, ws, n)
    assert found.count() == n
    out = hot_pair.where("source_account = 'hot'").orderBy("timestamp", "amount").select("amount")
    first = [r["amount"] for r in out.limit(n // 3 + 1).collect()]
    wanted = sorted([float(x + y) for x in first for y in (1, 4, 7)][:n])
    assert sorted(r["total_amount"] for r in found.select("total_amount").collect()) == wanted
