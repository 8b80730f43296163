"""Mixes sources to target weights by weighted sampling without replacement.

The size of a document is its number of words.  Sources, in the order of their names (code points,
null last), weigh 5, 2, 1, 5, 2, 1, ...; the words of all documents are shared out by weight.  A
source gets at most three times its own words, the rest is shared out again among the others until
no source is above.

A source is first taken whole as often as its target allows.  For what remains every document
draws an exponential number divided by its quality weight (Efraimidis and Spirakis); in ascending
order of these keys documents are taken until their sizes, added up, come nearest to the rest.

The order is never established in one task: keys fall into narrow intervals, their sizes are added
up per interval, and only the one interval of a source in which the budget ends is sorted.

Nulls: a null text has size 0; a null source is a source of its own; a document without a quality
label has the weight of unlabelled ones.  The draw depends on the id alone, so documents with the
same id (or a null id) draw the same number, ties are ordered by id, then size, then whatever
order the rows have.  Documents of size 0 are taken as often as their neighbours in the order, three
times at most; they add nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloop.llm.common import OWN, WORD, Workspace, any_columns, read_table

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
#: Weight of a document by its quality label; unlabelled ones lie between.
QUALITY_WEIGHT = {1: 1.0, 0: 0.25}
UNLABELLED_WEIGHT = 0.5
#: Intervals of keys per source.  Keys are exponential, with the quality weight of their document as
#: rate; intervals are cut by the mean of the distribution functions of the three weights.  One of
#: them thus holds at most 3/4096 of a source's documents, whatever their weights, but for chance and
#: for documents that share an id.
INTERVALS = 4096
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column) -> Column:
    """A number in (0, 1) from the id; a null id draws like the text 'null'."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(text.cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**48)


def interval(key: Column) -> Column:
    """The number of a key's interval; larger keys have the same or a larger one."""
    weights = (*QUALITY_WEIGHT.values(), UNLABELLED_WEIGHT)
    below = sum((1 - F.exp(-w * key) for w in weights), F.lit(0.0)) / len(weights)
    return F.floor(below * INTERVALS).cast("int")


def targets(sizes: DataFrame) -> DataFrame:
    """Of one row per source (source, source_size): the same with its target.

    The share of a source is min(3 * size, level * weight) with one level for all, which is where
    repeated sharing out ends.  Sources that reach their bound first come first in the order of
    bound / weight, so the level follows from sums along that order.  One row per source goes
    through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    slot = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (slot + 1).cast("int"))
    every = Window.partitionBy()
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    bound = F.col("source_size") * MOST_EPOCHS
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("full_at", bound / F.col("weight"))
        .withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("size_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn(
            "level",
            (F.col("all_size") - F.col("size_before") * MOST_EPOCHS)
            / (F.col("all_weight") - F.col("weight_before")),
        )
    )
    # Further along the order sources are counted as full that are not: the level only falls.
    open_level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every)
    full = F.col("full_at") < F.coalesce(open_level, F.lit(float("inf")))
    return ranked.withColumn("open_level", open_level).select(
        "source",
        "source_size",
        F.when(full, bound.cast("double"))
        .otherwise(F.col("open_level") * F.col("weight"))
        .alias("target"),
    )


def sample(docs: DataFrame, labels: DataFrame | None, ws: Workspace) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (= copies *
    size).  `docs` needs doc_id, text and source; `labels` doc_id and quality."""
    measured = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    if labels is None:
        weighted = measured.withColumn("w", F.lit(1.0))
    else:
        known = (
            labels.filter("doc_id is not null")
            .groupBy("doc_id")
            .agg(F.max(F.when(F.col("quality").isin(0, 1), F.col("quality"))).alias("quality"))
        )
        of_label = F.lit(UNLABELLED_WEIGHT)
        for label, value in QUALITY_WEIGHT.items():
            of_label = F.when(F.col("quality") == label, value).otherwise(of_label)
        weighted = measured.join(known, "doc_id", "left").withColumn("w", of_label).drop("quality")
    key = -F.log(draw(F.col("doc_id"))) / F.col("w")
    drawn = ws.materialize(
        weighted.withColumn("key", key)
        .withColumn("part", interval(F.col("key")))
        .drop("w"),
        "drawn",
    )
    parts = drawn.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    parts = ws.materialize(parts, "parts")
    sizes = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    goal = ws.materialize(targets(sizes), "targets").withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(1)
        .cast("long"),
    )
    goal = goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    so_far = Window.partitionBy("source").orderBy("part")
    # Few rows per source: at most INTERVALS + 1.
    intervals = (
        parts.withColumn("part_end", F.sum("part_size").over(so_far))
        .withColumn("part_start", F.col("part_end") - F.col("part_size"))
        .join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
    )
    intervals = ws.materialize(intervals, "intervals")
    within = F.col("part_end") <= F.col("rest")
    beyond = F.col("part_start") >= F.col("rest")
    placed = drawn.join(
        intervals.select(
            F.col("source").alias("s"),
            F.col("part").alias("p"),
            "part_start",
            "source_size",
            "target",
            "epochs",
            "rest",
            F.when(within, F.lit(1)).when(beyond, F.lit(0)).alias("whole"),
        ),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")),
    ).drop("s", "p")
    order = Window.partitionBy("source", "part").orderBy("key", "doc_id", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        placed.filter("whole is null")
        .withColumn("end", F.sum("size").over(running) + F.col("part_start"))
        .withColumn(
            "more", (F.col("end") - F.col("size") / 2 <= F.col("rest")).cast("long")
        )
        .drop("end")
    )
    clear = placed.filter("whole is not null").withColumn("more", F.col("whole").cast("long"))
    # Only documents of size 0 would pass the bound: they fit a budget of nothing.
    copies = F.least(F.col("epochs") + F.col("more"), F.lit(MOST_EPOCHS))
    return clear.unionByName(cut).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    labels = read_table(spark, folder, "labels")
    mixed = sample(docs, labels, Workspace(spark))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@any_columns
def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    mixed = sample(docs, read_table(spark, folder, "labels"), Workspace(spark))
    times = mixed.filter("copies > 0").select(
        F.col("doc_id").alias(f"{OWN}id"), F.col("copies").alias(f"{OWN}copies")
    )
    # Rows that repeat an id draw alike; the id tells how often such a document is taken.
    times = times.groupBy(f"{OWN}id").agg(F.max(f"{OWN}copies").alias(f"{OWN}copies"))
    times = Workspace(spark).materialize(times, "times")
    # The hint: one plan at every size, whose shuffle is that of the texts.
    each = docs.join(times.hint("merge"), docs["doc_id"].eqNullSafe(F.col(f"{OWN}id")))
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{OWN}copies")))
    return each.select(*[docs[c] for c in docs.columns], repeated.alias(f"{OWN}n")).drop(f"{OWN}n")


ORACLE = f"""
WITH measured AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
known AS (
  SELECT doc_id, max(CASE WHEN quality IN (0, 1) THEN quality END) AS quality
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
drawn AS (
  SELECT m.*, -ln((('0x' || substr(md5('{SEED}:' || coalesce(m.doc_id::VARCHAR, 'null')), 1, 12))
           ::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
         / CASE quality WHEN 1 THEN 1.0::DOUBLE WHEN 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END
         AS sort_key
  FROM measured m LEFT JOIN known USING (doc_id)),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM drawn GROUP BY source),
levels AS (
  SELECT a.source, a.source_size, a.weight,
         -- the level at which all shares, bounded, add up: tried at each source's own bound
         ((SELECT sum(source_size) FROM per_source)
          - coalesce((SELECT sum(3 * b.source_size) FROM per_source b
                      WHERE 3 * b.source_size / b.weight < 3 * a.source_size / a.weight), 0))
         / (SELECT sum(b.weight) FROM per_source b
            WHERE 3 * b.source_size / b.weight >= 3 * a.source_size / a.weight) AS level
  FROM per_source a),
goal AS (
  SELECT source, source_size,
         least(3.0::DOUBLE * source_size,
               weight * (SELECT max(level) FROM levels
                         WHERE level <= 3 * source_size / weight)) AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 1 END::BIGINT
           AS epochs,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.sort_key, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) AS size_end
  FROM drawn d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN size_end - size / 2.0::DOUBLE
                                   <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT
         AS taken
FROM placed
"""
