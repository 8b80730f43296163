"""Removes boilerplate lines: those that stand on many distinct sites.

A line is what lies between two newlines, without white space at its ends; blank lines are never
removed.  Its spread is the number of distinct sources it appears in.

* A HyperLogLog sketch of the sources is merged per line hash.
* Where the estimate is near the threshold, the distinct sources are counted exactly; further away
  the error of the sketch cannot change the verdict.
* A line that spreads over the threshold is removed from every document but the one with the
  smallest id that has it, so nothing disappears from the corpus as a whole.

Lines are known by two 64-bit hashes.  Documents without an id take no part and stay as they are;
a null source is a site of its own; a null text stays null.  Rows that repeat an id are the same
document.  Removing every line leaves an empty text.

Texts of any length are read whole.  Of equal ids either may be the smallest, they are one document.
An empty table gives an empty result.  Stages pass on other columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloop.llm.common import OWN, Workspace, any_columns, read_table

MIN_SITES = 10
#: log2 of the sketch's registers; the standard error is 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12
#: Half width of the band that is counted exactly: this share of the threshold, two at least.
#: It is fifteen standard errors wide.
NEAR = 0.25

_BLANK = " \t\r\f\x0b"


def _key(line: Column) -> tuple[Column, Column]:
    trimmed = F.btrim(line, F.lit(_BLANK))
    return F.xxhash64(trimmed), F.xxhash64(F.lit(1), trimmed)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, ws: Workspace, min_sites: int = MIN_SITES) -> DataFrame:
    """One row per removal: doc_id and the hashes h1, h2 of a line that it loses."""
    h1, h2 = _key(F.col("line"))
    lines = ws.materialize(
        docs.filter("doc_id is not null")
        .select("doc_id", "source", F.explode(_lines(F.col("text"))).alias("line"))
        .filter(F.btrim("line", F.lit(_BLANK)) != "")
        .select(
            "doc_id",
            F.when(F.col("source").isNull(), F.lit("null"))
            .otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
            .alias("site"),
            h1.alias("h1"),
            h2.alias("h2"),
        ),
        "lines",
    )
    band = max(2.0, NEAR * min_sites)
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
        F.min("doc_id").alias("first"),
    )
    spread = ws.materialize(spread.filter(F.col("sites") >= min_sites - band), "spread")
    near = F.col("sites") <= min_sites + band
    exact = (
        lines.join(spread.filter(near).select("h1", "h2", "first"), ["h1", "h2"])
        .groupBy("h1", "h2", "first")
        .agg(F.count_distinct("site").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    chosen = spread.filter(~near).select("h1", "h2", "first")
    chosen = ws.materialize(chosen.unionByName(exact.drop("sites")), "boilerplate")
    return (
        lines.join(chosen, ["h1", "h2"])
        .filter(F.col("doc_id") > F.col("first"))
        .select("doc_id", "h1", "h2")
    )


def remove_lines(docs: DataFrame, ws: Workspace, min_sites: int = MIN_SITES) -> DataFrame:
    """All columns of `docs`, text without boilerplate, and n_lines and n_removed under names that
    start with OWN (both 0 for a null text)."""
    removals = ws.materialize(boilerplate(docs, ws, min_sites), "removals")
    losing = removals.groupBy(F.col("doc_id").alias(f"{OWN}id")).agg(
        F.collect_set(F.struct("h1", "h2")).alias(f"{OWN}lost")
    )
    losing = ws.materialize(losing, "losing")
    # The hint: one plan at every size, whose shuffle is that of the texts.
    joined = docs.join(losing.hint("merge"), docs["doc_id"] == losing[f"{OWN}id"], "left")
    lines = _lines(docs["text"])

    def stays(line: Column) -> Column:
        h1, h2 = _key(line)
        hashes = F.struct(h1.alias("h1"), h2.alias("h2"))
        blank = F.btrim(line, F.lit(_BLANK)) == ""
        return blank | ~F.array_contains(F.col(f"{OWN}lost"), hashes)

    lost = F.col(f"{OWN}lost")
    kept = F.when(lost.isNull(), lines).otherwise(F.filter(lines, stays))
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    n_lines = F.when(docs["text"].isNull(), 0).otherwise(n_lines)
    cleaned = joined.select(
        *[docs[c] for c in docs.columns if c != "text"],
        docs["text"].alias(f"{OWN}before"),
        kept.alias(f"{OWN}kept"),
        n_lines.cast("long").alias(f"{OWN}n_lines"),
    )
    left = F.when(F.col(f"{OWN}before").isNull(), 0).otherwise(F.size(f"{OWN}kept"))
    return cleaned.select(
        *[
            F.array_join(f"{OWN}kept", "\n").alias("text") if c == "text" else F.col(c)
            for c in docs.columns
        ],
        f"{OWN}n_lines",
        (F.col(f"{OWN}n_lines") - left).alias(f"{OWN}n_removed"),
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "source", "text")
    cleaned = remove_lines(docs, Workspace(spark))
    return cleaned.select(
        "doc_id",
        F.col(f"{OWN}n_lines").alias("n_lines"),
        F.col(f"{OWN}n_removed").alias("n_removed"),
        "text",
    )


@any_columns
def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, without its boilerplate lines; n_chars follows the text."""
    cleaned = remove_lines(docs, Workspace(spark))
    return cleaned.select(
        *[
            F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c
            for c in docs.columns
        ]
    )


ORACLE = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
lines AS (
  SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM numbered),
cleaned AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS k FROM lines),
boiler AS (
  SELECT k, min(doc_id) AS first FROM cleaned
  WHERE doc_id IS NOT NULL AND k <> ''
  GROUP BY k HAVING count(DISTINCT coalesce('=' || source, 'null')) >= {MIN_SITES}),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (coalesce(doc_id > first, false)) AS n_removed,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT coalesce(doc_id > first, false)) AS text
  FROM cleaned LEFT JOIN boiler USING (k) GROUP BY r)
SELECT n.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN n.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM numbered n LEFT JOIN kept k USING (r)
"""
