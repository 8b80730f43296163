"""Times the main queries and prints one JSON line.

Each query is run to completion into a sink that discards its rows, three times; the
fastest run counts, so that start-up of the JVM is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from ledgerloop.checks.registry import QUERIES

NAMES = (
    "normalize_transfers",
    "clean_transfers",
    "quality_report",
    "labelled_subgraph",
    "edge_pairs",
    "motif_union",
    "motif_counts",
    "bounded_cycles",
    "short_cycles_all_transfers",
    "closed_trails",
    "ranked_cases",
    "case_queue",
    "export_edges",
)


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(int(cpus), 1) if cpus.isdigit() else 8))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {
        name: round(min(run(spark, name, folder) for _ in range(3)), 3) for name in NAMES
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the main queries, best of three runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
