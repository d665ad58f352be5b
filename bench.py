"""Headline queries, timed. Prints one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores of the local session (default 8)
    BENCH_REPEATS  timed runs per query; the median counts (default 1)
    BENCH_WARM_DIR folder of small tables on which each query runs once, untimed, so that the
                   JVM has compiled its code (default: sf0.001 beside the tables; "" for none)
    BENCH_QUERIES  comma-separated names instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.catalog import REGISTRY
from tidemark.session import local_session

HEADLINE = (
    "bronze_stocks_scan",
    "news_payload_flatten",
    "news_predicates",
    "bronze_upsert_stocks",
    "bronze_upsert_news",
    "bronze_upsert_insider",
    "sentiment_label",
    "silver_news",
    "gold_price_all",
    "gold_news_rolling",
    "gold_insider_cumulative",
    "dq_unique",
    "master_merge",
    "correlation_matrix",
    "box_stats",
    "hype_correlation",
    "insider_totals",
    "build_layers",
)


def run(spark, folder: str, name: str) -> float:
    """Seconds from building the plan to the last row; rows are computed, not collected."""
    started = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE

    quiet = {"spark.log.level": "ERROR", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    spark = local_session(cpus, partitions=cpus, **quiet)
    small = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001"))
    if small and os.path.isdir(small):
        for name in names:
            run(spark, small, name)
    queries = {}
    for name in names:
        queries[name] = round(statistics.median(run(spark, folder, name) for _ in range(repeats)), 3)
        print(f"{name}: {queries[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "headline_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
