"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sparkloom.operators import graph, tours  # noqa: E402
from sparkloom.plans.catalog import QUERIES  # noqa: E402
from sparkloom.session import build_session, cut  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    "column_profile", "column_kinds", "feature_quality", "iqr_outliers", "corr_pairs", "histogram",
    "encode_freq", "fit_transform", "k_report", "k_risk", "generalise_numeric", "suppress_rare", "anonymise",
    "inject_random", "inject_block", "fill_mean", "fill_regression", "fill_regression_wide", "evaluate",
    "fm_index", "silhouette", "cluster_stats", "linkage_history", "nation_edges", "greedy_tours", "best_tour", "pheromone_round",
]


def published_graph(spark):
    """The published tour setting: 500 nodes and 100 000 edges."""
    nodes, edges = graph.random_graph(spark.range(500).withColumnRenamed("id", "node"), 100_000)
    return cut(nodes), cut(edges)


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session("sparkloom-bench", f"local[{CPUS}]", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    run = {}
    QUERIES["k_report"].run(spark, SF_DIR).collect()  # start workers and compile once
    for name in HEADLINE:
        def job(q=QUERIES[name]):
            q.run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        run[name] = timed(job)
    nodes, edges = published_graph(spark)
    found = {}

    def nearest():
        found["greedy"] = cut(tours.greedy_tours(nodes, edges, strategy="batches"))
        found["best"] = cut(graph.best_tours(found["greedy"]))

    run["nearest_all_starts_500"] = timed(nearest)
    lengths = {"nearest_all_starts_500": found["best"].agg(F.min("length")).first()[0]}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(run.values()), 3), "unit": "sec",
                      "queries": run, "sf": SF_DIR, "tour_lengths": lengths}))


if __name__ == "__main__":
    main()
