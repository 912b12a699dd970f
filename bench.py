"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Index builds and
priors are timed as they are made; searches read the stored indexes, as they
would in service.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from lodestone.workloads.catalog import REGISTRY
from lodestone.workloads.fixtures import Workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

BUILDS = ["corpus", "body", "title", "anchor", "pagerank", "pageviews", "qrels", "features"]
QUERIES = [
    "search_bm25", "search_body", "search_title", "search_anchor", "search",
    "evaluate_queries", "parameter_sweep", "pagerank_purchases", "term_frequencies",
    "posting_lists", "prune_rare_terms", "lookup_postings", "get_pagerank", "get_pageview",
]


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    work = Workspace(spark, SF_DIR)
    for name in BUILDS:
        timed(f"build_{name}", lambda: getattr(work, name))
    for name in QUERIES:
        timed(name, lambda: REGISTRY[name](spark, SF_DIR)
              .write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
