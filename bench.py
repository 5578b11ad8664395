"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one
JSON line. Every query runs once unmeasured and once measured, to the end, with
its result thrown away."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from weblode.registered import QUERIES

HEADLINE = (
    "term_counts",
    "term_counts_documents",
    "posting_lists",
    "edges",
    "pagerank_pages",
    "pagerank_cyclic",
    "search_word",
    "search_stored",
    "search_batch",
    "packed_postings_roundtrip",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # one machine, so its temporary folder will do for what a cluster shares
    shared = tempfile.mkdtemp(prefix="weblode-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weblode-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    result = {
        "metric": "sum of warm query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
