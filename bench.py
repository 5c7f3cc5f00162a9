"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (a comma-separated list) and BENCH_REPEATS (default 1; the median counts)
choose what runs. Every result is computed
in full into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from catalog.registry import UNROUNDED, forget, ingested  # noqa: E402

import catalog  # noqa: E402,F401  (registers the queries)

HEADLINE = [
    "family_user",
    "family_user_1111",
    "family_merchant",
    "family_merchant_1111",
    "family_category",
    "family_category_1111",
    "family_brand",
    "family_brand_1111",
    "family_user_merchant",
    "family_cart_purchase_interval",
    "family_merchant_category",
    "family_merchant_brand",
    "family_rfm_repurchase",
    "family_session",
    "cap_then_bin",
    "corr_user_columns",
    "graph_vectors_mixed",
    "family_graph_embedding",
    "family_hetero_graph_embedding",
    "family_factorised_pairs",
    "matrix_short",
    "matrix_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )

    def run(name: str) -> float:
        start = time.perf_counter()
        UNROUNDED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    UNROUNDED["x_date_parts"](spark, sf_dir).count()  # start the JVM before the clock matters
    forget(spark, sf_dir)
    start = time.perf_counter()
    ingested(spark, sf_dir)
    times = {"ingest_log": round(time.perf_counter() - start, 3)}
    run("family_user")
    for name in names.split(",") if names else HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
