"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local cores.
``segmentation_job`` is the whole job of the published figure, from CSV files to the
saved tables; ``kmeans_sweep`` is its longest step; the others are single operators.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tessella.catalog.queries import QUERIES

HEADLINE = (
    "scan_csv",
    "describe_numeric",
    "missing_values",
    "feature_pipeline",
    "cluster_profiles",
    "segment_report",
    "churn_by_cluster",
    "silhouette_score",
    "kmeans_lloyd_step",
    "sink_clustered",
    "kmeans_sweep",
    "bisecting_kmeans",
    "segmentation_job",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tessella-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessella-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One query unmeasured, so that the first figure is not JVM start-up.
    QUERIES["row_count"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # Every row is produced and none is kept.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
