"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local threads.
Each time covers building the query (with the small jobs that some operators run first) and
computing every output row, without fetching the rows.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "tile_points", "geohash_points", "ping_cell_features", "pivot_cell_category", "agg_tile_buildings",
    "spatial_contains", "spatial_within", "spatial_join_keyed", "overlap_area", "tile_admin_assignment",
    "ping_admin_tags", "ping_building_visits", "ping_place_visits", "sink_partitioned_roundtrip",
    "impute_cascade", "global_ntile", "rank_match", "household_estimate", "household_correction",
    "district_multiplier", "reallocate_by_buildings", "combine_sources", "profile_numeric",
    "qc_floor_excess_top",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in ("agg_group_sum", "tile_points", "spatial_contains"):  # start the JVM's compilers
        run(name)
    times = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
