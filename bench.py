"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ["tile_voxel_com", "voxel_com_lines", "core_occupancy", "instance_stats_lines", "nearest_events", "instance_voxel_rep", "voxel_product_pick", "small_instances", "shared_point_owner", "pair_counts", "full_merge_index", "remap_originals"]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from voxstrata.plans.catalogue import QUERIES

    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
