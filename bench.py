"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from trailmark.plans.queries import QUERIES

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
NAMES = ["p12_matrix_product", "p30_depth_recode", "j01_classify_points", "j09_history_exclusion", "j11_close_endpoints", "a02_grid_counts", "a03_voxel_representative", "a06_floor_level", "a09_displacement_summary", "a11_scene_and_total", "a27_zbuffer", "w01_tangents", "w07_global_offsets", "w11_densify", "r02_dilate", "r07_distance", "j05_positional_zip", "j07_frames_in_ranges"]


def main():
    spark = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in NAMES:
        runs = []
        for _ in range(3):
            began = time.time()
            QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(median(runs), 3)
    print(json.dumps({"metric": "sum of median seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF}))
    spark.stop()


if __name__ == "__main__":
    main()
