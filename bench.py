"""Time the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from quadrille.plans import catalog

NAMES = ["areal_allocation", "overlay_area", "overlay_length", "cut_and_dissolve", "spatial_join", "zonal_stats", "value_raster", "last_by_key", "albers_points", "public_lands"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in NAMES:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "wall time of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
