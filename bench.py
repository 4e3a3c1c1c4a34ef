"""Times the headline queries and prints one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from ambula.plans import catalogue  # noqa: E402
from ambula.session import get_session  # noqa: E402

HEADLINE = ("verdict", "seg_weights", "sssp_dist", "t_max_by_site", "snap_radius", "grid_nearest", "cell_label_area", "adjacency", "building_time", "dir_paint", "polygons_smoothed", "mvt_tiles")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    took = {}
    for name in HEADLINE:
        start = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
