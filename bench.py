"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: threads (default 8); BENCH_RUNS: timed runs
per query after one warm-up (default 3, the median counts); BENCH_WORK: folder for the stored catalog.  Each run plans and executes the whole query and drops the rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from firnflow.operators import search
from firnflow.plans.queries import BBOX, PERIOD, QUERIES
from firnflow.plans.views import view
from firnflow.session import build, shared_folder
from firnflow.sources import catalog

HEADLINES = (
    "search_bbox_props",
    "search_polygon",
    "search_many_rois",
    "coverage_by_year",
    "locate_points",
    "point_series",
    "annual_series",
    "first_per_timestamp",
    "monthly_max_ffill",
    "resample_median_m",
    "running_mean",
    "running_mean_wide",
    "profile_points",
    "subcube_point",
    "elevation_series",
    "project_3413",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build(
        "firnflow-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": os.environ.get("BENCH_WORK", "/tmp/firnflow-bench"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # The catalog as it is kept for search, in folders by tile, with its index beside it.
    base = shared_folder(spark, "bench")
    catalog.write_catalog(view(spark, sf_dir, "granules"), base + "/catalog", files=int(cpus))
    stored = catalog.read_hive_catalog(spark, base + "/catalog", merge=False)
    search.tile_index(stored).coalesce(1).write.parquet(base + "/index")
    index = spark.read.parquet(base + "/index")
    where = {"bbox": BBOX, "percent_valid_pixels": 10, **PERIOD}

    work = {name: lambda n=name: QUERIES[n](spark, sf_dir) for name in HEADLINES}
    work["search_unpruned"] = lambda: search.search(stored, **where)
    work["search_pruned"] = lambda: search.search(stored, tile_index=index, **where)

    seconds: dict[str, float] = {}
    for name, make in work.items():
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 4)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
