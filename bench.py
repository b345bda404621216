"""Headline timings: one warm-up, then the median of three runs of each query.

Results are written to the ``noop`` sink, so every row is computed and none collected.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from clickloom.plans import catalog
from clickloom.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# One or more per requirement.  The last two start streams and run once after a warm-up.
BATCH = ("session_stat_ratio", "session_rollup", "session_random_extract", "top10_category",
         "top10_session_per_category", "page_convert_rate", "area_top3_product",
         "ad_blacklist_filter", "ad_stat_daily", "ad_province_top3", "ad_click_trend_minute")
STREAM = ("ad_stat_running", "ad_stream_blacklist_replay")


def timed(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    found = {}
    for name in BATCH + STREAM:
        query = catalog.queries()[name]
        timed(query, spark)
        runs = [timed(query, spark) for _ in range(3 if name in BATCH else 1)]
        found[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "total of the headline queries",
                      "value": round(sum(found.values()), 3), "unit": "sec",
                      "queries": found, "sf": os.path.basename(SF_DIR).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
