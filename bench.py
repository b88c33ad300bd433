"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query runs in full, into a sink
that discards the rows. One headline query runs before the clock starts; the times are medians of
three runs, or of one where that takes over LONG seconds.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from tilecast.catalog.queries import QUERIES
from tilecast.session import local_session

HEADLINE = [
    "demand_table",
    "complete_ticks",
    "calendar_geo",
    "gdow_stats",
    "lag_features",
    "quantile_diffs",
    "full_features",
    "baseline_forecast",
    "error_per_place",
    "global_metrics",
    "place_profile",
    "daily_rolling",
    "pivot_day_hour",
    "box_by_hour",
    "geo_clusters",
    "forecast_gbt",
]

RUNS, LONG = 3, 20


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("baseline_forecast")
    spent = {}
    for name in HEADLINE:
        runs = [timed(name)]
        while len(runs) < RUNS and runs[0] <= LONG:
            runs.append(timed(name))
        spent[name] = round(median(runs), 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(spent.values()), 3),
        "unit": "sec",
        "queries": spent,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
