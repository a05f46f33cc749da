"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3). Each figure is the median of warm runs
after one cold run; results are written to the ``noop`` sink, so every column is
computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aeroledger import catalog, catalog_days, catalog_io, catalog_models, catalog_state  # noqa: E402, F401
from aeroledger.session import build_session  # noqa: E402

HEADLINE = [
    "daily_stats", "hourly_stats", "flight_stats", "airline_stats", "ml_confusion", "meteo_stats", "weather_conditions",
    "search_flights", "wide_view", "latest_metar", "best_taf", "late_actuals", "upsert_counters", "route_dim",
    "union_countries", "feature_frame", "gap_removal", "pr_points", "score_metrics", "board_parse", "metar_feed",
    "snapshot_delta", "stream_hourly", "stream_latest", "train_tree_importance",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - began
        # Kept lookups of one run must not help the next.
        spark.catalog.clearCache()
        return taken

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
