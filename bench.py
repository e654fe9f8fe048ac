"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of threads, BENCH_QUERIES an optional
comma list of queries (``all`` for every one), BENCH_RUNS the runs of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from skyledger.bindings import all_queries  # noqa: E402
from skyledger.session import build_session  # noqa: E402

HEADLINE = [
    "fare_route_month", "fare_class_month", "fare_unique", "cabotage_conditional_sums", "combined_sums", "leg_enriched",
    "leg_fare_merge", "final_mart", "mirror_dep_arr", "keep_first_dim", "spread_join", "schedule_mart", "market_intl_daily",
    "market_dom_monthly", "border_anti_join", "live_year", "month_completeness", "month_slice", "inventory_from_html",
    "inventory_new", "manifest_classify", "manifest_upsert", "content_fingerprint", "archive_unpack",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = all_queries()
    names = list(queries) if chosen == "all" else chosen.split(",")

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({
        "metric": "total of the headline queries, warm, median of runs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
