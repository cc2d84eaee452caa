"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder (default sf0.1), ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed runs per query after one warm-up; the median counts.
A time covers building the plan, running it and reading every result row.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from tickloom.registry.queries import callables
from tickloom.session import build_session

HEADLINE = [
    "silver_ohlcv", "silver_ticks", "intraday_vwap", "sector_performance", "volatility_index",
    "levels_52w", "technical_rating", "anomaly_flags", "cf_engine", "metarule_flags",
    "decision_signals", "forward_close", "case_outcomes", "cbr_lookup", "cbr_lookup_known", "validation",
    "batch_price_iqr", "isolation_forest", "late_bars",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # sliding frames cost far more per byte than a scan: let small inputs use all cores
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            # several partitions per core, so that symbols spread evenly
            "spark.sql.shuffle.partitions": str(4 * cpus),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_of, seconds = callables(), {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            run_of[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
