"""Times the headline queries and prints one JSON line. Set BENCH_SF_DIR and BENCH_CPUS to change where.

Each query runs to completion over its whole input (a ``noop`` write computes every row and column).
The session is warmed with a few whole queries first; each query then has one untimed run. Reported is
the median of BENCH_RUNS runs, and their least and greatest in "spread".
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from scfsweep.plans import catalog

HEADLINE = (
    "spin_sum",
    "response_u",
    "response_alpha",
    "mean_u",
    "mean_alpha",
    "channel_pairs",
    "merged_positional",
    "merged_by_key",
    "merged_mean",
    "merged_mean_by_key",
    "dedupe_results",
    "coverage",
    "pending_jobs",
    "log_picks",
    "mean_from_logs",
    "alpha_block",
    "settings_perturbed",
    "chart_series_arrays",
    "stream_running_mean",
)

WARM_UP = ("response_u", "merged_mean", "log_picks", "response_u", "merged_mean_by_key")


def _scale(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    for name in WARM_UP:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings, spread = {}, {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 4)
        spread[name] = [round(min(seconds[1:]), 2), round(max(seconds[1:]), 2)]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": _scale(sf_dir),
                "spread": spread,
            }
        )
    )


if __name__ == "__main__":
    main()
