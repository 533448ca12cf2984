"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Every query is
built and fully evaluated into the noop sink: once to warm up, then ``BENCH_RUNS`` times (default 2), the best counts.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_hourly_features",
    "feature_table",
    "e1_demand_weather",
    "i2_dedupe_first",
    "g_row_numbers",
    "g1_lag_window",
    "g4_seasonal_mean",
    "g6_latest_vector",
    "g10_folds_time",
    "z4_clock_lags",
    "f4_metrics",
    "q5_report",
    "l3_wasserstein",
    "l6_drift_report",
    "f10_summary",
]


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from hourline.catalog import REGISTRY
    from hourline.catalog.common import daily
    from hourline.operators.windows import lag_windows
    from hourline.session import configure, stage

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("hourline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    # 42 series of about 2,500 days, near the 96,000 rows and 65 million cells of a year of hours for 11 zones.
    key = F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    matrix_rows = stage(daily(spark, sf_dir, key), "bench-series")
    cases = {name: REGISTRY[name][0] for name in HEADLINE}
    cases["lag_matrix_672"] = lambda s, d: lag_windows(matrix_rows, 672, covariates=[])

    chosen = sys.argv[1:] or list(cases)
    seconds = {}
    for name in chosen:
        best = None
        for attempt in range(runs + 1):
            start = time.perf_counter()
            cases[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt and (best is None or took < best):
                best = took
        seconds[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
