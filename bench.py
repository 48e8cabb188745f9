"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "rfm_segments",
    "segment_profile",
    "rfm_features",
    "txn_window_stats",
    "txn_percentiles",
    "txn_all_features",
    "baselines",
    "clean_orders",
    "outliers_clip_iqr",
    "scale_robust",
    "ks_drift_flags",
    "segment_stats",
    "kruskal",
    "auc",
    "roc",
    "threshold_sweep",
    "dense_series",
    "rolling",
    "forecast_metrics",
    "kmeans_profile",
    "forest_flags",
    "forecast_trend_season",
    "forecast_arima",
)


def main() -> None:
    from tillscope.plans.catalog import registered
    from tillscope.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE", "8"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog = registered()
    only = sys.argv[1:]
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderpriority").count().collect()  # start the JVM side
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        catalog[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
