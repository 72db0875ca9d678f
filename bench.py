"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the number of local cores. Every query is
run to its end into a sink that discards rows, once to warm up and then timed.
"""

import json
import os
import sys
import time

from tallybrook.session import build_session
from tallybrook.suite.queries import all_queries

HEADLINE = [
    "orders_per_window",
    "orders_per_window_1d",
    "orders_enriched",
    "enrich_asof",
    "enrich_replay",
    "window_changelog",
    "orders_strict_no_grace",
    "late_orders",
    "latest_profiles",
    "duplicate_orders",
    "validate_orders",
    "validate_windows",
    "reconcile_windows",
    "dangling_schema_ids",
    "schema_compat_diff",
    "metric_normalise",
    "gauge_latest",
    "counter_rate",
    "relative_drop",
    "outage_episodes",
    "consumer_lag",
    "stream_orders_per_window",
    "stream_strict_no_grace",
    "stream_window_changelog",
]


def discard(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        discard(queries[name](spark, sf_dir))
        started = time.perf_counter()
        discard(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
