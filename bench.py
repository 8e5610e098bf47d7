"""Time the registered queries over one data directory; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeworks.plans import load_all  # noqa: E402
from gaugeworks.session import build_session  # noqa: E402

FAMILIES = ("a", "b", "c", "d", "e")
PASSES = ("c1_daily_attribute_stats", "c8_attribute_correlation", "c22_category_distribution", "b10_divergence_report")


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    names = [n for n in registry if n.startswith(only and tuple(only) or FAMILIES)]
    # Warm-up: untimed queries of several kinds start the JVM's compiler, the Parquet reader and the shuffle.
    # The stored tables are built here and in the a11, a12 and b6 entries; their readers are timed apart.
    for name in (*PASSES, "c13_daily_rollup_read", "c14_hourly_rollup_read", "c18_hot_filter", "c24_usage_snapshot"):
        registry[name].run(spark, directory).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        begin = time.perf_counter()
        registry[name].run(spark, directory).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
