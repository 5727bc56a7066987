"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Every query is executed completely through the ``noop`` sink (no collect), with the cache
cleared between queries so each one pays for its own inputs. The queries run in BENCH_RUNS
rounds (default 3) and the median of each counts. Partition sizes are Spark's defaults. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recengine.plans.registry import QUERIES  # noqa: E402
from recengine.session import local_session  # noqa: E402

HEADLINE = [
    "item_cosine", "item_cf_recommend", "user_cosine", "user_cf_recommend",
    "item_cf_rmse", "user_cf_rmse", "composite_rating", "clean_catalog",
    "hot_by_group_left", "hot_by_month_left", "group_count_2", "cardinality_summary",
    "stacked_value_counts", "rmse_join", "als_rmse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "32")),
                          app="recengine-bench", driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          advisory_partition_size=os.environ.get("BENCH_ADVISORY_PARTITION_SIZE", "64m"))
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["group_count_1"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
        for name in names:
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(round(time.perf_counter() - t0, 3))
            print(f"# {name}: {runs[name][-1]} s", file=sys.stderr, flush=True)
    times = {name: round(statistics.median(x), 3) for name, x in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "runs": runs, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
