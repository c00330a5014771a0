"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed to completion with the ``noop`` sink (every row is
produced, nothing is collected to the driver). One untimed warm-up run, then
``$BENCH_REPEATS`` timed runs; the per-query figure is the median. Prints one
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

HEADLINE = [
    "total_rows",
    "type_distribution",
    "yearly_district_counts",
    "null_profile",
    "extract_incidents",
    "sample_fraction",
    "shuffled_cap",
    "derive_time_features",
    "monthly_counts",
    "classification_features",
    "classification_features_v1",
    "monthly_panel",
    "stratified_split",
    "class_weights",
    "classification_report",
    "confusion_matrix",
    "model_comparison",
    "standardize_population",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from beatline.plans.catalog import QUERIES
    from beatline.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="beatline-bench")
    names = only or HEADLINE
    results: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    for name in names:
        fn = QUERIES[name]

        def run():
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm-up, twice: code is still being compiled in the first
        run()
        times = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
        print(f"# {name}: {results[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "repeats": repeats,
        "min_max": spread,
    }))


if __name__ == "__main__":
    main()
