"""Headline queries, seconds each, as one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3, the median counts, after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "gold_event_matrix", "gold_schools", "gold_yearly", "gold_stops",
    "annualised_rate", "pivot_category_rate", "cond_agg_multi", "deviation_weighted", "deviation_by_year",
    "yoy_change", "yoy_by_rows", "numeric_named_aggs", "exact_group_median", "comma_list_union",
    "clean_int", "clean_date", "cast_failures", "raw_scan", "positional_extract",
    "grain_merge_composite", "merge_chain_yearly", "enrich_suffix", "unpivot_year_columns", "first_per_key", "upsert_by_key",
    "grid_to_lonlat_points", "points_in_polygons_grid", "constraint_summary", "pending_months", "json_rollup", "incremental_load",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from wardmetrics import build_session
    from wardmetrics.catalogue import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale, "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
