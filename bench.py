"""Time the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (cores), ``BENCH_RUNS`` (timed runs
per query, the median counts), ``BENCH_QUERIES`` (comma-separated names, default headline).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ledgerloom.queries.registry import QUERIES
from ledgerloom.session import build_session

HEADLINE = [
    "donor_top4_autres", "activity_star", "donor_summary", "ordered_distinct_codes", "budget_agg",
    "flow_and_finance_lists", "location_lists", "trans_weighted_conditional", "dedup_first", "funder_class",
    "single_country_subquery", "commitment_total", "second_source_dataset", "spend_by_status",
    "total_gap_verdict", "year_gap", "top10_spot", "id_sets", "shared_top20_gap", "missing_detail",
    "missing_by_publisher", "registry_status", "trade_facts", "trade_stats", "latest_releases",
    "period_availability", "xml_series_flatten", "rate_json",
]


def timed(frame_of) -> float:
    start = time.perf_counter()
    frame_of().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus), driver_memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(lambda: QUERIES[name](spark, sf_dir))  # warm-up
        seconds[name] = round(statistics.median(timed(lambda: QUERIES[name](spark, sf_dir)) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
