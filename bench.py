"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3), BENCH_EVENT_LOG (optional folder for
Spark's event log, to read stage and task times).  Each query is run once to warm up,
then BENCH_RUNS times; the median wall time is reported.  Results are
written to Spark's ``noop`` sink, so every row is computed but nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from formlens.plans import catalog  # noqa: E402
from formlens.session import get_session  # noqa: E402

HEADLINE = [
    "cleaned_table",
    "cleaned_all_years",
    "report_suite",
    "report_suite_by_year",
    "category_by_year",
    "age_histogram_by_year",
    "file_kind",
    "header_plan",
    "schema_findings",
    "csv_scan_union",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    event_log = os.environ.get("BENCH_EVENT_LOG")  # optional scratch folder for stage/task times
    if event_log:
        os.makedirs(event_log, exist_ok=True)
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=cpus, event_log_dir=event_log)
    times: dict[str, float] = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
