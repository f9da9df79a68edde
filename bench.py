"""Headline queries, warm session, median of three; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. ``duckdb`` has the seconds DuckDB
takes for the same results on the same files (``BENCH_DUCKDB=0`` leaves them out). Files that a query
scans are written by its first run, outside the clock.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))

from parcelhouse.session import local_session  # noqa: E402
from parcelhouse.workloads import ORACLES, QUERIES  # noqa: E402

HEADLINE = (
    "w01_keep_last", "w01_keep_last_events", "k02_upsert", "r01_wide", "r02_wide_multi",
    "j03_multi_feature", "a21_parcel_stats", "a22_strip_score", "a09_missing_long",
    "a14_describe", "c06_outliers", "s02_anat",
)


def _median(run, repeats=3):
    run()
    seconds = []
    for _ in range(repeats):
        began = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - began)
    return round(statistics.median(seconds), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    names = sys.argv[1:] or HEADLINE

    def in_spark(name):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    result = {name: _median(in_spark(name)) for name in names}
    line = {
        "metric": "headline_total", "value": round(sum(result.values()), 3), "unit": "sec",
        "queries": result, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_DUCKDB", "1") != "0":
        from compare import duck

        connection = duck(sf_dir)
        line["duckdb"] = {
            name: _median(lambda: connection.execute(ORACLES[name]).fetchall()) for name in names
        }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
