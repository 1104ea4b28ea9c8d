"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  names, comma-separated (default the headline list; "all" for every query)
    BENCH_RUNS     timed runs per query after one warm-up run (default 3; the median counts)
    BENCH_DUCKDB   1 to time the check SQL in DuckDB on the same files too
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.oracle import ORACLE  # noqa: E402
from harness.registry import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = (
    "daily_event_counts",
    "latest_per_key",
    "clean_a_full",
    "clean_b_full",
    "merge_a",
    "merge_b",
    "data_freshness",
    "ingestion_history",
    "top_categories",
    "hourly_activity",
    "executive_dashboard",
    "dq_results",
    "duplicate_keys",
    "dedupe_composite",
    "flatten_nested",
    "normalize_ts",
    "transform_a",
    "transform_records",
    "load_history",
    "land_raw_a",
)


def seconds(run, times: int) -> float:
    run()
    taken = []
    for _ in range(times):
        begin = time.perf_counter()
        run()
        taken.append(time.perf_counter() - begin)
    return round(statistics.median(taken), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    times = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    result = {"metric": "headline_queries_total", "unit": "sec"}
    result["queries"] = {
        n: seconds(lambda n=n: QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save(), times) for n in names
    }
    result["value"] = round(sum(result["queries"].values()), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    result["sf"] = float(scale.group(1)) if scale else None
    if os.environ.get("BENCH_DUCKDB") == "1":
        import duckdb

        db = duckdb.connect()
        db.execute(f"SET threads = {cpus}")
        for file in sorted(os.listdir(sf_dir)):
            db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
        result["duckdb"] = {n: seconds(lambda n=n: db.execute(ORACLE[n]).fetchall(), times) for n in names if n in ORACLE}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
