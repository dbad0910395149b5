"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local
cores, BENCH_QUERIES (optional, comma separated, or "all") other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from snaptrack.plans.catalog import QUERIES
from snaptrack.session import build_session

HEADLINE = (
    "project_snapshot", "scan_nested_json", "snapshot_roundtrip", "parse_amount", "clean_text",
    "dedupe_keep_first", "reconcile_status", "merge_nonblank", "merge_cell_counters",
    "lifecycle_label", "lifecycle_summary", "kpi_summary", "lifecycle_from_history", "run_delta",
    "last_known_value", "same_day_replace", "history_pivot", "run_calendar", "denylist_tag",
    "apply_tag_edits", "attach_marker", "enrich_safe_write", "fallback_lookup",
    "search_any_column", "html_text_lines", "html_record", "stream_ingest_snapshots",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = tuple(QUERIES) if chosen == "all" else tuple(filter(None, chosen.split(","))) or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    seconds = {}
    for name in names:
        times = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries (median of 3 each)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
