"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion into a sink that drops the rows.  Its time is the
best of $BENCH_REPEATS runs (default 3) after one run to warm up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from oreflow.queries import QUERIES
from oreflow.session import build_session

HEADLINES = (
    "valid_reject_split",
    "valid_rows",
    "row_count_audit",
    "dedup_first_wins",
    "dedup_history",
    "latest_per_key",
    "upsert_last_wins",
    "upsert_composite_key",
    "scd1_version_merge",
    "conflict_quarantine",
    "raw_incremental_merge",
    "record_hashes",
    "typed_cast",
    "watermark_per_key",
    "file_ledger_antijoin",
    "consumption_sql_join_group",
    "consumption_sql_window",
    "csv_by_header_name",
    "csv_multiline_text",
    "layers_custom_step",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "oreflow-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        times = []
        for _ in range(repeats + 1):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
