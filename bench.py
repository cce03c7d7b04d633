"""Times the headline queries and prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from revmap.plans.queries import QUERIES
from revmap.session import build_session

HEADLINE = [
    "raw_summary",
    "raw_duplicates",
    "mapped_view",
    "mapping_master_view",
    "coverage",
    "unmapped_revenue",
    "merged_report",
    "recon_diff",
    "manual_revenue",
    "csv_roundtrip",
    "export_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM compiles and the files are cached before anything is timed.
    for name in ("coverage", "export_summary"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
