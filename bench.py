"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is built and run into a no-op sink: one warm-up, then the median of ``$BENCH_RUNS`` runs.
Times include building the plan and the jobs an operator runs to check sizes.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pyspark

from crosscheck.queries import QUERIES
from trackstrata.session import get_spark, holding

HEADLINE = (
    "track_top1",
    "track_votes",
    "process_once_tracks",
    "session_join",
    "session_join_union",
    "session_join_broadcast",
    "merged_tracks",
    "strata3_wide",
    "strata5_wide",
    "strata7_wide",
    "strata8_wide",
    "sample_all_wide",
    "sample_large",
    "sample_chunks",
    "expert_samples",
    "chunk_wide",
    "median_split_by_group",
    "median_money",
    "best_detection_per_track",
    "hist_probability",
    "hist_confidence",
    "attach_crop_path",
    "resolve_files",
    "validation_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            # the files here are small: let a file be read by several cores
            "spark.sql.files.openCostInBytes": str(256 * 1024),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            with holding(spark):
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
        "runs": runs,
        "spark": pyspark.__version__,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
