"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession, functions as F

from eventguard.plans.fixture import CONFIG
from eventguard.plans.queries import queries, run_stream
from eventguard.streaming.pipeline import Pipeline
from eventguard.streaming.tables import Arrivals

HEADLINE = [
    "decode_json", "error_reason", "reason_counts", "dup_in_batch", "encode_valid",
    "window_1m", "running_totals", "topic_counters", "recent_dlq_50", "dedup_drop",
]


def timed_batches() -> list[float]:
    """Collects the seconds of every micro-batch from here on."""
    seconds, process = [], Pipeline.process_batch

    def timed(self, df, epoch):
        begin = time.perf_counter()
        process(self, df, epoch)
        seconds.append(time.perf_counter() - begin)

    Pipeline.process_batch = timed
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventguard-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()
    run["rule_range"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)

    batches = timed_batches()
    begin = time.perf_counter()
    tables = run_stream(spark, sf_dir)
    rows = tables.records().count()
    times["stream_route"] = round(time.perf_counter() - begin, 3)
    # What the next micro-batch would read for the days of the newest events.
    state, files = tables.last_state(), 0
    if state.today is not None:
        with tables.ledger(state, Arrivals(1, (state.today,), None, None), CONFIG.ledger_buckets) as read:
            files = read.select(F.input_file_name()).distinct().count() if read is not None else 0
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "stream": {
            "rows_per_sec": round(rows / times["stream_route"], 1),
            "batch_sec_median": round(statistics.median(batches), 3),
            "batch_sec_max": round(max(batches), 3),
            "ledger_files": files,
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
