"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR: data folder; BENCH_CPUS: local cores; BENCH_RUNS: timed runs per batch query after one warm-up (the
median counts; streams run once, as each run starts from an empty table); BENCH_ONLY: comma-separated names.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallywharf.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]


def run(spark, name):
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in ONLY or QUERIES:
        streaming = name.startswith("stream_")
        if not streaming:
            run(spark, name)
        times[name] = round(statistics.median(run(spark, name) for _ in range(1 if streaming else RUNS)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
