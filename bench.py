"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (folder of the test tables), BENCH_CPUS, BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import tempfile
import time
from dataclasses import replace

import pyspark
from pyspark.sql import SparkSession

from botlens import fixtures
from botlens.config import SENSITIVE, Checkpoint
from botlens.plans.catalog import QUERIES
from botlens.streaming import jobs
from botlens.streaming.sinks import DetectionStore

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
HEADLINE = (
    "rule_detections", "fallback_detections", "top_source_ips", "top_bot_paths",
    "latest_detection_per_ip", "exact_temporal_features", "detection_timeline",
    "parse_access_log", "decode_json_events", "error_window", "scale_features",
)
#: Timed once after one run to warm up.
SLOW = ("train_forest",)


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def query_seconds(spark, name: str) -> float:
    def run():
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    warm, runs = (1, 1) if name in SLOW else (3, RUNS)
    for _ in range(warm):
        run()
    return statistics.median(seconds(run) for _ in range(runs))


def stream_rate(spark) -> float:
    """Events per second of the rule detector as an available-now stream into a table."""
    with tempfile.TemporaryDirectory(prefix="botlens-bench-") as folder:
        schema = spark.read.parquet(f"{FOLDER}/events.parquet").schema
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        events = (
            spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(FOLDER)
        )
        settings = replace(SENSITIVE, checkpoint=Checkpoint(f"{folder}/checkpoint"))
        rows = jobs.rule_stream(fixtures.access_logs(events, dense=True), settings)
        store = DetectionStore(f"{folder}/store", "bench")
        took = seconds(lambda: store.start(rows, settings, "update", once=True).awaitTermination())
        return spark.read.parquet(f"{FOLDER}/events.parquet").count() / took


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("botlens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {name: round(query_seconds(spark, name), 3) for name in (*HEADLINE, *SLOW)}
    rate = stream_rate(spark)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(os.path.normpath(FOLDER)).removeprefix("sf"),
        "stream_events_per_second": round(rate),
        "runs": RUNS,
        "machine": f"{platform.machine()}, {os.cpu_count()} cores, local[{CPUS}], Spark {pyspark.__version__}",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
