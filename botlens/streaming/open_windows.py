"""Windows that are still open when the model job stops.

In append mode a window comes out once the watermark has passed its end; until then it exists only in the
job's state, and with the last requests the watermark stops too. Spark's state data source reads the state of
the last finished batch from the checkpoint. Here its partial aggregates are finished into detections, marked
``provisional``, and written to the job's store beside the final ones. When the job goes on, it gives those windows out
itself, later and therefore newer, so the final row replaces the provisional one.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botlens.config import Settings
from botlens.operators.detections import with_detection_id
from botlens.operators.scoring import stamp
from botlens.operators.windows import FIRST_VALUES, fill_deviation, no_arrival_times
from botlens.plans import detectors
from botlens.streaming.sinks import DetectionStore

#: Buffers of :func:`botlens.operators.windows.client_windows` in the order of its aggregates.
_BUFFERS = ("count", "sum", "count", "sum", "count", "n", "avg", "m2", "min")
_NAMES = ("requests", "failures", "judged", "payload", "sizes", "n", "mean", "m2", "first")


def _deviation(n: Column, m2: Column) -> Column:
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Model features, as far as seen, of the windows in the state of a stopped stream of ``client_windows``.

    ``checkpoint`` is the folder of that one query.
    """
    state = spark.read.format("statestore").load(checkpoint)
    buffers = state.schema["value"].dataType
    if tuple(buffers.names) != _BUFFERS:
        raise ValueError(f"this state is not of the model's windows: {buffers.names}")
    # Several buffers share a name; a cast goes by position.
    kinds = ", ".join(f"{name}: {field.dataType.simpleString()}" for name, field in zip(_NAMES, buffers.fields))
    rows = state.select("key.window", "key.client_ip", F.col("value").cast(f"struct<{kinds}>").alias("v")).select("window", "client_ip", "v.*")
    rate = F.try_divide(F.col("failures"), F.col("judged"))
    return rows.select(
        "window", "client_ip", F.col("requests").alias("requests_per_ip"), rate.alias("failure_rate_per_ip"),
        F.try_divide(F.col("payload"), F.col("sizes")).alias("avg_payload_per_ip"),
        _deviation(F.col("n"), F.col("m2")).alias("payload_std_per_ip"), rate.alias("protocol_error_rate"),
        *[F.col(f"first.{name}").alias(name) for name in FIRST_VALUES],
    )


def open_detections(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    """Provisional detections of the open windows of the stopped model job ``name``."""
    if settings.ml.temporal != "zero":
        raise ValueError("open windows can be finished without arrival times only (ml.temporal zero)")
    if not settings.checkpoint.location:
        raise ValueError("open windows are read from checkpoint.location")
    held = open_windows(spark, f"{settings.checkpoint.location}/{name}")
    features = no_arrival_times(fill_deviation(held))
    found = detectors.judged_windows(features, settings, detectors.load_model(spark, settings.ml.model_path))
    return stamp(with_detection_id(found)).withColumn("provisional", F.lit(True))


def write_open_windows(spark: SparkSession, settings: Settings, store: DetectionStore) -> None:
    """Add the open windows of a stopped model job to its store, as the newest state of each until the job goes on."""
    beside = DetectionStore(store.path, f"{store.run}-open")
    beside.write_batch(open_detections(spark, settings, store.run), time.time_ns() // 1_000_000)
