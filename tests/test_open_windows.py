"""Open windows of a stopped job come from its state and give way to the final ones."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from botlens.config import SENSITIVE, Checkpoint
from botlens.plans import detectors
from botlens.streaming import jobs, open_windows, sinks

COLUMNS = ["window_start", "client_ip", "requests_per_ip", "payload_std_per_ip", "bot_probability", "is_bot", "detection_reasons", "user_agent"]


def rows(frame):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in frame.select(COLUMNS).collect())


def test_stream_and_table_give_the_same_windows(spark, tmp_path, dense):
    settings = replace(SENSITIVE, checkpoint=Checkpoint(str(tmp_path / "checkpoint")))
    store = sinks.DetectionStore(str(tmp_path / "store"), "model")
    feed = tmp_path / "feed"

    def go(low, high, part):
        dense.where(F.col("event_id").between(low, high)).coalesce(1).write.parquet(str(feed / f"part={part}"))
        stream = spark.readStream.schema(dense.schema).option("recursiveFileLookup", True).parquet(str(feed))
        query = store.start(jobs.model_stream(stream, settings, spark), settings, once=True)
        query.awaitTermination()
        assert query.exception() is None
        open_windows.write_open_windows(spark, settings, store)

    go(0, 499, 0)
    first = detectors.fallback_detections(dense.where("event_id < 500"), SENSITIVE)
    assert rows(store.windows(spark)) == rows(first) and first.count() > 50
    # The windows grow; 15 minutes later the first ones are final.
    go(500, 999, 1)
    late = dense.where("event_id = 999").withColumn("timestamp", F.expr("timestamp + interval 15 minutes")).withColumn("client_ip", F.lit("end"))
    late.coalesce(1).write.parquet(str(feed / "part=2"))
    batch = rows(detectors.fallback_detections(dense, SENSITIVE))
    assert rows(store.windows(spark)) == batch
    go(5000, 5000, 3)
    found = store.windows(spark).where("client_ip <> 'end'")
    assert rows(found) == batch
    assert found.where("provisional").count() == 0  # all were replaced
    store.compact(spark)
    assert rows(store.windows(spark).where("client_ip <> 'end'")) == batch


def test_other_states_are_refused(spark, tmp_path, dense):
    settings = replace(SENSITIVE, checkpoint=Checkpoint(str(tmp_path / "checkpoint")))
    dense.write.parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(dense.schema).parquet(str(tmp_path / "feed"))
    store = sinks.DetectionStore(str(tmp_path / "store"), "rule")
    store.start(jobs.rule_stream(stream, settings), settings, "update", once=True).awaitTermination()
    with pytest.raises(ValueError, match="not of the model"):
        open_windows.open_windows(spark, str(tmp_path / "checkpoint" / "rule"))
    with pytest.raises(ValueError, match="arrival times"):
        open_windows.open_detections(spark, settings.override({"ml": {"temporal": "exact"}}), "model")
    with pytest.raises(ValueError, match="checkpoint"):
        open_windows.open_detections(spark, SENSITIVE, "model")
