"""Streamed model windows with arrival times equal those of the table."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from botlens.config import SENSITIVE, Checkpoint, Model
from botlens.operators import features, panes, windows
from botlens.plans import detectors
from botlens.streaming import exact_windows, jobs, sinks

LATER = 20_000


@pytest.fixture
def fed(spark, tmp_path):
    """A stream of tables, one batch each."""
    def make(*parts):
        for number, part in enumerate(parts):
            part.coalesce(1).write.parquet(str(tmp_path / "feed" / f"part={number:04d}"))
        reader = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", True).parquet(str(tmp_path / "feed"))

    before = spark.conf.get(exact_windows._PROVIDER)
    yield make
    spark.conf.set(exact_windows._PROVIDER, before)


def requests(make_events, seed, span, count=300):
    """Batches in rough time order: a client with half of all requests, ties, a silent hour, a nameless client."""
    draw = random.Random(seed)
    rows = [
        {"id": i, "at": draw.randrange(0, span * 4) / 4, "ip": draw.choice(["9.9.9.9", "9.9.9.9", "1.1.1.1", None]),
         "bytes": draw.choice([None, draw.randrange(5000)]), "agent": draw.choice(["a", "b", None]), "status": draw.choice([200, 404])}
        for i in range(count)
    ]
    rows += [{"id": count + i, "at": 9000 + i * 7, "ip": "9.9.9.9"} for i in range(10)]
    rows.sort(key=lambda r: r["at"])
    return [make_events(*rows[low : low + 60]) for low in range(0, len(rows), 60)]


def comparable(frame):
    def plain(value):
        return float(f"{value:.9g}") if isinstance(value, float) else value

    flat = windows.flatten_window(frame).where("client_ip is null or client_ip <> 'end'")
    return sorted((tuple(plain(v) for v in r) for r in flat.collect()), key=str)


def streamed(spark, rows, tmp_path, name):
    query = (
        rows.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.exception() is None
    return spark.table(name)


@pytest.mark.parametrize("duration, slide", [("60 seconds", "30 seconds"), ("2 minutes", "10 seconds")])
def test_stream_equals_table(spark, fed, make_events, tmp_path, duration, slide):
    parts = requests(make_events, 7, 1500)
    assert spark.conf.get("spark.sql.streaming.statefulOperator.checkCorrectness.enabled") == "true"
    stream = fed(*parts, make_events({"at": LATER, "ip": "end"}), make_events({"at": LATER + 1, "ip": "end"}))
    rows = exact_windows.exact_windows(features.model_row_features(stream), duration, slide)
    found = streamed(spark, rows, tmp_path, f"exact{slide[:2]}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    batch = panes.feature_windows(features.model_row_features(whole), duration, slide, gaps=True)
    assert comparable(found) == comparable(batch.select(found.columns))


def test_a_forgotten_client_has_no_gap(spark, fed, make_events, tmp_path):
    rows = [make_events({"at": at, "ip": "1.1.1.1"}) for at in (0, 30, 4000, 4030)]
    stream = fed(*rows, make_events({"at": LATER, "ip": "end"}), make_events({"at": LATER + 1, "ip": "end"}))
    made = exact_windows.exact_windows(features.model_row_features(stream), "30 seconds", "30 seconds", forget_after="30 minutes")
    found = streamed(spark, made, tmp_path, "forgetful").where("client_ip = '1.1.1.1'").orderBy("window.start")
    assert [r.time_since_last_request for r in found.collect()] == [0.0, 30.0, 0.0, 30.0]
    with pytest.raises(ValueError):
        exact_windows.exact_windows(features.model_row_features(stream), "50 seconds", "20 seconds")


def test_model_job_with_exact_arrival_times(spark, fed, make_events, tmp_path):
    parts = requests(make_events, 9, 900, 120)
    settings = replace(SENSITIVE, ml=Model(temporal="exact"), checkpoint=Checkpoint(str(tmp_path / "checkpoint")))
    stream = fed(*parts, make_events({"at": LATER, "ip": "end"}), make_events({"at": LATER + 1, "ip": "end"}))
    store = sinks.DetectionStore(str(tmp_path / "store"), "model")
    query = store.start(jobs.model_stream(stream, settings, spark), settings, once=True)
    query.awaitTermination()
    assert query.exception() is None
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    columns = ["window_start", "client_ip", "requests_per_ip", "bot_probability", "is_bot", "time_since_last_request"]
    batch = detectors.fallback_detections(whole, settings, "exact").select(columns)
    found = store.read(spark).where(F.col("client_ip").isNull() | (F.col("client_ip") != "end")).select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, batch.collect()))
