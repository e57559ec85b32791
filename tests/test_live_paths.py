"""Live bot paths equal the report over the finished tables, and hold no state of past pieces."""

import random
from datetime import timedelta

import pytest
from conftest import START
from pyspark.sql import functions as F

from botlens.operators import report
from botlens.streaming import live_paths

EVENT = "timestamp timestamp, client_ip string, path string"
WINDOW = "window_start timestamp, window_end timestamp, client_ip string"


def at(seconds):
    return START + timedelta(seconds=seconds)


def rows_of(seed, batches, span=40):
    """Requests in batches of ``span`` seconds, with a client of half of all, and detections of 20-second windows every 10."""
    draw = random.Random(seed)
    requests, bots = [], []
    for k in range(batches):
        low = k * span
        requests.append([
            (at(low + draw.randrange(span * 4) / 4 - draw.choice([0, 0, 5])), draw.choice(["9.9.9.9", "9.9.9.9", "1.1.1.1", None]),
             draw.choice(["/", "/login", "/admin", None]))
            for _ in range(40)
        ])
        found = [(s, s + 20, draw.choice(["9.9.9.9", "1.1.1.1", "2.2.2.2"])) for s in range(low - 20, low + 20, 10) if draw.random() < 0.6]
        # Repeated detections count once.
        bots.append([(at(a), at(b), c) for a, b, c in found + found[:1]])
    return requests, bots


@pytest.fixture
def fed(spark, tmp_path):
    def make(name, schema, parts):
        for number, part in enumerate(parts):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / name / f"part={number:04d}"))
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", True).parquet(str(tmp_path / name))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield make
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_live_paths_equal_the_report_and_forget(spark, fed, tmp_path):
    batches = 12
    requests, bots = rows_of(3, batches)
    end = [(at(90_000 + 100 * i), "end", "/end") for i in range(3)]
    ends = [(at(90_000 + 100 * i), at(90_020 + 100 * i), "end") for i in range(3)]
    events = fed("events", EVENT, requests + [[x] for x in end])
    windows = fed("windows", WINDOW, bots + [[x] for x in ends])
    live = live_paths.live_bot_paths(events, windows, "20 seconds", "10 seconds", "30 seconds")
    query = (
        live.writeStream.format("memory").queryName("live_paths").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.exception() is None
    slots = spark.table("live_paths").where("path <> '/end'")
    all_events = spark.createDataFrame(sum(requests, []), EVENT)
    all_bots = spark.createDataFrame(sum(bots, []), WINDOW)
    want = [tuple(r) for r in report.top_bot_paths(all_events, all_bots, "10 seconds", duration="20 seconds").collect()]
    assert len(want) == 3 and [tuple(r) for r in live_paths.top_paths(slots).collect()] == want
    assert slots.groupBy("slot_start", "path").count().where("count > 1").count() == 0
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress]
    early, late = held[3 : batches // 2], held[batches // 2 : batches]
    assert max(late) <= 1.5 * max(early)


def test_tables_edge_rows_and_settings(spark):
    events = spark.createDataFrame(
        [(at(1), "a", "/x"), (at(1), "a", "/x"), (at(11), "a", "/y"), (at(21), "a", "/x"), (None, "a", "/x"), (at(2), None, "/x"),
         (at(3), "a", None), (at(4), "b", "/x")], EVENT,
    )
    windows = spark.createDataFrame([(at(0), at(20), "a"), (at(-10), at(10), "a"), (None, at(20), "a"), (at(0), at(20), None)], WINDOW)
    found = live_paths.live_bot_paths(events, windows, "20 seconds", "10 seconds", slot="10 seconds")
    assert sorted(tuple(r)[1:] for r in found.collect()) == [("/x", 2), ("/y", 1)]
    assert live_paths.top_paths(found, 1).collect()[0].asDict() == {"path": "/x", "request_count": 2}
    assert live_paths.live_bot_paths(events.where(F.lit(False)), windows, "20 seconds", "10 seconds").count() == 0
    for wrong in ({"slot": "15 seconds"}, {"delay": "1 month"}):
        with pytest.raises(ValueError):
            live_paths.live_bot_paths(events, windows, "20 seconds", "10 seconds", **wrong)
