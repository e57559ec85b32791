import random
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from botlens.config import SENSITIVE, Checkpoint
from botlens.operators import windows
from botlens.operators.detections import latest_per_client
from botlens.plans import detectors
from botlens.sources import tables
from botlens.streaming import arrivals as stream_arrivals
from botlens.streaming import jobs, sinks


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of Parquet files read as a stream, one file per batch, oldest first."""
    folder = tmp_path / "feed"
    sent = []

    def send(events):
        target = folder / f"part={len(sent):04d}"
        events.coalesce(1).write.parquet(str(target))
        sent.append(events)

    def stream():
        schema = sent[0].schema
        return (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(str(folder))
        )

    send.stream = stream
    return send


@pytest.fixture
def settings(tmp_path):
    return replace(SENSITIVE, checkpoint=Checkpoint(str(tmp_path / "checkpoint")))


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def key_rows(frame, *names):
    return sorted(tuple(r) for r in frame.select(*names).collect())


RULE = ("window_start", "client_ip", "request_count", "bot_score", "is_bot", "detection_reasons")
MODEL = ("window_start", "client_ip", "requests_per_ip", "bot_probability", "is_bot", "user_agent")
LATER = 3600


def test_update_mode_stream_equals_batch(spark, feed, settings, tmp_path, dense):
    for low in (0, 400, 800):
        feed(dense.where(F.col("event_id").between(low, low + 399)))
    store = sinks.DetectionStore(str(tmp_path / "store"), "rule")
    query = run(store.start(jobs.rule_stream(feed.stream(), settings), settings, "update", once=True))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    batch = detectors.rule_detections(dense, SENSITIVE)
    assert key_rows(store.windows(spark), *RULE) == key_rows(batch, *RULE)
    assert store.read(spark).count() > batch.count()  # changed windows were written again
    newest = latest_per_client(batch)
    assert key_rows(store.latest(spark), *RULE) == key_rows(newest, *RULE)
    store.compact(spark)
    assert key_rows(store.read(spark), *RULE) == key_rows(batch, *RULE)


def test_append_mode_stream_equals_batch(spark, feed, settings, tmp_path, dense, make_events):
    feed(dense)
    sentinel = make_events({"at": LATER, "ip": "end"}, {"at": LATER + 900, "ip": "end"})
    feed(sentinel.withColumns({"referer": F.lit("-"), "log_type": F.lit("x")}).select(dense.columns))
    store = sinks.DetectionStore(str(tmp_path / "store"), "model")
    run(store.start(jobs.model_stream(feed.stream(), settings, spark), settings, once=True))
    emitted = store.read(spark).where("client_ip <> 'end'")
    batch = detectors.fallback_detections(dense, SENSITIVE)
    assert key_rows(emitted, *MODEL) == key_rows(batch, *MODEL)


def test_open_windows_wait_for_the_watermark(spark, feed, settings, make_events, tmp_path):
    feed(make_events({"at": 0}))
    store = sinks.DetectionStore(str(tmp_path / "store"), "model")
    run(store.start(jobs.model_stream(feed.stream(), settings, spark), settings, once=True))
    # Nothing is complete: the batches are empty and no row folder is written.
    assert not list((tmp_path / "store").glob("detection_date=*"))


def test_late_rows_are_dropped_by_streams_only(spark, feed, settings, make_events, tmp_path):
    on_time, late = make_events({"at": 0}, {"at": 2000}), make_events({"id": 9, "at": 0})
    feed(on_time)
    feed(make_events({"id": 5, "at": 2001}))
    feed(late)
    store = sinks.DetectionStore(str(tmp_path / "store"), "rule")
    run(store.start(jobs.rule_stream(feed.stream(), settings), settings, "update", once=True))
    at_start = "window_start = timestamp'2024-01-01 00:00:00'"
    assert store.windows(spark).where(at_start).first().request_count == 1
    whole = detectors.rule_detections(on_time.union(late), SENSITIVE)
    assert whole.where(at_start).first().request_count == 2


def test_restart_goes_on_and_replay_changes_nothing(spark, feed, settings, tmp_path, make_events):
    store = sinks.DetectionStore(str(tmp_path / "store"), "rule")

    def go():
        run(store.start(jobs.rule_stream(feed.stream(), settings), settings, "update", once=True))

    feed(make_events({"at": 1}, {"at": 2}))
    go()
    feed(make_events({"id": 7, "at": 3}))
    go()
    before = key_rows(store.windows(spark), *RULE)
    assert max(r[2] for r in before) == 3  # counts continue from the checkpoint
    name = store.read(spark).first()["run"]
    last = store.read(spark).where("batch_id = 1").drop(tables.DAY, "run", "batch_id", "commit")
    rows, held = store.read(spark).count(), spark.createDataFrame(last.collect(), last.schema)
    replayed = sinks.DetectionStore(store.path, name)
    replayed.write_batch(held, 1)
    assert store.read(spark).count() == rows
    assert key_rows(store.windows(spark), *RULE) == before
    store.compact(spark)
    replayed.write_batch(held, 1)  # a replay of what a compaction covers is not read
    assert key_rows(store.read(spark), *RULE) == before


def stored(spark, at, count):
    day = f"2024-01-01 00:00:{at:02d}"
    return spark.sql(
        f"select timestamp'{day}' as window_start, timestamp'{day}' + interval 30 seconds as window_end,"
        f" '1.1.1.1' as client_ip, {count}L as request_count"
    )


def test_a_newer_run_wins_whatever_its_batch_number(spark, tmp_path):
    old, new = (sinks.DetectionStore(str(tmp_path / "s"), run) for run in ("old", "new"))
    old.write_batch(stored(spark, 0, 1), 9)
    new.write_batch(stored(spark, 0, 99), 0)
    assert [r.request_count for r in new.windows(spark).collect()] == [99]
    assert new.latest(spark).first().request_count == 99
    for _ in range(3):  # versions and covered batches are cleaned up along the way
        new.compact(spark)
        new.write_batch(stored(spark, 30, 5), 1)
        assert [r.request_count for r in new.windows(spark).orderBy("window_start").collect()] == [99, 5]
    assert not list((tmp_path / "s").glob("*/run=old/*"))


def test_a_lost_checkpoint_keeps_earlier_rows(spark, feed, settings, tmp_path, make_events):
    store = sinks.DetectionStore(str(tmp_path / "store"), "rule")
    feed(make_events({"at": 1, "ip": "1.1.1.1"}))
    run(store.start(jobs.rule_stream(feed.stream(), settings), settings, "update", once=True))
    other = settings.override({"checkpoint": {"location": str(tmp_path / "another")}})
    feed(make_events({"at": 1, "ip": "2.2.2.2"}))
    run(store.start(jobs.rule_stream(feed.stream(), other), other, "update", once=True))
    assert {r.client_ip for r in store.latest(spark).collect()} == {"1.1.1.1", "2.2.2.2"}
    assert store.read(spark).select("run").distinct().count() == 2


def test_a_store_needs_a_checkpoint_and_compacts_on_the_way(spark, feed, settings, tmp_path, make_events):
    feed(make_events({"at": 1}))
    rows = jobs.rule_stream(feed.stream(), settings)
    with pytest.raises(ValueError, match="checkpoint"):
        sinks.DetectionStore(str(tmp_path / "s")).start(rows, SENSITIVE)
    store = sinks.DetectionStore(str(tmp_path / "s"), compact_every=1)
    run(store.start(rows, settings, "update", once=True))
    assert list((tmp_path / "s" / "_compacted").glob("*/_DONE")) and store.read(spark).count() == 3


def test_model_runs_on_streams(spark, feed, settings, dense, make_events, tmp_path):
    from botlens.operators import learning

    rows = detectors.training_rows(detectors.fallback_detections(dense, SENSITIVE))
    path = str(tmp_path / "model")
    learning.train_forest(rows, trees=3, depth=3).save(path)
    settings = settings.override({"ml": {"model_path": path}})
    feed(dense)
    feed(make_events({"at": LATER}).withColumns(
        {"referer": F.lit("-"), "log_type": F.lit("x")}).select(dense.columns))
    store = sinks.DetectionStore(str(tmp_path / "store"), "model")
    run(store.start(jobs.model_stream(feed.stream(), settings, spark), settings, once=True))
    emitted = store.read(spark)
    batch = detectors.model_detections(dense, SENSITIVE, detectors.load_model(spark, path))
    assert key_rows(emitted, *MODEL) == key_rows(batch, *MODEL)
    assert emitted.first().prediction_method == "ml_model"


def test_console_sink_runs(feed, settings, make_events):
    feed(make_events({"at": 0}))
    run(sinks.start_console(jobs.rule_stream(feed.stream(), settings), settings, "shown", once=True))


def test_external_sink_takes_any_connector(spark, feed, settings, make_events):
    feed(make_events({"at": 0}))
    rows = jobs.rule_stream(feed.stream(), settings)
    run(sinks.start_external(rows, settings, "kept", "memory", {}, once=True))
    assert spark.table("kept").count() == 3


def test_stream_gaps_equal_batch_gaps(spark, feed, make_events):
    from botlens.operators.arrivals import request_gaps

    rng = random.Random(6)
    moments = sorted(rng.randrange(0, 4000) / 4 for _ in range(300))
    events = [
        make_events(*[
            {"id": i, "at": moments[i], "ip": rng.choice(["9.9.9.9", "9.9.9.9", "1.1.1.1"])}
            for i in range(low, low + 100)
        ])
        for low in (0, 100, 200)
    ]
    for part in events:
        feed(part.orderBy(F.rand(1)))
    query = (
        stream_arrivals.stream_gaps(feed.stream()).writeStream.format("memory")
        .queryName("gaps").outputMode("append").trigger(availableNow=True).start()
    )
    run(query)
    whole = events[0].union(events[1]).union(events[2])
    columns = ("timestamp", "client_ip", "gap_seconds")
    key = lambda rows: sorted(((r[0], r[1], r[2] is None, r[2]) for r in rows))
    assert key(spark.table("gaps").select(*columns).collect()) == key(
        request_gaps(whole).select(*columns).collect())


def test_approximate_diversity_on_streams(spark, feed, make_events):
    feed(make_events({"agent": "a"}, {"agent": "b"}))
    counted = windows.agent_diversity(feed.stream(), "60 seconds", "60 seconds", relative_error=0.05)
    query = (
        counted.writeStream.format("memory").queryName("diverse").outputMode("update")
        .trigger(availableNow=True).start()
    )
    run(query)
    assert spark.table("diverse").first().distinct_agents == 2


def test_export(spark, tmp_path, dense):
    rows = detectors.rule_detections(dense, SENSITIVE).select("window_start", "client_ip", "bot_score")
    for kind, read in (("csv", spark.read.option("header", True).csv), ("json", spark.read.json)):
        path = str(tmp_path / kind)
        tables.export_rows(rows, path, kind)
        assert read(path).count() == rows.count()
    with pytest.raises(ValueError):
        tables.export_rows(rows, str(tmp_path / "x"), "xlsx")


def test_written_table_prunes_days(spark, tmp_path, dense):
    found = detectors.rule_detections(dense, SENSITIVE)
    tables.write_detections(found, str(tmp_path / "t"))
    stored = tables.read_detections(spark, str(tmp_path / "t"))
    assert stored.count() == found.count()
    plan = stored.where("detection_date = date'2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(detection_date" in plan


def test_job_from_the_command_line(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    line = '1.2.3.4 - - [10/Oct/2024:13:55:36 +0000] "GET / HTTP/1.1" 404 5 "-" "curl/8"\n'
    (logs / "access.log").write_text(line * 12)
    config = tmp_path / "s.json"
    config.write_text('{"checkpoint": {"location": "%s"}}' % (tmp_path / "cp"))
    store = str(tmp_path / "store")
    jobs.main(["rule", "--logs", str(logs), "--config", str(config), "--store", store, "--once"])
    row = sinks.DetectionStore(store).latest(spark).first()
    assert (row.client_ip, row.request_count, row.is_bot) == ("1.2.3.4", 12, True)


def test_a_job_counts_and_keeps_what_it_cannot_use(spark, tmp_path, caplog):
    logs = tmp_path / "logs"
    logs.mkdir()
    good = '1.2.3.4 - - [{}] "GET / HTTP/1.1" 404 5 "-" "curl/8"\n'
    (logs / "access.log").write_text(good.format("10/Oct/2024:13:55:36 +0000") + good.format("no time") + "garbage\n")
    config = tmp_path / "s.json"
    config.write_text('{"checkpoint": {"location": "%s"}, "streaming": {"max_files_per_trigger": 1}}' % (tmp_path / "cp"))
    aside = str(tmp_path / "aside")
    jobs.main(["rule", "--logs", str(logs), "--config", str(config), "--store", str(tmp_path / "store"), "--quarantine", aside, "--once"])
    assert [r.value for r in spark.read.text(aside).collect()] == ["garbage"]
    assert jobs.losses({"received": {"n": 3}, "decoded": {"n": 2, "without_time": 1}}) == {"unparsed": 1, "without_time": 1}
    assert jobs.losses({}) == {}


def test_a_query_stops_between_batches(spark, feed, settings, make_events, tmp_path):
    feed(make_events({"at": 0}))
    store = sinks.DetectionStore(str(tmp_path / "store"), "stopped")
    query = store.start(jobs.rule_stream(feed.stream(), settings), settings, "update")
    query.processAllAvailable()
    stopping = threading.Event()
    stopping.set()
    jobs.await_end(query, stopping)
    assert not query.isActive and query.exception() is None
    assert store.read(spark).count() == 3


def test_arrival_windows_on_streams(spark, feed, make_events, request):
    from botlens.operators.arrivals import arrival_windows, request_gaps

    rng = random.Random(7)
    moments = sorted(rng.randrange(0, 1200) / 4 for _ in range(120))
    clients = [rng.choice(["9.9.9.9", "1.1.1.1"]) for _ in moments]
    rows = [{"id": i, "at": at, "ip": ip} for i, (at, ip) in enumerate(zip(moments, clients, strict=True))]
    for low in (0, 60):
        feed(make_events(*rows[low:low + 60]))
    feed(make_events({"at": LATER, "ip": "end"}))
    check = "spark.sql.streaming.statefulOperator.checkCorrectness.enabled"
    spark.conf.set(check, "false")
    request.addfinalizer(lambda: spark.conf.unset(check))
    gaps = stream_arrivals.stream_gaps(feed.stream())
    grouped = windows.flatten_window(arrival_windows(gaps, "60 seconds", "30 seconds"))
    query = (
        grouped.writeStream.format("memory").queryName("arrivals").outputMode("append")
        .trigger(availableNow=True).start()
    )
    run(query)
    batch = windows.flatten_window(
        arrival_windows(request_gaps(make_events(*rows)), "60 seconds", "30 seconds"))
    columns = ("window_start", "client_ip", "time_since_last_request", "inter_arrival_std")
    found, want = (
        key_rows(f.withColumn("inter_arrival_std", F.round("inter_arrival_std", 6)), *columns)
        for f in (spark.table("arrivals").where("client_ip <> 'end'"), batch)
    )
    assert found == want


def test_alerts_as_a_stream(spark, feed, settings, tmp_path, dense, make_events):
    from botlens.operators.searches import alerts

    feed(dense)
    feed(make_events({"at": LATER, "ip": "end"}).withColumns(
        {"referer": F.lit("-"), "log_type": F.lit("x")}).select(dense.columns))
    store = sinks.DetectionStore(str(tmp_path / "store"), "alerts")
    rows = alerts(jobs.model_stream(feed.stream(), settings, spark))
    run(store.start(rows, settings, once=True))
    batch = alerts(detectors.fallback_detections(dense, SENSITIVE))
    assert batch.count() > 0
    assert key_rows(store.read(spark), *MODEL) == key_rows(batch, *MODEL)


def test_trigger_interval(spark, feed, settings, make_events, tmp_path):
    feed(make_events({"at": 0}))
    timed = settings.override({"streaming": {"trigger_interval": "1 second"}})
    store = sinks.DetectionStore(str(tmp_path / "store"), "timed")
    query = store.start(jobs.rule_stream(feed.stream(), timed), timed, "update")
    try:
        query.processAllAvailable()
        assert query.isActive and query.exception() is None
    finally:
        query.stop()
    assert not query.isActive and store.read(spark).count() == 3
