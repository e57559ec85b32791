import gzip
import json
import time
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from botlens import values
from botlens.config import SENSITIVE, Stream
from botlens.sources import access_log, topic

FULL = (
    '10.0.0.9 - bob [10/Oct/2024:13:55:36 +0200] "GET /a HTTP/1.1" 200 512 "-" "curl/7" '
    "protocol=UDP port=443 request_type=HTTPS"
)


def normalized(spark, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    return access_log.normalize_access_log(access_log.parse_access_log(frame)).collect()


def test_full_line(spark):
    (row,) = normalized(spark, FULL)
    assert row.asDict() == {
        "timestamp": "2024-10-10T11:55:36.000Z", "client_ip": "10.0.0.9", "method": "GET",
        "path": "/a", "status": 200, "bytes_sent": 512, "user_agent": "curl/7", "referer": "-",
        "log_type": "nginx_access", "protocol": "UDP", "port": 443, "request_type": "HTTPS",
    }


def test_optional_tails(spark):
    head = '1.1.1.1 - - [10/Oct/2024:13:55:36 +0000] "GET / HTTP/1.1" 200 5'
    bare, agent, empty = normalized(
        spark, head, head + ' "-" "x"', head + ' "" "" protocol=TCP port=8080 request_type=HTTP'
    )
    assert (bare.user_agent, bare.referer) == (None, None)
    assert (bare.protocol, bare.port, bare.request_type) == ("TCP", 80, "HTTP")
    assert agent.user_agent == "x"
    assert (empty.user_agent, empty.referer, empty.port) == ("", "", 8080)


def test_odd_requests_and_sizes(spark):
    line = '1.1.1.1 - - [10/Oct/2024:13:55:36 +0000] "{}" {} {} "-" "x"'
    spaced, dash, size = normalized(
        spark,
        line.format("GET /a b HTTP/1.1", 200, 1),
        line.format("-", 400, "-"),
        line.format("GET /", "abc", "12x"),
    )
    assert spaced.path == "/a b"
    assert (dash.method, dash.path, dash.bytes_sent) == ("-", "", 0)
    assert (size.status, size.bytes_sent) == (0, 12)


@pytest.mark.parametrize("filler", [" ", '"', "[", "a ", "\t ", "a"])
def test_hostile_lines_take_linear_time(spark, filler):
    head = '1.1.1.1 - - [10/Oct/2024:13:55:36 +0000] "GET '
    lines = [(head + filler * 100_000,), (head + filler * 100_000 + ' HTTP/1.1" 200 5',), (head + "/" + filler * 50_000 + '" 200 5',)]
    frame = spark.createDataFrame(lines, "value string").cache()
    frame.count()
    started = time.perf_counter()
    parsed = access_log.parse_access_log(frame).count()
    aside = access_log.quarantined_lines(frame).count()
    assert parsed + aside == 3
    assert time.perf_counter() - started < 6


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["GET", " ", "  ", "/a", "\t", "HTTP/1.1", "-", "b"]), max_size=7).map("".join), min_size=30, max_size=30))
def test_linear_pattern_finds_what_the_plain_one_finds(spark, requests):
    lines = [(f'1.1.1.1 - - [t] "{r}" 200 5 "-" "x"',) for r in requests]
    frame = spark.createDataFrame(lines, "value string")
    groups = lambda pattern: [F.regexp_extract("value", pattern, i) for i in range(1, 15)]
    same = F.array(*groups(values.ACCESS_LOG_PATTERN)) == F.array(*groups(values.ACCESS_LOG_PATTERN_LINEAR))
    assert frame.where(~same).collect() == []


def test_bad_lines_are_kept_aside(spark):
    bad = ["", "garbage", FULL[:30], FULL + "\n" + FULL, None]
    frame = spark.createDataFrame([(line,) for line in [*bad, FULL]], "value string")
    assert access_log.parse_access_log(frame).count() == 1
    aside = {r.value for r in access_log.quarantined_lines(frame).collect()}
    assert aside == set(bad)


def test_bad_time_is_null(spark):
    (row,) = normalized(spark, FULL.replace("10/Oct/2024:13:55:36 +0200", "soon"))
    assert row.timestamp is None


def test_time_text_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        (row,) = normalized(spark, FULL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.timestamp == "2024-10-10T11:55:36.000Z"


def test_messages_round_trip(spark):
    frame = spark.createDataFrame([(FULL,)], "value string")
    events = access_log.normalize_access_log(access_log.parse_access_log(frame))
    messages = topic.encode_json_events(events)
    body = json.loads(messages.first().value)
    assert list(body)[:2] == ["timestamp", "client_ip"] and body["port"] == 443
    back = topic.decode_json_events(messages)
    assert back.drop("timestamp").collect() == events.drop("timestamp").collect()
    direct = access_log.events_from_lines(frame)
    assert back.collect() == direct.collect()


def test_damaged_messages(spark):
    texts = ["{oops", '{"status":"x","client_ip":"1.1.1.1"}', '{"timestamp":"bad","extra":1}', None]
    rows = topic.decode_json_events(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert set(rows[0]) == set(rows[2]) == set(rows[3]) == {None}
    assert (rows[1].status, rows[1].client_ip) == (None, "1.1.1.1")


def test_binary_messages_are_decoded(spark):
    frame = spark.createDataFrame([('{"port": 81}',)], "value string")
    binary = frame.select(F.col("value").cast("binary").alias("value"))
    assert topic.decode_json_events(binary).first().port == 81


def test_log_folder_stream_reads_rotated_files(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "access.log").write_text(FULL + "\n")
    with gzip.open(logs / "access.log.1.gz", "wt") as old:
        old.write(FULL + "\n" + "garbage\n")
    events = access_log.events_from_lines(access_log.stream_lines(spark, str(logs), 1))
    query = (
        events.writeStream.format("memory").queryName("folder_events")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("folder_events").count() == 2
    assert len([p for p in query.recentProgress if p.numInputRows]) == 2  # one file per batch


def test_topic_options():
    limited = replace(SENSITIVE, streaming=Stream(max_offsets_per_trigger=500))
    options = topic.topic_options(limited)
    assert options["maxOffsetsPerTrigger"] == "500"
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in topic.topic_options(SENSITIVE)
