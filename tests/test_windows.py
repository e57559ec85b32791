import random
from collections import defaultdict
from datetime import timedelta
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from botlens.config import SENSITIVE
from botlens.operators import arrivals, features, report, windows
from botlens.operators.detections import latest_per_client, with_detection_id
from botlens.plans import detectors

from conftest import START


def seconds(moment):
    return moment.timestamp() - START.timestamp()


def rule(events, settings=SENSITIVE):
    found = detectors.rule_detections(events, settings)
    return found.withColumn("start", F.unix_seconds("window_start") - int(START.timestamp()))


def test_event_on_an_edge_is_in_the_window_that_starts_there(make_events):
    starts = {r.start for r in rule(make_events({"at": 30})).collect()}
    assert starts == {10, 20, 30}


def test_no_time_no_window(make_events):
    assert rule(make_events({"at": None}, {"at": 1})).groupBy().sum("request_count").first()[0] == 3


def test_null_client_is_a_group(make_events):
    rows = rule(make_events({"ip": None}, {"ip": None}, {"ip": "1.1.1.1"})).where("start = 0").collect()
    assert {r.client_ip: r.request_count for r in rows} == {None: 2, "1.1.1.1": 1}


def test_single_request_has_no_deviation(make_events):
    row = detectors.model_windows(make_events({"bytes": 7}), SENSITIVE).first()
    assert (row.payload_std_per_ip, row.inter_arrival_std) == (0.0, 0.0)


def test_first_values_come_from_the_first_request(make_events):
    events = make_events(
        {"id": 5, "at": 3, "agent": "curl", "port": 1},
        {"id": 2, "at": 1, "agent": None, "port": 443},
        {"id": 1, "at": 1.5, "agent": "a", "port": 3},
    )
    row = detectors.fallback_detections(events, SENSITIVE).where("requests_per_ip = 3").first()
    assert (row.user_agent, row.Port, row.ua_is_empty, row.is_encrypted) == (None, 443, 1, 1)


def test_scores_stay_in_range_and_counts_add_up(spark, dense):
    found = rule(dense)
    low, high, total = found.agg(
        F.min(F.least("burst_score", "error_score", "ua_score", "bot_score")),
        F.max(F.greatest("burst_score", "error_score", "ua_score", "bot_score")),
        F.sum("request_count"),
    ).first()
    assert low >= 0 and high <= 1 and total == dense.count() * 3


def test_row_order_and_partitions_do_not_matter(dense):
    shuffled = dense.orderBy(F.rand(3)).repartition(7)
    for plan in (detectors.rule_detections, detectors.fallback_detections):
        first, second = plan(dense, SENSITIVE), plan(shuffled, SENSITIVE)
        if "payload_std_per_ip" in first.columns:  # a float sum, equal up to its last digits
            even = F.round("payload_std_per_ip", 6)
            first = first.withColumn("payload_std_per_ip", even)
            second = second.withColumn("payload_std_per_ip", even)
        assert first.exceptAll(second).count() == 0 == second.exceptAll(first).count()


def test_known_totals(dense):
    row = rule(dense).agg(
        F.count("*").alias("n"), F.sum(F.round("bot_score", 6)).alias("s"), F.max("request_count").alias("m"),
        F.sum(F.col("is_bot").cast("int")).alias("b"),
    ).first()
    assert (row.n, round(row.s, 3), row.b, row.m) == (483, 208.451, 181, 16)


def random_requests(number, seed):
    rng = random.Random(seed)
    hot = ["9.9.9.9"] * 3
    return [
        {"id": i, "at": rng.randrange(0, 4000) / 4, "ip": rng.choice([*hot, "1.1.1.1", "2.2.2.2", None, ""])}
        for i in range(number)
    ]


def brute_gaps(requests):
    per_client, gaps = defaultdict(list), {}
    for r in sorted(requests, key=lambda r: (r["at"], r["id"])):
        seen = per_client[r["ip"]]
        gaps[r["id"]] = r["at"] - seen[-1] if seen else None
        seen.append(r["at"])
    return gaps


@pytest.mark.parametrize("slot", [1, 60, 86400])
def test_gaps_do_not_depend_on_the_slot(make_events, slot):
    requests = random_requests(400, 1)
    found = arrivals.request_gaps(make_events(*requests), slot).collect()
    assert {r.event_id: r.gap_seconds for r in found} == brute_gaps(requests)


def test_gaps_without_event_id(make_events):
    requests = random_requests(200, 2)
    found = arrivals.request_gaps(make_events(*requests).drop("event_id")).collect()
    key = lambda g: (g is None, g)
    assert sorted((r.gap_seconds for r in found), key=key) == sorted(brute_gaps(requests).values(), key=key)


def test_arrival_windows_against_brute_force(make_events):
    requests = random_requests(300, 3)
    gaps = brute_gaps(requests)
    groups = defaultdict(list)
    for r in sorted(requests, key=lambda r: (r["at"], r["id"])):
        base = int(r["at"] // 30) * 30
        for start in (base, base - 30):
            groups[start, r["ip"]].append(gaps[r["id"]])
    found = detectors.model_windows(make_events(*requests), SENSITIVE, temporal="exact").collect()
    assert len(found) == len(groups)
    for row in found:
        mine = groups[seconds(row.window.start), row.client_ip]
        known = [g for g in mine if g is not None]
        assert row.requests_per_ip == len(mine)
        assert row.time_since_last_request == (mine[0] or 0.0)
        assert row.inter_arrival_std == pytest.approx(stdev(known) if len(known) > 1 else 0.0)


@pytest.mark.parametrize("duration, slide", [("1 minute", "10 seconds"), ("5 minutes", "10 seconds")])
def test_counting_by_slide_changes_nothing(make_events, monkeypatch, duration, slide):
    rng = random.Random(8)
    requests = [
        {**r, "bytes": rng.choice([None, 5, 70]), "status": rng.choice([200, 404, 503, None])}
        for r in random_requests(300, 9)
    ]
    flagged = features.suspicion_flags(make_events(*requests, {"at": None}), SENSITIVE)
    by_slide = windows.traffic_windows(flagged, duration, slide)
    monkeypatch.setattr(windows, "MANY_WINDOWS", 10**9)
    direct = windows.traffic_windows(flagged, duration, slide)
    assert by_slide.columns == direct.columns and by_slide.dtypes == direct.dtypes
    assert by_slide.exceptAll(direct).count() == 0 == direct.exceptAll(by_slide).count()


def test_windows_per_event():
    assert windows.windows_per_event("1 minute", "10 seconds") == 6
    assert windows.windows_per_event("1 day", "12 hours") == 2
    assert windows.windows_per_event("1 minute", "25 seconds") is None
    assert windows.windows_per_event("1 minute 5 seconds", "5 seconds") is None


def test_agent_diversity(make_events):
    events = make_events({"agent": "a"}, {"agent": "b"}, {"agent": ""}, {"agent": None}, {"agent": "a"})
    exact = windows.agent_diversity(events, "60 seconds", "30 seconds").first()
    rough = windows.agent_diversity(events, "60 seconds", "30 seconds", relative_error=0.05).first()
    assert (exact.request_count, exact.distinct_agents, rough.distinct_agents) == (5, 3, 3)


def test_protocol_error_rate(make_events):
    rows = features.model_row_features(make_events(
        {"protocol": "UDP", "status": 500}, {"protocol": "TCP", "status": 404}, {"protocol": None},
    ))
    found = windows.protocol_error_rate(rows, "60 seconds", "60 seconds").collect()
    assert {r.Protocol: r.protocol_error_rate for r in found} == {1: 1.0, 0: 0.5}


def test_latest_row_wins_and_nulls_are_kept(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, None), ("a", 2, "y"), (None, 1, "z")], "client_ip string, window_end int, v string"
    )
    found = {(r.client_ip, r.window_end, r.v) for r in latest_per_client(rows).collect()}
    assert found == {("a", 3, None), (None, 1, "z")}


def test_detection_ids_are_stable_and_distinct(dense):
    found = with_detection_id(detectors.rule_detections(dense, SENSITIVE))
    again = with_detection_id(detectors.rule_detections(dense.repartition(5), SENSITIVE))
    ids = {r[0] for r in found.select("detection_id").collect()}
    assert len(ids) == found.count() and ids == {r[0] for r in again.select("detection_id").collect()}


def test_timeline_fills_gaps_across_spans(make_events):
    far = 60 * 9000
    events = make_events({"at": 0}, {"at": 59}, {"at": far}, {"at": None})
    filled = report.timeline(events, "timestamp", 60).collect()
    counts = {r.bucket - int(START.timestamp()): r.row_count for r in filled}
    assert len(filled) == len(counts) == 9001
    assert counts[0] == 2 and counts[far] == 1 and sum(counts.values()) == 3
    assert report.timeline(events, "timestamp", 60, zero_fill=False).count() == 2
    assert report.timeline(events.limit(0), "timestamp", 60).count() == 0


def test_top_terms_ties_and_nulls(make_events):
    events = make_events({"path": "/b"}, {"path": "/a"}, {"path": "/c"}, {"path": "/c"}, {"path": None})
    found = [tuple(r) for r in report.top_terms(events, "path", 2).collect()]
    assert found == [("/c", 2), ("/a", 1)]


def test_bot_paths_against_brute_force(make_events):
    rng = random.Random(4)
    requests = [
        {**r, "path": rng.choice(["/a", "/b", "/c", None]), "status": rng.choice([200, 404, 500])}
        for r in random_requests(400, 5)
    ]
    events = make_events(*requests)
    bots = rule(events).where("is_bot")
    spans = [(r.client_ip, r.start, r.start + 30) for r in bots.collect()]
    want = defaultdict(int)
    for r in requests:
        hit = any(ip == r["ip"] and low <= r["at"] < high for ip, low, high in spans if ip is not None)
        if hit and r["path"]:
            want[r["path"]] += 1
    found = {r.path: r.request_count for r in report.top_bot_paths(events, bots, "10 seconds").collect()}
    assert spans and found == dict(want)


@pytest.mark.parametrize("duration, slide", [(30, 20), (45, 10), (30, 30)])
def test_bot_paths_of_any_window_and_slide(make_events, duration, slide):
    rng = random.Random(duration)
    requests = [{"id": i, "at": rng.randrange(0, 300), "ip": rng.choice(["a", "b"]), "path": rng.choice("xyz")} for i in range(200)]
    requests.append({"id": 999, "at": duration - 5, "ip": "a", "path": "tail"})
    events = make_events(*requests)
    spans = [("a", 0, duration), ("b", 2 * slide, 2 * slide + duration), ("a", 3 * slide, 3 * slide + duration)]
    bots = events.sparkSession.createDataFrame(
        [(ip, START + timedelta(seconds=low), START + timedelta(seconds=high)) for ip, low, high in spans],
        "client_ip string, window_start timestamp, window_end timestamp",
    )
    want = defaultdict(int)
    for r in requests:
        if any(ip == r["ip"] and low <= r["at"] < high for ip, low, high in spans):
            want[r["path"]] += 1
    found = report.top_bot_paths(events, bots, f"{slide} seconds", duration=f"{duration} seconds").collect()
    assert {r.path: r.request_count for r in found} == dict(want)


def test_timeline_with_a_range_ignores_wrong_clocks(make_events):
    events = make_events({"at": 5}, {"at": 65}, {"at": -1_704_000_000}, {"at": 9_000_000_000})
    found = report.timeline(events, "timestamp", 30, since="2024-01-01 00:00:00", until="2024-01-01 00:02:00")
    assert [tuple(r) for r in found.orderBy("bucket").collect()] == [
        (1704067200, 1), (1704067230, 0), (1704067260, 1), (1704067290, 0)]
    assert report.timeline(events.where("false"), "timestamp", 30).count() == 0


def test_recent_and_pages(make_events):
    events = make_events(*[{"id": i, "at": i * 86400} for i in range(12)])
    assert report.recent(events, "timestamp").count() == 8
    page = report.page(events, 2, 5, by=("event_id",)).collect()
    assert [r.event_id for r in page] == [5, 6, 7, 8, 9]
