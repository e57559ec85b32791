"""Sequence rules against brute force, for any slot, with a hot client, ties and missing values."""

import random

import pytest
from pyspark.sql import functions as F

from botlens.operators.sequences import sequence_clients, sequence_matches

STEPS = ["path = '/a'", "path = '/b' and status >= 400", "path = '/a'", "path = '/c'"]


def fits(row, step):
    path, status = row["path"], row["status"]
    return [path == "/a", path == "/b" and status is not None and status >= 400, path == "/a", path == "/c"][step]


def completed(rows, limit):
    done = {r["id"] for r in rows if fits(r, 0)}
    for step in range(1, len(STEPS)):
        done = {
            r["id"] for r in rows if fits(r, step)
            and any(q["id"] in done and q["ip"] == r["ip"] and 0 < r["at"] - q["at"] <= limit for q in rows)
        }
    return done


@pytest.mark.parametrize("limit", [4.25, 20])
def test_sequences_against_brute_force(make_events, limit):
    draw = random.Random(4)
    rows = [
        {"id": i, "at": draw.randrange(0, 2400) / 4, "ip": draw.choice(["9.9.9.9", "9.9.9.9", "1.1.1.1"]),
         "path": draw.choice(["/a", "/b", "/c", "/other", None]), "status": draw.choice([200, 404, 500, None])}
        for i in range(900)
    ]
    want = completed(rows, limit)
    events = make_events(*rows, {"id": 5000, "at": None, "path": "/c"}, {"id": 5001, "at": 5, "ip": None, "path": "/c"})
    assert len(want) > 5
    for factor in (1, 4, 1000):
        found = sequence_matches(events, [F.expr(s) for s in STEPS], limit, factor)
        assert found.columns == events.columns
        assert sorted(r.event_id for r in found.collect()) == sorted(want)


def test_slots_split_a_hot_client_in_one_exchange(make_events, capsys):
    events = make_events(*({"id": i, "at": i, "path": "/abc"[0] + "abc"[i % 3]} for i in range(300)))
    steps = [F.col("path") == p for p in ("/a", "/b", "/c")]
    found = sequence_matches(events, steps, 5)
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(slot") == 1 and plan.count("Exchange") == 1
    assert sorted(r.event_id for r in found.collect()) == list(range(2, 300, 3))
    row = sequence_clients(events, steps, 5).collect()
    assert len(row) == 1 and row[0].sequence_count == 100


def test_edges_of_sequences(make_events):
    events = make_events({"id": 1, "at": 0, "path": "/a"}, {"id": 2, "at": 0, "path": "/b"}, {"id": 3, "at": 10, "path": "/b"},
                         {"id": 3, "at": 10, "path": "/b"}, {"id": 4, "at": 20.25, "path": "/b"})
    a, b = F.col("path") == "/a", F.col("path") == "/b"
    assert sorted(r.event_id for r in sequence_matches(events, [a, b], 10).collect()) == [3, 3]
    assert sorted(r.event_id for r in sequence_matches(events, [b, b], 10.25).collect()) == [3, 3, 4]
    assert [r.event_id for r in sequence_matches(events, [a], 10).collect()] == [1]
    assert sequence_matches(events.where(F.lit(False)), [a, b], 10).count() == 0
    for steps, limit in (([], 1), ([a], 0)):
        with pytest.raises(ValueError):
            sequence_matches(events, steps, limit)
