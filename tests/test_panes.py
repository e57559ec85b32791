"""Windows from panes are the windows of the requests themselves."""

import math
import re

import pytest
from pyspark.sql import functions as F

from botlens.operators import arrivals, features, panes, windows


@pytest.fixture
def requests(make_events):
    rows = [{"id": i, "at": (i * 37) % 400 / 2, "ip": f"1.1.1.{i % 3}", "bytes": i * 1000 % 777} for i in range(240)]
    rows += [{"id": 300 + i, "at": 50, "ip": "1.1.1.0", "bytes": 10**12 + i} for i in range(3)]  # ties, large sizes
    rows += [{"id": 400, "at": 60, "ip": None}, {"id": 401, "at": 90, "ip": None}, {"id": 402, "at": None}]
    rows += [{"id": 403, "at": 70, "bytes": None, "ip": "2.2.2.2"}, {"id": 404, "at": 5000, "ip": "1.1.1.1"}]
    return make_events(*rows)


def comparable(frame):
    def plain(value):
        return float(f"{value:.9g}") if isinstance(value, float) and not math.isnan(value) else value

    return sorted((tuple(plain(v) for v in row) for row in frame.collect()), key=str)


@pytest.mark.parametrize("duration, slide", [("60 seconds", "30 seconds"), ("1 minute", "5 seconds"), ("30 seconds", "30 seconds")])
def test_panes_equal_direct_windows(requests, duration, slide):
    rows = features.model_row_features(requests)
    direct = arrivals.with_arrival_times(windows.client_windows(rows, duration, slide), requests, duration, slide)
    made = panes.feature_windows(rows, duration, slide, gaps=True)
    assert comparable(made.select(direct.columns)) == comparable(direct)
    plain = panes.feature_windows(rows, duration, slide)
    assert comparable(plain) == comparable(windows.client_windows(rows, duration, slide).select(plain.columns))


def test_uneven_slides_go_directly(requests):
    rows = features.model_row_features(requests)
    made = panes.feature_windows(rows, "50 seconds", "20 seconds", gaps=True)
    direct = arrivals.with_arrival_times(windows.client_windows(rows, "50 seconds", "20 seconds"), requests, "50 seconds", "20 seconds")
    assert comparable(made) == comparable(direct)


def test_moments_do_not_cancel(spark):
    values = [1e9 + x for x in (0, 1, 2, 3, 4, 5)]
    rows = spark.createDataFrame([(i // 2, v) for i, v in enumerate(values)], "k int, v double")
    parts = rows.groupBy("k").agg(panes._moments("v").alias("m")).agg(F.collect_list("m").alias("ms"))
    assert abs(parts.select(panes._deviation(panes._all_merged(F.col("ms")))).first()[0] - math.sqrt(3.5)) < 1e-9


def test_requests_are_not_copied_per_window(dense):
    """One scan; what is copied per window stands above the aggregation into panes."""
    made = panes.feature_windows(features.model_row_features(dense), "60 seconds", "10 seconds", gaps=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan", plan)) == 1 and len(re.findall(r"Exchange ", plan)) == 3
    copied = min(plan.find(name) % (1 << 30) for name in ("Expand", "Generate"))
    assert copied < plan.find("SortAggregate") or copied < plan.find("HashAggregate(keys=[pane")


def test_agent_sketches_merge_within_their_error(spark):
    """A client with 200,000 agents over ten slides, each slide sharing half of them with the next."""
    rows = spark.range(400_000).select(
        F.expr("timestamp_millis(1704067200000 + id % 10 * 1000)").alias("timestamp"), F.lit("1.1.1.1").alias("client_ip"),
        F.expr("concat('agent ', id % 10 * 20000 + (id div 10) % 40000)").alias("user_agent"),
    )
    held = panes.agent_panes(rows, "1 second")
    assert held.count() == 10
    found = panes.diversity_windows(held, "10 seconds", "10 seconds").first()
    assert found.request_count == 400_000 and abs(found.distinct_agents - 220_000) < 4 * panes.SKETCH_ERROR * 220_000
    assert found.standard_error < 0.02 * 220_000
    plan = panes.diversity_windows(held, "10 seconds", "1 second")._jdf.queryExecution().executedPlan().toString()
    assert plan.find("Expand") < plan.find("hll_sketch_agg") or "Expand" not in plan[plan.find("hll_sketch_agg"):]


def test_agent_sketches_on_a_stream(spark, tmp_path, make_events):
    for part, rows in enumerate(([{"at": 0, "agent": "a"}, {"at": 35, "agent": ""}], [{"at": 1, "agent": "b"}, {"at": 36, "agent": None}])):
        make_events(*rows).coalesce(1).write.parquet(str(tmp_path / "feed" / f"part={part}"))
    schema = make_events({"at": 0}).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    kept = []

    def keep(batch, number):
        batch.write.parquet(str(tmp_path / "panes" / f"batch={number}"))
        kept.append(number)

    query = (
        panes.agent_panes(reader.parquet(str(tmp_path / "feed")), "30 seconds").writeStream.foreachBatch(keep)
        .outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.exception() is None and len(kept) >= 2
    stored = spark.read.parquet(str(tmp_path / "panes"))
    newest = stored.groupBy("pane", "client_ip").agg(F.max_by(F.struct("request_count", "agents"), "batch").alias("s")).select("pane", "client_ip", "s.*")
    found = panes.diversity_windows(newest, "60 seconds", "30 seconds").orderBy("window").collect()
    assert [(r.request_count, r.distinct_agents) for r in found] == [(2, 2), (4, 3), (2, 1)]
