"""Time between requests of one client, on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_SLICE = 10_000  # rows handed back to Spark at a time


def stream_gaps(
    events: DataFrame, watermark: str = "10 minutes", idle_minutes: int = 60
) -> DataFrame:
    """Events with ``gap_seconds`` since the client's previous request.

    Keeps one time per client, and forgets a client after ``idle_minutes`` of
    event time without requests. Requests are put in order within a batch; one
    that arrives in a later batch than its successor gets no gap. A batch holds
    the requests of a client in one task, so bound the batch size (offsets or
    files per trigger) to bound that group.

    To aggregate the gaps further, set
    ``spark.sql.streaming.statefulOperator.checkCorrectness.enabled`` to false:
    Spark cannot know that every row given out here keeps the time it came in
    with, and so is never behind the watermark.
    """
    idle_ms = idle_minutes * 60_000

    def gaps(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = pd.concat([frame["timestamp"] for frame in frames]).sort_values(ignore_index=True)
        micros = times.astype("datetime64[us]").astype("int64")
        before = micros.shift(1)
        last = None
        if state.exists:
            (last,) = state.get
            before.iloc[0] = last
        gap = (micros - before) / 1e6
        newest = int(micros.iloc[-1])
        if last is not None:
            newest = max(newest, last)
        state.update((newest,))
        expiry = newest // 1000 + idle_ms
        state.setTimeoutTimestamp(max(expiry, state.getCurrentWatermarkMs() + 1))
        known = gap.where(gap >= 0)
        for low in range(0, len(times), _SLICE):
            part = slice(low, low + _SLICE)
            yield pd.DataFrame({
                "timestamp": times[part], "client_ip": key[0], "gap_seconds": known[part],
            })

    timed = events.where("timestamp is not null").select("timestamp", "client_ip")
    return (
        timed.withWatermark("timestamp", watermark)
        .groupBy("client_ip")
        .applyInPandasWithState(
            gaps,
            "timestamp timestamp, client_ip string, gap_seconds double",
            "last_micros long",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )
