"""Model windows with arrival times on streams, equal to those of a table.

Two stateful steps, both inside Spark's rules for event time:

1. The requests of a client and slide become one pane, a built-in aggregation in append mode. It keeps the
   request times of an open pane, so a client that sends half of all requests is spread over its panes and no state holds
   more than one slide's requests of one client.
2. Panes meet per client in a state processor. It keeps the time of the client's last request, the panes of open windows
   as a map by start, and a timer for the end of each open window. A window is given out once, when the watermark
   has passed its end.

The gap before a client's first request in a pane is found however long ago the last one was: the one time per
client stays in the state, for which :func:`exact_windows` can be given ``forget_after``.

Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``); :func:`use_rocksdb` sets it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructField, StructType

from botlens.operators.panes import client_panes
from botlens.operators.windows import FIRST_VALUES, whole_seconds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_COUNTS = ("requests", "failures", "judged")
_MOMENTS = ("payload_n", "payload_mean", "payload_m2", "gap_n", "gap_mean", "gap_m2")
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state in RocksDB, unless the session names a store of its own."""
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, ROCKSDB)


def _inner_gaps(times: Column) -> Column:
    """Moments of the seconds between the sorted times (microseconds) of a pane."""
    later = F.slice(times, F.lit(2), F.greatest(F.size(times) - 1, F.lit(0)))
    gaps = F.transform(later, lambda t, i: (t - F.get(times, i)) / F.lit(1e6))
    number = F.size(gaps).cast("double")
    total = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g)
    mean = F.when(number > 0, total / number).otherwise(F.lit(0.0))
    apart = F.aggregate(F.transform(gaps, lambda g: (g - mean) * (g - mean)), F.lit(0.0), lambda s, g: s + g)
    return F.struct(number.alias("n"), mean.alias("mean"), apart.alias("m2"))


def stream_panes(features: DataFrame, slide: str, watermark: str) -> DataFrame:
    """Finished panes of a stream: plain columns, with ``pane_time`` as their event time."""
    timed = features.withWatermark("timestamp", watermark)
    panes = client_panes(timed, slide, more=[F.array_sort(F.collect_list(F.unix_micros("timestamp"))).alias("times")])
    return panes.withColumn("gap", _inner_gaps(F.col("times"))).select(
        "client_ip", F.window_time("pane").alias("pane_time"), F.unix_seconds("pane.start").alias("pane"),
        *_COUNTS, *[F.col(f"payload.{m}").alias(f"payload_{m}") for m in ("n", "mean", "m2")],
        *[F.col(f"gap.{m}").alias(f"gap_{m}") for m in ("n", "mean", "m2")],
        F.element_at("times", 1).alias("first_micros"), F.element_at("times", -1).alias("last_micros"),
        *[F.col(f"first.{name}").alias(name) for name in FIRST_VALUES],
    )


def _merged(one: tuple, other: tuple) -> tuple:
    """Moments (n, mean, m2) of both groups together."""
    number = one[0] + other[0]
    if not number:
        return one
    apart, share = other[1] - one[1], other[0] / number
    return number, one[1] + apart * share, one[2] + other[2] + apart * apart * one[0] * share


def _deviation(moments: tuple) -> float | None:
    return (moments[2] / (moments[0] - 1)) ** 0.5 if moments[0] > 1 else None


class _Windows(StatefulProcessor):
    """Panes of a client to its finished windows."""

    def __init__(self, length: int, slide: int, forget: int | None, columns: list[str], pane: StructType, names: list[str]):
        self.length, self.slide, self.forget = length, slide, forget
        self.columns, self.pane, self.names = columns, pane, names

    def init(self, handle) -> None:
        self.handle = handle
        # Last request's time, and the end up to which windows were given out (seconds).
        self.last = handle.getValueState("last", "micros bigint, done bigint")
        self.panes = handle.getMapState("panes", "start bigint", self.pane)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows)).sort_values("pane")
        micros, done = self.last.get() if self.last.exists() else (None, None)
        ends = set(self.handle.listTimers())
        for row in fresh.itertuples(index=False):
            values = {c: _plain(getattr(row, c)) for c in self.columns}
            since = None if micros is None else (values["first_micros"] - micros) / 1e6
            if since is not None:
                own = tuple(values[f"gap_{m}"] for m in ("n", "mean", "m2"))
                values.update(zip(("gap_n", "gap_mean", "gap_m2"), _merged(own, (1.0, since, 0.0))))
            micros = values["last_micros"]
            start = int(row.pane)
            self.panes.updateValue((start,), (since, *[values[c] for c in self.columns]))
            for end in range(start + self.slide, start + self.length + 1, self.slide):
                if end * 1000 not in ends:
                    self.handle.registerTimer(end * 1000)
                    ends.add(end * 1000)
        self.last.update((micros, done))
        if self.forget:
            self.handle.registerTimer(micros // 1000 + self.forget * 1000)
        yield from self._finished(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._finished(key, timerValues.getCurrentWatermarkInMs())
        if self.forget and self.last.exists():
            micros, _ = self.last.get()
            if expiredTimerInfo.getExpiryTimeInMs() >= micros // 1000 + self.forget * 1000:
                self.last.clear()
                self.panes.clear()

    def _finished(self, key, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Windows that end at or before the watermark and were not given out yet."""
        if not self.last.exists():
            return
        micros, done = self.last.get()
        limit = watermark_ms // 1000 // self.slide * self.slide
        if done is not None and limit <= done:
            return
        held = {k[0]: v for k, v in self.panes.iterator()}
        starts = sorted(held)
        ends = {e for s in starts for e in range(s + self.slide, s + self.length + 1, self.slide)}
        out = []
        for end in sorted(e for e in ends if e <= limit and (done is None or e > done)):
            inside = [dict(zip(("since_last", *self.columns), held[s])) for s in starts if end - self.length <= s < end]
            out.append(self._window(key[0], end, inside))
        for start in starts:
            if start + self.length <= limit:
                self.panes.removeKey((start,))
        self.last.update((micros, limit))
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def _window(self, client, end: int, panes: list[dict]) -> tuple:
        payload = gaps = (0.0, 0.0, 0.0)
        for pane in panes:
            payload = _merged(payload, tuple(pane[f"payload_{m}"] for m in ("n", "mean", "m2")))
            gaps = _merged(gaps, tuple(pane[f"gap_{m}"] for m in ("n", "mean", "m2")))
        judged = sum(p["judged"] for p in panes)
        rate = sum(p["failures"] or 0 for p in panes) / judged if judged else None
        first = panes[0]
        moment = _EPOCH + timedelta(seconds=end)
        return (
            moment - timedelta(seconds=self.length), moment, client, sum(p["requests"] for p in panes), rate,
            payload[1] if payload[0] else None, _deviation(payload), rate, *[first[n] for n in self.names[8:-2]],
            first["since_last"] or 0.0, _deviation(gaps) or 0.0,
        )

    def close(self) -> None:
        pass


def _plain(value):
    """A Python value of a pandas one; NaN stands for NULL in number columns."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value.item() if hasattr(value, "item") else value


def exact_windows(
    features: DataFrame, duration: str, slide: str, watermark: str = "10 minutes", forget_after: str | None = None
) -> DataFrame:
    """The 16 model features per window and client of a stream, arrival times included, for append mode.

    The slide must divide the duration. With ``forget_after``, a client that is silent for longer has no gap before its
    next request.
    """
    length, step = whole_seconds(duration), whole_seconds(slide)
    if not length or not step or length % step:
        raise ValueError("exact arrival times on streams need a slide that divides the window")
    forget = None
    if forget_after is not None:
        forget = whole_seconds(forget_after)
        if not forget or forget < length:
            raise ValueError("forget_after must be a duration, and no shorter than the window")
    use_rocksdb(features.sparkSession)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    panes = stream_panes(features, slide, watermark)
    columns = [c for c in panes.columns if c not in ("client_ip", "pane_time", "pane")]
    # Whole numbers as they are, whatever pandas makes of NULLs.
    state = StructType([StructField("since_last", panes.schema["gap_mean"].dataType), *(panes.schema[c] for c in columns)])
    state = StructType([StructField(f.name, f.dataType, True) for f in state])
    kinds = {f.name: f.dataType.simpleString() for f in panes.schema}
    out = (
        "window_start timestamp, window_end timestamp, client_ip string, requests_per_ip bigint, failure_rate_per_ip double, "
        "avg_payload_per_ip double, payload_std_per_ip double, protocol_error_rate double, "
        + ", ".join(f"{n} {kinds[n]}" for n in FIRST_VALUES) + ", time_since_last_request double, inter_arrival_std double"
    )
    names = [part.split()[0] for part in out.split(", ")]
    processor = _Windows(length, step, forget, columns, state, names)
    made = panes.groupBy("client_ip").transformWithStateInPandas(processor, out, "Append", "EventTime")
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window")
    return made.select(window, *names[2:])
