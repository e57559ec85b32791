"""Model windows from panes: each request is aggregated once, into the slide it lies in.

A pane is one slide of one client. It holds what windows can be put together from: counts and sums, the
moments (number, mean, sum of squared differences from the mean) of payload sizes and of gaps between requests, the
first request and its time, the last time. A window joins the panes of its slides, at most duration / slide of
them, so their list is bounded, and the moments are merged pairwise, which does not cancel like sums of squares.

Requests are sorted once and never copied per window; what is copied per window is a row per pane. A busy
client's requests spread over all its panes. Its panes, in number bounded by time and not by traffic, meet in one
task only for the gap between the last request of a pane and the first of the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botlens.operators.arrivals import with_arrival_times
from botlens.operators.windows import FIRST_VALUES, client_windows, windows_per_event


def _moments(value: str) -> Column:
    """Moments of the values of a group."""
    number = F.count(value).cast("double")
    return F.struct(
        number.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        (F.coalesce(F.var_pop(value), F.lit(0.0)) * number).alias("m2"),
    )


def _merged(one: Column, other: Column) -> Column:
    """Moments of both groups together."""
    number = one["n"] + other["n"]
    apart = other["mean"] - one["mean"]
    share = F.when(number > 0, other["n"] / number).otherwise(F.lit(0.0))
    return F.struct(
        number.alias("n"), (one["mean"] + apart * share).alias("mean"),
        (one["m2"] + other["m2"] + apart * apart * one["n"] * share).alias("m2"),
    )


def _all_merged(moments: Column) -> Column:
    nothing = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(moments, nothing, _merged)


def _deviation(moments: Column) -> Column:
    """Sample deviation, NULL below two values."""
    return F.when(moments["n"] > 1, F.sqrt(moments["m2"] / (moments["n"] - 1)))


def client_panes(features: DataFrame, slide: str, gaps: bool = False, more: Sequence[Column] = ()) -> DataFrame:
    """One row per slide and client that had requests: ``pane``, ``client_ip`` and the partial aggregates.

    With ``gaps`` also those of the time between requests, the one to the client's pane before included. ``more`` are
    further aggregates of a pane.
    """
    order = [c for c in ("timestamp", "event_id") if c in features.columns]
    rows = features.withColumn("pane", F.window("timestamp", slide))
    partial = [
        F.count(F.lit(1)).alias("requests"), F.sum("is_failure").alias("failures"), F.count("is_failure").alias("judged"),
        _moments("Payload_Size").alias("payload"), F.min(F.struct(*order, *FIRST_VALUES)).alias("first"), *more,
    ]
    if not gaps:
        return rows.groupBy("pane", "client_ip").agg(*partial)
    in_pane = Window.partitionBy("pane", "client_ip").orderBy(*order)
    micros = F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(in_pane))
    partial += [_moments("_gap").alias("inside"), F.max("timestamp").alias("last")]
    panes = rows.withColumn("_gap", micros / F.lit(1e6)).groupBy("pane", "client_ip").agg(*partial)
    before = F.lag("last").over(Window.partitionBy("client_ip").orderBy("pane"))
    between = (F.unix_micros(F.col("first.timestamp")) - F.unix_micros(before)) / F.lit(1e6)
    one = F.when(between.isNotNull(), F.array(F.struct(F.lit(1.0).alias("n"), between.alias("mean"), F.lit(0.0).alias("m2"))))
    arrivals = _all_merged(F.concat(F.array("inside"), F.coalesce(one, F.array())))
    return panes.withColumns({"since_last": between, "gaps": arrivals}).drop("inside", "last")


def windows_of_panes(panes: DataFrame, duration: str, slide: str) -> DataFrame:
    """Model features per sliding window and client; with arrival times where the panes have gaps."""
    timed = "gaps" in panes.columns
    held = [c for c in panes.columns if c not in ("pane", "client_ip")]
    grouped = (
        panes.groupBy(F.window("pane.start", duration, slide), "client_ip")
        .agg(F.array_sort(F.collect_list(F.struct("pane.start", *held))).alias("panes"))
    )

    def total(name: str) -> Column:
        return F.aggregate(F.col(f"panes.{name}"), F.lit(0).cast("bigint"), lambda s, x: s + F.coalesce(x, F.lit(0)))

    failure_rate = F.try_divide(total("failures"), total("judged"))
    payload = _all_merged(F.col("panes.payload"))
    merged = grouped.withColumns({"_payload": payload, "_first": F.array_min("panes.first")})
    if timed:
        merged = merged.withColumns({
            "time_since_last_request": F.coalesce(F.col("panes.since_last")[0], F.lit(0.0)),
            "inter_arrival_std": F.coalesce(_deviation(_all_merged(F.col("panes.gaps"))), F.lit(0.0)),
        })
    return merged.select(
        "window", "client_ip", total("requests").alias("requests_per_ip"), failure_rate.alias("failure_rate_per_ip"),
        F.when(F.col("_payload.n") > 0, F.col("_payload.mean")).alias("avg_payload_per_ip"),
        _deviation(F.col("_payload")).alias("payload_std_per_ip"), failure_rate.alias("protocol_error_rate"),
        *[F.col(f"_first.{name}").alias(name) for name in FIRST_VALUES],
        *(["time_since_last_request", "inter_arrival_std"] if timed else []),
    )


def feature_windows(features: DataFrame, duration: str, slide: str, watermark: str = "10 minutes", gaps: bool = False) -> DataFrame:
    """Model features per window and client: by panes on tables whose slide divides the window, else directly.

    With ``gaps`` also the arrival times (tables only).
    """
    if not features.isStreaming and windows_per_event(duration, slide):
        return windows_of_panes(client_panes(features, slide, gaps), duration, slide)
    grouped = client_windows(features, duration, slide, watermark)
    return with_arrival_times(grouped, features, duration, slide) if gaps else grouped


#: log2 of the buckets of an agent sketch; the standard error of a count is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def agent_panes(events: DataFrame, slide: str, watermark: str = "10 minutes") -> DataFrame:
    """One row per slide and client: number of requests and a sketch of the different agents.

    Works on tables and, in update or append mode, on streams. Sketches can be stored and merged later; an empty agent
    counts, a NULL one does not.
    """
    timed = events.withWatermark("timestamp", watermark).groupBy(F.window("timestamp", slide).alias("pane"), "client_ip")
    # Sketches pass over empty texts, so every agent gets a first letter.
    agent = F.concat(F.lit("="), F.col("user_agent"))
    return timed.agg(F.count(F.lit(1)).alias("request_count"), F.hll_sketch_agg(agent, SKETCH_BITS).alias("agents"))


def diversity_windows(panes: DataFrame, duration: str, slide: str) -> DataFrame:
    """Different agents per sliding window and client from the last state of each pane, with the standard error."""
    merged = panes.groupBy(F.window("pane.start", duration, slide), "client_ip").agg(
        F.sum("request_count").alias("request_count"), F.hll_sketch_estimate(F.hll_union_agg("agents")).alias("distinct_agents")
    )
    return merged.withColumn("standard_error", F.col("distinct_agents") * F.lit(SKETCH_ERROR))
