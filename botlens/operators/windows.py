"""Event-time windows per client.

All of these are one partial aggregation before one shuffle on (window, client),
so a client that sends a third of all requests leaves each task as a few rows
per window, and its windows spread over the reducers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.functions.scores import ratio

FIRST_VALUES = (
    "Port", "Request_Type", "Protocol", "Payload_Size", "is_encrypted", "is_failure",
    "ua_is_empty", "ua_is_tool", "ua_is_browser", "user_agent",
)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
# From this many windows per event on, batch tables are counted per slide first. A choice of plan by
# the configured ratio, never by data; both plans give the same rows.
MANY_WINDOWS = 6


def whole_seconds(text: str) -> int | None:
    """Seconds of a duration like ``5 minutes``; None for any other form."""
    found = re.fullmatch(r"(\d+) (second|minute|hour|day|week)s?", text.strip().lower())
    return int(found[1]) * _UNIT_SECONDS[found[2]] if found else None


def windows_per_event(duration: str, slide: str) -> int | None:
    """How many windows an event lies in; None if the slide does not divide the duration."""
    long, short = whole_seconds(duration), whole_seconds(slide)
    return long // short if long and short and long % short == 0 else None


_TRAFFIC_SUMS = {
    "error_4xx_count": "is_error_4xx",
    "error_5xx_count": "is_error_5xx",
    "total_errors": "is_error",
    "total_success": "is_success",
    "suspicious_ua_count": "ua_suspicious",
}


def traffic_windows(
    flagged: DataFrame, duration: str, slide: str, watermark: str = "10 minutes"
) -> DataFrame:
    """Counts per sliding window and client over events with suspicion flags.

    Where an event lies in many windows, a batch table is first counted per slide
    and client, and those counts are added up per window: a busy client then costs
    one row per slide, not one per request and window. (Streams in update mode
    allow one aggregation only, so they take the direct way.)
    """
    if not flagged.isStreaming and (windows_per_event(duration, slide) or 0) >= MANY_WINDOWS:
        return _traffic_windows_by_slide(flagged, duration, slide)
    return (
        flagged.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", duration, slide), "client_ip")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            *[F.sum(flag).alias(name) for name, flag in _TRAFFIC_SUMS.items()],
            F.avg("bytes_sent").alias("avg_bytes_sent"),
        )
    )


def _traffic_windows_by_slide(flagged: DataFrame, duration: str, slide: str) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    per_slide = flagged.groupBy(F.window("timestamp", slide).alias("_slide"), "client_ip").agg(
        F.count(F.lit(1)).alias("request_count"),
        *[F.sum(flag).alias(name) for name, flag in _TRAFFIC_SUMS.items()],
        F.sum(F.col("bytes_sent").cast("double")).alias("_bytes"),
        F.count("bytes_sent").alias("_sizes"),
    )
    average = F.try_divide(F.sum("_bytes"), F.sum("_sizes"))
    return per_slide.groupBy(F.window("_slide.start", duration, slide), "client_ip").agg(
        total("request_count"),
        *[total(name) for name in _TRAFFIC_SUMS],
        average.alias("avg_bytes_sent"),
    )


def traffic_ratios(windows: DataFrame) -> DataFrame:
    """Add the shares of failed and of suspicious requests, 0 for an empty window."""
    total = F.col("request_count")
    return windows.withColumns({
        "error_ratio": ratio(F.col("total_errors"), total),
        "ua_suspicious_ratio": ratio(F.col("suspicious_ua_count"), total),
    })


def client_windows(
    features: DataFrame, duration: str, slide: str, watermark: str = "10 minutes"
) -> DataFrame:
    """Model features per sliding window and client.

    The per-request features are those of the first request of the window: one
    minimum over (time, id, features), so they come from the same request and
    do not depend on how the rows were read. (Tables whose windows overlap go by
    panes, see :mod:`botlens.operators.panes`, with the same result.)
    """
    order = [c for c in ("timestamp", "event_id") if c in features.columns]
    failure_rate = F.avg("is_failure")
    aggregated = (
        features.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", duration, slide), "client_ip")
        .agg(
            F.count(F.lit(1)).alias("requests_per_ip"),
            failure_rate.alias("failure_rate_per_ip"),
            F.avg("Payload_Size").alias("avg_payload_per_ip"),
            F.stddev_samp("Payload_Size").alias("payload_std_per_ip"),
            failure_rate.alias("protocol_error_rate"),
            F.min(F.struct(*order, *FIRST_VALUES)).alias("_first"),
        )
    )
    firsts = [F.col(f"_first.{name}").alias(name) for name in FIRST_VALUES]
    rest = [c for c in aggregated.columns if c != "_first"]
    return aggregated.select(*rest, *firsts)


def fill_deviation(windows: DataFrame) -> DataFrame:
    """A single request has no deviation: 0."""
    return windows.fillna(0.0, subset=["payload_std_per_ip"])


def no_arrival_times(windows: DataFrame) -> DataFrame:
    """The two arrival-time features as constants, for a model trained without them."""
    return windows.withColumns({
        "time_since_last_request": F.lit(0.0),
        "inter_arrival_std": F.lit(0.0),
    })


def protocol_error_rate(
    features: DataFrame, duration: str, slide: str, watermark: str = "10 minutes"
) -> DataFrame:
    """Share of failed requests per window and protocol, over all clients."""
    return (
        features.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", duration, slide), "Protocol")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.avg("is_failure").alias("protocol_error_rate"),
        )
    )


def agent_diversity(
    events: DataFrame,
    duration: str,
    slide: str,
    watermark: str = "10 minutes",
    relative_error: float | None = None,
) -> DataFrame:
    """Different agents per window and client; an empty one counts, a NULL one does not.

    Exact for batch tables. Streams have no exact distinct count: give a
    ``relative_error`` to get the approximate one.
    """
    agent = "user_agent"
    distinct = (
        F.count_distinct(agent)
        if relative_error is None
        else F.approx_count_distinct(agent, relative_error)
    )
    return (
        events.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", duration, slide), "client_ip")
        .agg(F.count(F.lit(1)).alias("request_count"), distinct.alias("distinct_agents"))
    )


def flatten_window(windows: DataFrame) -> DataFrame:
    """Replace ``window`` by ``window_start`` and ``window_end``."""
    rest = [c for c in windows.columns if c != "window"]
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )
