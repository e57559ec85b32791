"""Paths that bots request, live: requests meet the detections that name their client and time.

Both streams are cut into pieces as long as the greatest common divisor of the windows' length and slide, as in
:func:`botlens.operators.report.top_bot_paths`, so the time range of the join is an equality. Requests are counted per piece,
client and path before they meet, and a client's marked piece counts once, however many detections mark it, so
a client with most of the requests costs each piece one row a path.

State is bounded by time, not by clients: every key holds the piece, and both streams have a watermark. A verdict on
a piece comes as late as the last window that holds it, so detections get the windows' length on top of the delay.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.operators.windows import whole_seconds


def live_bot_paths(
    events: DataFrame, bot_windows: DataFrame, duration: str, slide: str, delay: str = "10 seconds", slot: str = "1 minute"
) -> DataFrame:
    """``slot_start, path, request_count``: requests in bot windows, for append mode.

    ``bot_windows`` has ``window_start``, ``window_end`` and ``client_ip``, with repeats allowed; ``events`` has
    ``timestamp``, ``client_ip`` and ``path``. Rows without one of these take no part. ``delay`` is how much later than the
    newest row a request, or a detection after its window's end, may come; later rows are dropped. ``slot`` is
    a multiple of the piece. A slot comes out when both streams have passed it. Sums of finished slots by
    path are :func:`botlens.operators.report.top_bot_paths` of the same rows. Tables work too.
    """
    long, short, late = whole_seconds(duration), whole_seconds(slide), whole_seconds(delay)
    if not long or not short or late is None:
        raise ValueError(f"windows of {duration} every {slide}, {delay} late, are not whole seconds")
    piece = math.gcd(long, short)
    if not whole_seconds(slot) or whole_seconds(slot) % piece:
        raise ValueError(f"a slot of {slot} is not a multiple of {piece} seconds")
    step = F.expr(f"interval {piece} seconds")
    counted = (
        events.select("timestamp", "client_ip", "path").where("client_ip is not null and path is not null")
        .withWatermark("timestamp", f"{late} seconds")
        .groupBy(F.window("timestamp", f"{piece} seconds"), "client_ip", "path").agg(F.count(F.lit(1)).alias("requests"))
        .select(F.window_time("window").alias("at"), "client_ip", "path", "requests")
    )
    # The last microsecond of a piece stands for it, as in window_time.
    tick = F.expr("interval 1 microsecond")
    last = F.explode(F.sequence(F.col("window_start") + step - tick, F.col("window_end") - tick, step))
    marked = (
        bot_windows.where("client_ip is not null and window_start < window_end").select(last.alias("at"), "client_ip")
        .withWatermark("at", f"{late + long} seconds").dropDuplicates(["at", "client_ip"])
    )
    met = counted.join(marked, ["at", "client_ip"])
    slots = met.groupBy(F.window("at", slot), "path").agg(F.sum("requests").alias("request_count"))
    return slots.select(F.col("window.start").alias("slot_start"), "path", "request_count")


def top_paths(slots: DataFrame, size: int = 10) -> DataFrame:
    """Most requested paths of finished slots, ties by path; one top-k step."""
    total = slots.groupBy("path").agg(F.sum("request_count").alias("request_count"))
    return total.orderBy(F.desc("request_count"), F.asc("path")).limit(size)
