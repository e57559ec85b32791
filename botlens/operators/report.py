"""Dashboard aggregates over detections and log events."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.lineage import checkpointed
from botlens.operators.windows import whole_seconds


def top_terms(rows: DataFrame, field: str, size: int | None = 10, **extra: Column) -> DataFrame:
    """Rows per value, most frequent first, ties by value; NULL is no value.

    ``extra`` adds further aggregates to each value. Sorting and limit run as one
    top-k step; without a size all values are returned, in no order.
    """
    counted = (
        rows.where(F.col(field).isNotNull())
        .groupBy(field)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            *[agg.alias(name) for name, agg in extra.items()],
        )
    )
    return counted if size is None else counted.orderBy(F.desc("row_count"), F.asc(field)).limit(size)


def total_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"))


def average(rows: DataFrame, field: str) -> DataFrame:
    return rows.agg(F.avg(field).alias("average"))


def _bucket(time: Column, seconds: int) -> Column:
    # Whole seconds, rounded down to a multiple of the interval.
    second = F.unix_seconds(time)
    return (second - F.pmod(second, F.lit(seconds))).alias("bucket")


_SPAN = 4096


def timeline(
    rows: DataFrame, time: str, seconds: int, zero_fill: bool = True,
    since: str | None = None, until: str | None = None,
) -> DataFrame:
    """Rows per interval, as ``bucket`` (epoch seconds) and ``row_count``.

    ``since`` and ``until`` (times as text, the end exclusive) bound the rows and
    the axis: set them where clocks may be wrong, as one row of 1970 makes the axis
    reach there. With ``zero_fill``, intervals without rows appear with 0, from the
    first to the last one or over the given range. They are made in two steps, spans
    first, so that no single row has to hold the whole axis. The counts are kept once
    computed, so the input runs once.
    """
    timed = rows.where(F.col(time).isNotNull())
    if since is not None:
        timed = timed.where(F.col(time) >= F.lit(since).cast("timestamp"))
    if until is not None:
        timed = timed.where(F.col(time) < F.lit(until).cast("timestamp"))
    counts = timed.groupBy(_bucket(F.col(time), seconds)).agg(F.count(F.lit(1)).alias("row_count"))
    if not zero_fill:
        return counts
    counts = checkpointed(counts)
    span = seconds * _SPAN
    low, high = F.min("bucket"), F.max("bucket")
    if since is not None:
        low = _bucket(F.lit(since).cast("timestamp"), seconds)
    if until is not None:
        high = _bucket(F.lit(until).cast("timestamp") - F.expr("interval 1 microsecond"), seconds)
    ends = counts.agg(low.alias("low"), high.alias("high")).where("low <= high")
    starts = ends.select(
        "high", F.explode(F.sequence("low", "high", F.lit(span))).alias("start")
    ).repartition("start")
    last = F.least(F.col("high"), F.col("start") + (span - seconds))
    axis = starts.select(F.explode(F.sequence("start", last, F.lit(seconds))).alias("bucket"))
    zeros = axis.withColumn("row_count", F.lit(0).cast("bigint"))
    return counts.unionByName(zeros).groupBy("bucket").agg(F.sum("row_count").alias("row_count"))


def request_frequency(events: DataFrame, interval: str = "60 seconds") -> DataFrame:
    """Requests per tumbling window."""
    return events.groupBy(F.window("timestamp", interval)).agg(
        F.count(F.lit(1)).alias("request_count")
    )


def error_rate_over_time(events: DataFrame, interval: str = "60 seconds") -> DataFrame:
    """Requests and share of failed ones per tumbling window."""
    return events.groupBy(F.window("timestamp", interval)).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.avg(F.coalesce((F.col("status") >= 400).cast("int"), F.lit(0))).alias("error_rate"),
    )


def recent(rows: DataFrame, time: str, span: str = "7 days", until: Column | None = None):
    """Rows of the last ``span`` before ``until``, by default before the newest row."""
    newest = rows.agg(F.max(time)).scalar() if until is None else until
    return rows.where(F.col(time) >= newest - F.expr(f"interval {span}"))


def top_bot_paths(
    events: DataFrame, bot_windows: DataFrame, slide: str, size: int = 10, duration: str | None = None
) -> DataFrame:
    """Most requested paths inside bot windows; a request counts once.

    ``bot_windows`` has ``window_start``, ``window_end`` and ``client_ip``. Windows
    start on multiples of the slide, so each is cut into pieces as long as the
    greatest common divisor of ``duration`` and ``slide`` (whole seconds): then
    a request lies in a bot window exactly if its own piece is one of them, and
    the time range becomes an equality. Requests are counted per piece, client
    and path before the join. The marked pieces are distinct, so an inner join
    keeps each count once; the optimizer would push a semi join below the count
    and so send raw requests through the join's shuffle.
    """
    long, short = whole_seconds(duration or slide), whole_seconds(slide)
    if not long or not short:
        raise ValueError(f"windows of {duration} every {slide} are not whole seconds")
    slide = f"{math.gcd(long, short)} seconds"
    piece = F.sequence(
        "window_start", F.col("window_end") - F.expr(f"interval {slide}"), F.expr(f"interval {slide}")
    )
    # Overlapping windows share pieces.
    marked = bot_windows.select(F.explode(piece).alias("_piece"), "client_ip").distinct()
    counted = events.groupBy(
        F.window("timestamp", slide)["start"].alias("_piece"), "client_ip", "path"
    ).agg(F.count(F.lit(1)).alias("_requests"))
    return (
        counted.join(marked, ["_piece", "client_ip"])
        .where(F.col("path").isNotNull())
        .groupBy("path")
        .agg(F.sum("_requests").alias("request_count"))
        .orderBy(F.desc("request_count"), F.asc("path"))
        .limit(size)
    )


def client_profile(detections: DataFrame, client_ip: str) -> DataFrame:
    """Summary of one client: requests, failures, agents, payload, encryption."""
    return (
        detections.where(F.col("client_ip") == client_ip)
        .groupBy("client_ip")
        .agg(
            F.count(F.lit(1)).alias("window_count"),
            F.max("requests_per_ip").alias("max_requests"),
            F.avg("requests_per_ip").alias("avg_requests"),
            F.avg("failure_rate_per_ip").alias("avg_failure_rate"),
            F.avg("avg_payload_per_ip").alias("avg_payload"),
            F.sum("ua_is_tool").alias("tool_windows"),
            F.sum("ua_is_browser").alias("browser_windows"),
            F.sum("is_encrypted").alias("encrypted_windows"),
            F.sum("is_bot").alias("bot_windows"),
        )
    )


def page(rows: DataFrame, number: int, size: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """One page of rows in the given order, counted from 1."""
    return rows.orderBy(*by).offset((number - 1) * size).limit(size)
