"""Time between requests of one client, on batch tables.

Sorting all requests of a client in one task would put a client with a third of
the traffic on one executor. Requests are therefore sorted per client *and* time
slot, and each slot is given the client's last request before it. The gaps are
the same as with one sort per client.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _slot(seconds: int) -> Column:
    second = F.unix_seconds("timestamp")
    return (second - F.pmod(second, F.lit(seconds))).alias("_slot")


def request_gaps(events: DataFrame, slot_seconds: int = 60) -> DataFrame:
    """Events (timestamp, client_ip, event_id if there is one) with ``gap_seconds``.

    The gap is the time since the previous request of the client, NULL for its
    first request. Events without a timestamp are left out.
    """
    order = [c for c in ("timestamp", "event_id") if c in events.columns]
    timed = events.where(F.col("timestamp").isNotNull()).select(
        *order, "client_ip", _slot(slot_seconds)
    )

    # Seed every slot with the last request the client made before it, which
    # sorts ahead of the slot's own requests.
    by_client = Window.partitionBy("client_ip").orderBy("_slot")
    seeds = (
        timed.groupBy("client_ip", "_slot")
        .agg(F.max("timestamp").alias("_last"))
        .select("client_ip", "_slot", F.lag("_last").over(by_client).alias("timestamp"))
        .where(F.col("timestamp").isNotNull())
        .withColumn("_seed", F.lit(True))
    )
    rows = timed.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)

    # The slot comes first: a number sorts faster than addresses with a common start.
    in_slot = Window.partitionBy("_slot", "client_ip").orderBy(*order)
    micros = F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(in_slot))
    return (
        rows.withColumn("gap_seconds", micros / F.lit(1e6))
        .where(~F.col("_seed"))
        .select(*order, "client_ip", "gap_seconds")
    )


def arrival_windows(
    gaps: DataFrame, duration: str, slide: str, watermark: str = "10 minutes"
) -> DataFrame:
    """Arrival-time features per window and client.

    ``time_since_last_request`` belongs to the first request of the window, as
    the other per-request features do; ``inter_arrival_std`` is the sample
    deviation of all gaps. Both are 0 where there is no gap to speak of.
    """
    # Of requests at the same time, only the first can have a gap other than 0.
    earliest = F.min(F.struct("timestamp", (-F.col("gap_seconds")).alias("minus_gap")))
    return (
        gaps.withWatermark("timestamp", watermark)
        .groupBy(F.window("timestamp", duration, slide), "client_ip")
        .agg(
            (-earliest["minus_gap"]).alias("time_since_last_request"),
            F.stddev_samp("gap_seconds").alias("inter_arrival_std"),
        )
        .fillna(0.0, subset=["time_since_last_request", "inter_arrival_std"])
    )


def with_arrival_times(
    windows: DataFrame, events: DataFrame, duration: str, slide: str
) -> DataFrame:
    """Client windows with the real arrival-time features.

    Both sides are aggregates on (window, client), so the join moves one row
    per window and client.
    """
    arrivals = arrival_windows(request_gaps(events), duration, slide).select(
        F.col("window").alias("_window"),
        F.col("client_ip").alias("_ip"),
        "time_since_last_request",
        "inter_arrival_std",
    )
    same = (windows["window"] == arrivals["_window"]) & windows["client_ip"].eqNullSafe(
        arrivals["_ip"]
    )
    return windows.join(arrivals, same, "left").drop("_window", "_ip")
