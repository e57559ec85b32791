"""Rules over the order of a client's requests: steps that follow each other within a time limit.

Requests that fit no step are dropped first. The others are sorted per client *and* slot of time, so a client with
most of the requests is spread over as many tasks as it has slots. A whole sequence lasts at most (steps - 1) times
the limit, so each slot is given the requests that came so long before it, and one shuffle serves all steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_matches(events: DataFrame, steps: Sequence[Column], limit_seconds: float, slot_factor: int = 4) -> DataFrame:
    """The requests that complete a sequence, with all their columns.

    A request completes the first step if it fits it, and step j if it fits it and the same client completed step
    j - 1 earlier, strictly, and at most ``limit_seconds`` before. Other requests may lie between, a
    request may belong to several sequences, and repeated rows all count. Requests without ``timestamp`` or
    ``client_ip`` take no part; a condition that is NULL does not fit. Slots last ``slot_factor`` times the longest
    sequence; the result does not depend on it.
    """
    limit = round(limit_seconds * 1_000_000)
    if not steps or limit < 1 or slot_factor < 1:
        raise ValueError("a sequence needs steps, a limit of a microsecond at least and a slot")
    span = max(limit * (len(steps) - 1), 1)
    slot = span * slot_factor
    fits = F.array(*(F.coalesce(s, F.lit(False)) for s in steps))
    timed = (
        events.where("timestamp is not null and client_ip is not null")
        .select(F.struct(*(F.col(f"`{c}`") for c in events.columns)).alias("row"), "client_ip",
                F.unix_micros("timestamp").alias("at"), fits.alias("fits"))
        .where(F.array_contains("fits", True))
    )
    own = F.floor(F.col("at") / F.lit(slot))
    # A request near the end of its slot also stands before the next one.
    places = F.when(F.floor((F.col("at") + span) / F.lit(slot)) > own, F.array(own, own + 1)).otherwise(F.array(own))
    placed = timed.select("*", own.alias("own"), F.explode(places).alias("slot"))
    earlier = Window.partitionBy("slot", "client_ip").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    done = placed.withColumn("done", F.col("fits")[0])
    for step in range(1, len(steps)):
        last = F.max(F.when(F.col("done"), F.col("at"))).over(earlier)
        reached = F.coalesce(F.col("at") - last <= limit, F.lit(False))
        done = done.withColumn("done", F.col("fits")[step] & reached)
    return done.where("done and slot = own").select("row.*")


def sequence_clients(events: DataFrame, steps: Sequence[Column], limit_seconds: float) -> DataFrame:
    """``client_ip, sequence_count, first_completed, last_completed`` of the clients that complete a sequence."""
    return sequence_matches(events, steps, limit_seconds).groupBy("client_ip").agg(
        F.count(F.lit(1)).alias("sequence_count"), F.min("timestamp").alias("first_completed"), F.max("timestamp").alias("last_completed")
    )
