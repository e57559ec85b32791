"""Distributed union-find: connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import discard, saved


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node that is not itself the smallest of its component.

    ``links`` has two comparable columns, in any order, with repeats and self links allowed; rows
    with a null are no links. Each round hangs the larger neighbours of every node on its smallest
    one, then its smaller neighbours, until nothing changes: a logarithmic number of rounds, each
    a grouped minimum and a join, written to the shared folder.
    """
    a, b = links.columns
    whole = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = whole.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("component"))
    edges = saved(edges.where("node <> component").distinct())
    state = _fingerprint(edges)
    while state[0]:
        both = edges.union(edges.select("component", "node"))
        lowest = both.groupBy("node").agg(F.min("component").alias("low"))
        large = (
            both.join(lowest, "node").where(F.col("component") > F.col("node"))
            .select(F.col("component").alias("node"), F.least("low", "node").alias("component")).distinct()
        )
        lowest = large.groupBy("node").agg(F.min("component").alias("low"))
        small = (
            large.join(lowest, "node").where(F.col("component") != F.col("low"))
            .select(F.col("component").alias("node"), F.col("low").alias("component"))
            .union(lowest.select("node", "low")).distinct()
        )
        done, edges = edges, saved(small)
        discard(done)
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    return edges


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "component"))).first())
