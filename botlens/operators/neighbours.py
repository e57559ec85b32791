"""Nearest rows of a table, exactly, by blocks of points that lie together.

Rows with equal values are one point; a point keeps the first few keys of its rows, so a value that a third of all
rows share costs one row here. Points are sorted along a curve through three random projections, and stretches of it are
halved at the median of their widest axis into blocks of at most 256. A point's k nearest in its own block bound how far
its nearest can be: it visits the blocks whose boxes come closer than that, and no others. Boxes of whole
stretches are compared first, so that most pairs of blocks are never looked at.

What moves is one row per point and visited block, packed by block; distances are made inside a task, and of each visit only
the points that beat the bound come out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botlens.lineage import stored
from botlens.shipping import ship_package

_AXES, _BITS, _BLOCK = 3, 20, 256


def _directions(size: int) -> np.ndarray:
    """Directions at right angles, one per row; fewer where there are fewer values."""
    draw = np.random.default_rng(7).standard_normal((size, size))
    return np.linalg.qr(draw)[0].T[:_AXES]


def _points(rows: DataFrame, key: str, group: Sequence[str], values: Sequence[str], keep: int) -> DataFrame:
    """One row per different (group, values) with the ``keep`` smallest keys of its rows."""
    order = Window.partitionBy(*group, *values).orderBy(key)
    first = rows.select(key, *group, *values).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep)
    return first.groupBy(*group, *values).agg(F.array_sort(F.collect_list(key)).alias("_keys"))


def nearest_rows(rows: DataFrame, key: str, group: Sequence[str], values: Sequence[str], scaled: Sequence[Column], k: int) -> DataFrame:
    """Rows with ``nearest``: the ``k`` nearest other rows of the same group as (distance, key, values).

    Distance is that of the ``scaled`` values, one column for each of ``values``; equal distances come by key. Keys are
    unique. A group of fewer rows gives fewer. Values are not NULL.
    """
    group, values = list(group), list(values)
    ship_package(rows.sparkSession)
    points = _points(rows, key, group, values, k + 1)
    # Numbers in the order of the first keys, so that they decide between equal distances as keys do.
    numbered = points.orderBy(F.col("_keys")[0]).withColumn("_point", F.monotonically_increasing_id())
    points = stored(numbered.withColumn("_at", F.array(*[c.cast("double") for c in scaled])))
    blocks = stored(_blocks(points, group, len(values), k))
    found = _visits(blocks, group).join(blocks.select("block", "ids", "places"), "block")
    best = found.mapInArrow(_nearest(len(values), k), "_point bigint, _other bigint, distance double")
    order = Window.partitionBy("_point").orderBy("distance", "_other")
    best = best.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    others = points.select(F.col("_point").alias("_other"), F.col("_keys").alias("_others"), F.struct(*values).alias("_row"))
    named = F.transform("_others", lambda o: F.struct("distance", o.alias("key"), F.col("_row").alias("row")))
    lists = best.join(others, "_other").groupBy("_point").agg(F.flatten(F.collect_list(named)).alias("_l"))
    lists = lists.select("_point", F.slice(F.array_sort("_l"), 1, k + 1).alias("_list"))
    out = rows.join(points.select(*group, *values, "_point").join(lists, "_point").drop("_point"), [*group, *values])
    others = F.filter("_list", lambda x: x["key"] != F.col(key))
    return out.withColumn("nearest", F.slice(others, 1, k)).drop("_list")


def _blocks(points: DataFrame, group: list[str], size: int, k: int) -> DataFrame:
    """Blocks of points near each other: their numbers, places and bounds, the block's box and that of its stretch."""
    axes = _directions(size)
    projected = [sum((F.col("_at")[i] * float(w) for i, w in enumerate(axis)), F.lit(0.0)) for axis in axes]
    spans = points.select(*[p.alias(f"_p{j}") for j, p in enumerate(projected)])
    number, *ends = spans.agg(F.count("*"), *[f(f"_p{j}") for j in range(len(axes)) for f in (F.min, F.max)]).first()
    lows = np.array([e or 0.0 for e in ends[::2]])
    wides = np.array([(e or 0.0) for e in ends[1::2]]) - lows
    cells = ((1 << _BITS) - 1) / np.where(wides > 0, wides, 1.0)

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _flat(batch.column(batch.num_columns - 1)).reshape(-1, size)
            spots = ((at @ axes.T - lows) * cells).clip(0, (1 << _BITS) - 1).astype(np.int64)
            code = np.zeros(len(at), np.int64)
            for bit in range(_BITS - 1, -1, -1):
                for j in range(len(axes)):
                    code = (code << 1) | ((spots[:, j] >> bit) & 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "_code"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = np.zeros(batch.num_rows + 1, bool)
            edges[[0, -1]] = True
            for name in group:
                held = pc.dictionary_encode(batch.column(batch.schema.get_field_index(name)), null_encoding="encode")
                codes = held.indices.to_numpy(zero_copy_only=False)
                edges[1:-1] |= codes[1:] != codes[:-1]
            ends = np.flatnonzero(edges)
            for start, stop in zip(ends[:-1].tolist(), ends[1:].tolist()):
                yield _stretch(batch.slice(start, stop - start), group, size, k)

    kinds = dict(points.dtypes)
    carried = points.select(*group, "_point", "_at")
    kept = ", ".join([*[f"`{g}` {kinds[g]}" for g in group], "_point bigint, _at array<double>"])
    coded = carried.mapInArrow(along, f"{kept}, _code bigint")
    # A stretch is what Spark hands over at a time, spark.sql.execution.arrow.maxRecordsPerBatch points.
    ordered = coded.repartitionByRange(*group, "_code").sortWithinPartitions(*group, "_code", "_point")
    columns = ", ".join(f"`{g}` {kinds[g]}" for g in group)
    box = "array<double>"
    return ordered.mapInArrow(cut, (
        f"{columns}, block bigint, ids array<bigint>, places {box}, bounds {box}, lows {box}, highs {box}, bound double, "
        f"stretch bigint, all_lows {box}, all_highs {box}, all_bound double"
    ))


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([a.size for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([a.ravel() for a in arrays])))


def _halved(at: np.ndarray, which: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in parts of at most a block, halved at the median of the widest axis."""
    open_parts = [which]
    while open_parts:
        part = open_parts.pop()
        if len(part) <= _BLOCK:
            yield np.sort(part)
            continue
        here = at[part]
        axis = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
        order = np.argsort(here[:, axis], kind="stable")
        open_parts += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]


def _stretch(batch: pa.RecordBatch, group: list[str], size: int, k: int) -> pa.RecordBatch:
    """The blocks of points of one group."""
    ids = batch.column(batch.schema.get_field_index("_point")).to_numpy(zero_copy_only=False)
    at = _flat(batch.column(batch.schema.get_field_index("_at"))).reshape(-1, size)
    order = np.argsort(ids, kind="stable")
    ids, at = ids[order], at[order]
    parts = list(_halved(at, np.arange(len(ids))))
    bounds = []
    for part in parts:
        apart = _apart(at[part], at[part])
        bounds.append(np.partition(apart, k, axis=1)[:, k] if len(part) > k else np.full(len(part), np.inf))
    count = len(parts)
    groups = [pa.concat_arrays([batch.column(batch.schema.get_field_index(g)).slice(0, 1)] * count) for g in group]
    most = [float(b.max()) for b in bounds]
    whole = [_lists([box] * count) for box in (at.min(axis=0), at.max(axis=0))]
    return pa.RecordBatch.from_arrays(
        [*groups, pa.array([int(ids[p[0]]) for p in parts]), _lists([ids[p] for p in parts]), _lists([at[p] for p in parts]), _lists(bounds),
         _lists([at[p].min(axis=0) for p in parts]), _lists([at[p].max(axis=0) for p in parts]), pa.array(most),
         pa.array(np.full(count, ids[0])), *whole, pa.array([max(most)] * count)],
        names=[*group, "block", "ids", "places", "bounds", "lows", "highs", "bound", "stretch", "all_lows", "all_highs", "all_bound"],
    )


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances of all rows of both, summed value by value."""
    total = np.zeros((len(left), len(right)))
    for i in range(left.shape[1]):
        total += (left[:, i : i + 1] - right[:, i]) ** 2
    return np.sqrt(total)


def _near(low: str, high: str, other_low: str, other_high: str, bound: str) -> Column:
    """Whether two boxes come as close as the bound; rounding never leaves one out."""
    gaps = F.zip_with(
        F.zip_with(low, other_high, lambda a, b: a - b), F.zip_with(other_low, high, lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)) <= F.col(bound) * (1 + 1e-9)


def _visits(blocks: DataFrame, group: list[str]) -> DataFrame:
    """``block`` and the points (``from_ids``, ``from_places``, ``from_bounds``) of one other block that must visit it."""
    stretches = blocks.select(*group, "stretch", "all_lows", "all_highs", "all_bound").dropDuplicates(["stretch"])
    there = stretches.select(*group, F.col("stretch").alias("to"), F.col("all_lows").alias("to_lows"), F.col("all_highs").alias("to_highs"))
    met = stretches.join(there, group).where(_near("all_lows", "all_highs", "to_lows", "to_highs", "all_bound"))
    boxes = blocks.select("stretch", F.col("block").alias("from"), "lows", "highs", "bound")
    some = met.select("stretch", "to", "to_lows", "to_highs").join(boxes, "stretch").where(_near("lows", "highs", "to_lows", "to_highs", "bound"))
    targets = blocks.select(F.col("stretch").alias("to"), "block", F.col("lows").alias("block_lows"), F.col("highs").alias("block_highs"))
    pairs = some.select("from", "to", "lows", "highs", "bound").join(targets, "to")
    pairs = pairs.where(_near("lows", "highs", "block_lows", "block_highs", "bound")).select("from", "block", "block_lows", "block_highs")
    targets = pairs.groupBy("from").agg(F.collect_list(F.struct("block", "block_lows", "block_highs")).alias("to"))
    points = blocks.select(F.col("block").alias("from"), "ids", "places", "bounds")
    return targets.join(points, "from").select("to.block", "to.block_lows", "to.block_highs", "ids", "places", "bounds").mapInArrow(
        _visitors, "block bigint, from_ids array<bigint>, from_places array<double>, from_bounds array<double>"
    )


def _visitors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            blocks, ids, at, bounds = (batch.column(j)[i].values.to_numpy(zero_copy_only=False) for j in (0, 3, 4, 5))
            at = at.reshape(len(ids), -1)
            lows, highs = (batch.column(j)[i].values.flatten().to_numpy(zero_copy_only=False).reshape(len(blocks), -1) for j in (1, 2))
            out = []
            for block, low, high in zip(blocks.tolist(), lows, highs):
                gaps = np.maximum(np.maximum(low - at, at - high), 0.0)
                in_reach = np.sqrt((gaps**2).sum(axis=1)) <= bounds * (1 + 1e-9)
                if in_reach.any():
                    out.append((block, ids[in_reach], at[in_reach], bounds[in_reach]))
            # A few at a time: each can be a whole block of points.
            for some in (out[j : j + 64] for j in range(0, len(out), 64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in some]), *(_lists([o[j] for o in some]) for j in (1, 2, 3))],
                    names=["block", "from_ids", "from_places", "from_bounds"],
                )


def _nearest(size: int, k: int):
    """The ``k + 1`` nearest points of a block within the bound of each visitor (itself among them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                visitors, bounds, ids = (rows[n][i].values.to_numpy(zero_copy_only=False) for n in ("from_ids", "from_bounds", "ids"))
                places, at = (rows[n][i].values.to_numpy(zero_copy_only=False).reshape(-1, size) for n in ("from_places", "places"))
                apart = _apart(places, at)
                # Points of a block stand in the order of their numbers, so a stable sort settles equal distances.
                order = np.argsort(apart, axis=1, kind="stable")[:, : k + 1]
                best = np.take_along_axis(apart, order, axis=1)
                row, column = np.nonzero(best <= bounds[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(visitors[row]), pa.array(ids[order[row, column]]), pa.array(best[row, column])],
                    names=["_point", "_other", "distance"],
                )

    return run
