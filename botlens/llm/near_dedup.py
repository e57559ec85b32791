"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard, components.

A document's set holds its distinct shingles of five words, lower-cased A-Z; a shorter one is a
single shingle. Documents with equal sets are one class, represented by its smallest doc_id.
Forty bands of five coordinates give a pair at the threshold of 0.75 a chance of 2 in 100,000 to be
missed; every candidate is confirmed on the full sets.

Defined results: texts that are null, empty or blank have no shingle and no link. Rows that share a
doc_id are one document, linked with whatever any of them is linked with. Rows without doc_id point
to the component of their class, if it has an id, and stay (kept) only if it has none. Repeated rows
are kept or not together. An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm import hashing
from botlens.llm.banding import leaders, linked
from botlens.llm.common import arrow_column, discard, fresh, row_blocks, saved, text_bytes

WORDS, BANDS, ROWS = 5, 40, 5
#: Coordinates whose lowest bits are the sketch. At the threshold 32 of 256 differ on average, with a
#: deviation of 5.3; pairs that differ in more than ``MOST_APART`` are not checked (six deviations and more).
SKETCH, MOST_APART = 256, 68
_BLOCK = 1 << 20


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    for start, stop in row_blocks(offsets, _BLOCK):
        part = data[offsets[start] : offsets[stop]]
        bounds = offsets[start : stop + 1] - offsets[start]
        begins, ends = hashing.edges(~hashing.SPACE_TABLE[part], bounds)
        words = hashing.Ranges(hashing.LOWER_TABLE[part]).hash(begins, ends)
        runs = hashing.sequences(words, WORDS)
        at = np.searchsorted(begins, bounds)
        for first, last in zip(at[:-1].tolist(), at[1:].tolist()):
            if last - first >= WORDS:
                yield np.unique(runs[first : last - WORDS + 1])
            elif last > first:
                yield hashing.sequences(words[first:last], last - first)
            else:
                yield np.zeros(0, np.uint64)


_FEATURES = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, sketch array<bigint>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, sums, signatures, filled = [], [], [], []
        for shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            sums.append((hashing.mix(shingles, 1).sum(dtype=np.uint64), hashing.mix(shingles, 2).sum(dtype=np.uint64)))
            filled.append(len(shingles) > 0)
            if len(shingles):
                signatures.append(hashing.signature(shingles, SKETCH))
        signed = np.array(signatures, np.int32).reshape(-1, SKETCH)
        keys = hashing.band_keys(signed[:, : BANDS * ROWS], BANDS)
        bits = np.packbits(signed & 1, axis=1).view(np.int64)
        ends = np.concatenate(([0], np.cumsum(filled))).astype(np.int32)
        pair = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]),
             pa.ListArray.from_arrays(pa.array(ends * BANDS), pa.array(keys.ravel())),
             pa.ListArray.from_arrays(pa.array(ends * (SKETCH // 64)), pa.array(bits.ravel()))],
            names=["doc_id", "n_shingles", "set_a", "set_b", "keys", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), sets], names=["node", "shingles"])


def _unpacked(sets: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint64) for s in sets.to_pylist()]


def _plausible(x: Column, y: Column) -> Column:
    words = range(SKETCH // 64)
    return sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in words), F.lit(0)) <= MOST_APART


def _similar(percent: int):
    def run(left: list, right: list) -> list:
        out = []
        for a, b in zip(left, right):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            small, big = sorted((len(x), len(y)))
            if 100 * small < percent * big:
                out.append(False)
                continue
            both = np.concatenate((x, y))
            both.sort(kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            out.append(100 * common >= percent * (len(both) - common))
        return out

    return run


def near_duplicates(docs: DataFrame, percent: int = 75, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept."""
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    features = saved(texts.mapInArrow(_features, _FEATURES))
    same = ["n_shingles", "set_a", "set_b"]
    classes = features.where("n_shingles > 0").groupBy(same).agg(F.min("doc_id").alias("node"))
    own = F.col("doc_id") == F.col("node")
    members = saved(
        features.join(classes, same, "left")
        .select("doc_id", "n_shingles", "node", F.when(own, F.col("keys")).alias("keys"), F.when(own, F.col("sketch")).alias("sketch"))
    )
    discard(features)
    nodes = members.where("keys is not null").select("node", F.col("node").alias("rank"), "keys", "sketch").dropDuplicates(["node"])
    first = saved(leaders(nodes))
    wanted = first.select(F.col("b").alias("doc_id"))
    sets = saved(texts.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "node bigint, shingles binary"))

    def verify(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
        both = pairs.join(left, "a").join(right, "b")
        return both.where(arrow_column(_similar(percent), "boolean")(F.col("left"), F.col("right"))).select("a", "b")

    labels = linked(nodes, verify, first, sets, _unpacked, percent, _plausible)
    found = members.join(labels, "node", "left")
    component = F.coalesce("component", "node", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents of which no near copy with a smaller id exists, with all their columns."""
    gone = near_duplicates(docs, percent, id_column, text_column).where("not kept and doc_id is not null")
    name = fresh(docs, "gone")
    gone = gone.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col(id_column) == F.col(name), "left_anti")
