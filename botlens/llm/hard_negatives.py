"""Hard negatives by rotated one-bit codes with a deterministic error interval.

A vector's components become ``floor(256 x)``; scores are integer inner products. The index turns every
vector by one fixed rotation and keeps the signs of the turned components as a code: with the unit vector
``b`` of the code, ``y = c b + r`` where the stored alignment ``c = <y, b>`` and ``r`` is at right angles
to ``b``. The remainder is coded the same way, ``_LEVELS`` times, and the length of the last one is stored.
For a turned query ``q`` the inner product is the sum of ``c <q, b>`` over the levels plus ``<q, r>``, and
by Cauchy and Schwarz the last term lies within the remainder's length times that of the part of ``q`` at
right angles to the last code. ``<q, b>`` comes from popcounts: ``q`` is rounded to ``_BITS`` bit planes,
and the rounding, summed over the components, widens the interval. The interval holds for every pair, so
rows outside it cannot matter; all others are scored in integers.

``mine`` takes anchors in packs of about ``_ANCHORS`` (a stated query set against all rows, in blocks):
a first pass over the index finds each anchor's positives, a second one, for each positive, the best rows
of other labels within its window of scores. A task gives a few rows per anchor or positive.

Defined results: rows without id or label, without a vector, or with a null or non-finite component take no
part. Rows that share an id count as one, the least by label, then by components. Vectors of different length
compare as if the shorter one went on with zeros. A component beyond +-2^27 / 256 counts as that, so that
scores fit a long (up to 512 components). Equal scores come by ascending id. Anchors without a positive,
and positives without a negative, give no row. Other columns are not looked at; an empty table gives none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botlens.llm.common import saved

_LEVELS, _BITS, _ANCHORS, _ROWS = 4, 8, 4096, 8192
_MOST = 1 << 27


def quantised(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
              label: Column | str = "label") -> DataFrame:
    """id, label, and the vector as whole numbers; one row per id."""
    label = F.col(label) if isinstance(label, str) else label
    plain = rows.select(
        F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.col(vector_column).cast("array<double>").alias("v"),
    ).where("id is not null and label is not null and v is not null")
    whole = plain.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    clipped = F.transform("v", lambda x: F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), F.floor(256 * x))).cast("int"))
    return whole.groupBy("id").agg(F.min(F.struct("label", clipped.alias("v"))).alias("x")).select("id", "x.label", "x.v")


@functools.lru_cache(maxsize=2)
def _rotation(size: int) -> np.ndarray:
    turned, upper = np.linalg.qr(np.random.default_rng(20_240_101).standard_normal((size, size)))
    return turned * np.sign(np.diag(upper))


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Whole numbers, a row per vector, shorter ones filled with zeros."""
    lengths = np.array(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lengths), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = vectors.flatten().to_numpy()
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    raw = np.packbits(bits, axis=1)
    out = np.zeros((len(raw), -(-bits.shape[1] // 64) * 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view(np.uint64)


class Codes:
    """Codes of some vectors, level by level, with alignments and the last remainder's length."""

    def __init__(self, vectors: np.ndarray):
        rest = vectors @ _rotation(vectors.shape[1])
        root = np.sqrt(vectors.shape[1])
        self.codes, self.alignments = [], []
        for _ in range(_LEVELS):
            bits = rest >= 0
            aligned = np.abs(rest).sum(axis=1) / root
            rest = rest - np.where(bits, 1, -1) * (aligned / root)[:, None]
            self.codes.append(_packed(bits))
            self.alignments.append(aligned)
        self.rest = np.linalg.norm(rest, axis=1)
        self.size = np.linalg.norm(vectors, axis=1)


class Query:
    """A turned query in bit planes."""

    def __init__(self, vector: np.ndarray):
        turned = vector @ _rotation(len(vector))
        self.root, self.length = np.sqrt(len(vector)), float(np.linalg.norm(turned))
        low = float(turned.min())
        self.step = max((float(turned.max()) - low) / ((1 << _BITS) - 1), 1e-300)
        levels = np.clip(np.rint((turned - low) / self.step), 0, (1 << _BITS) - 1).astype(np.int64)
        self.planes = [_packed(((levels >> j) & 1).astype(bool)[None, :])[0] for j in range(_BITS)]
        # <q, b> root = sum(low +- ...) = low (2 ones - size) + step (2 popcounts - sum), up to the rounding.
        self.low, self.total, self.dims = low, int(levels.sum()), len(vector)
        self.rounding = float(np.abs(turned - (low + self.step * levels)).sum()) / self.root

    def intervals(self, codes: Codes, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that each of these rows can have."""
        middle = np.zeros(len(rows))
        slack = 1e-9 * self.length * codes.size[rows] + 1e-6
        across = np.zeros(len(rows))
        for level, aligned in zip(codes.codes, codes.alignments):
            words, aligned = level[rows], aligned[rows]
            ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
            both = sum(np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64) << j for j, plane in enumerate(self.planes))
            along = (self.low * (2 * ones - self.dims) + self.step * (2 * both - self.total)) / self.root
            middle += aligned * along
            slack += aligned * self.rounding
            across = np.maximum(np.abs(along) - self.rounding, 0)
        width = np.sqrt(np.maximum(self.length**2 * (1 + 1e-12) - across**2, 0)) * codes.rest[rows] + slack
        return middle - width, middle + width


class Block:
    """Some rows of the index with their codes."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        self.ids, self.labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        self.vectors = _matrix(batch.column(2), size)
        floats = [batch.column(i).flatten().to_numpy().reshape(len(self.ids), -1) for i in (3, 4)]
        self.codes = Codes.__new__(Codes)
        words = floats[0].view(np.uint64).reshape(len(self.ids), _LEVELS, -1)
        self.codes.codes = [words[:, i] for i in range(_LEVELS)]
        self.codes.alignments = [floats[1][:, i] for i in range(_LEVELS)]
        self.codes.rest, self.codes.size = floats[1][:, _LEVELS], floats[1][:, _LEVELS + 1]


_INDEX = "id bigint, label bigint, v array<int>, codes array<bigint>, floats array<double>"


def _coded(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lists(rows: np.ndarray) -> pa.Array:
        ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))

    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            codes = Codes(_matrix(part.column(2), size).astype(float))
            words = np.stack(codes.codes, axis=1).reshape(part.num_rows, -1).view(np.int64)
            floats = np.stack([*codes.alignments, codes.rest, codes.size], axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), lists(words), lists(floats)],
                names=["id", "label", "v", "codes", "floats"],
            )


class Index:
    """Coded rows as a table, with the longest vector's length."""

    def __init__(self, rows: DataFrame, size: int):
        self.rows, self.size = rows, size


def build(vectors: DataFrame) -> Index:
    """The index of all rows of ``quantised``, saved in the shared folder."""
    vectors = saved(vectors)
    size = max(vectors.agg(F.max(F.size("v"))).first()[0] or 1, 1)
    return Index(saved(vectors.mapInArrow(functools.partial(_coded, size), _INDEX)), size)


class _Best:
    """The best k rows of a query so far: score falling, then id rising."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        return self.scores[-1] if len(self.scores) == self.k else -np.inf

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield Block(batch.slice(at, _ROWS), size)


def _positives(anchors: list[tuple], size: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor (id, label, vector) the best k other rows of its label in these batches."""
    best = [_Best(k) for _ in anchors]
    queries = [(i, label, _padded(v, size)) for i, label, v in anchors]
    turned = [Query(v.astype(float)) for _, _, v in queries]
    for block in _blocks(batches, size):
        of_label = {label: np.flatnonzero(block.labels == label) for label in np.unique(block.labels).tolist()}
        for (own, label, vector), query, held in zip(queries, turned, best):
            rows = of_label.get(label)
            if rows is None:
                continue
            rows = rows[block.ids[rows] != own]
            rows = rows[query.intervals(block.codes, rows)[1] >= held.floor]
            scores = block.vectors[rows] @ vector
            held.offer(block.ids[rows], scores)
    yield _rows("anchor, id, score", [(a[0], b.ids, b.scores) for a, b in zip(anchors, best)])


def _negatives(anchors: list[tuple], size: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each anchor (id, label, vector, its positives as (number, least, greatest)) and positive, the best
    k rows of other labels whose scores lie between least and greatest."""
    queries = [(label, _padded(v, size), [(n, low, high, _Best(k)) for n, low, high in windows]) for _, label, v, windows in anchors]
    turned = [Query(v.astype(float)) for _, v, _ in queries]
    for block in _blocks(batches, size):
        everyone = np.arange(len(block.ids))
        for (label, vector, windows), query in zip(queries, turned):
            low = min(max(w[1], w[3].floor) for w in windows)
            high = max(w[2] for w in windows)
            rows = everyone[block.labels != label]
            least, greatest = query.intervals(block.codes, rows)
            rows = rows[(greatest >= low) & (least <= high)]
            scores = block.vectors[rows] @ vector
            order = np.lexsort((block.ids[rows], -scores))
            ids, scores = block.ids[rows][order], scores[order]
            for _, least_score, greatest_score, held in windows:
                first = int(np.searchsorted(-scores, -greatest_score, "left"))
                stop = int(np.searchsorted(-scores, -least_score, "right"))
                stop = min(stop, first + k)
                if stop > first:
                    held.offer(ids[first:stop], scores[first:stop])
    yield _rows("number, id, score", [(n, b.ids, b.scores) for _, _, windows in queries for n, _, _, b in windows])


def _padded(vector: list[int], size: int) -> np.ndarray:
    return np.array([*vector, *[0] * (size - len(vector))], np.int64)


def _rows(names: str, found: list[tuple]) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    columns = (
        np.concatenate([none, *(np.full(len(ids), key) for key, ids, _ in found)]),
        *(np.concatenate([none, *(f[i] for f in found)]) for i in (1, 2)),
    )
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names.split(", "))


def _top(rows: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mined(index: Index, anchors: list, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    plain = [(r["id"], r["label"], list(r["v"])) for r in anchors]
    find = functools.partial(_positives, plain, index.size, positives)
    found = _top(index.rows.mapInArrow(find, "anchor bigint, id bigint, score bigint"), "anchor", positives).collect()
    windows: dict[int, list] = {}
    pairs = []
    for row in found:  # at most ``positives`` rows an anchor
        least, greatest = -(-low * row["score"] // 100), high * row["score"] // 100
        if least <= greatest:
            windows.setdefault(row["anchor"], []).append((len(pairs), least, greatest))
            pairs.append((len(pairs), row["anchor"], row["id"], row["score"]))
    if not pairs:
        return None
    chosen = [(i, label, v, windows[i]) for i, label, v in plain if i in windows]
    find = functools.partial(_negatives, chosen, index.size, negatives)
    best = _top(index.rows.mapInArrow(find, "number bigint, id bigint, score bigint"), "number", negatives)
    named = index.rows.sparkSession.createDataFrame(
        pairs, "number bigint, anchor_id bigint, positive_id bigint, positive_score bigint"
    )
    return best.join(named, "number").select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mine(index: Index, anchors: DataFrame, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor (rows of the index) and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high`` percent of the positive's."""
    anchors = anchors.select("id", "label", "v")
    packs = -(-anchors.count() // _ANCHORS) or 1
    number = F.pmod(F.xxhash64("id"), F.lit(packs))
    out = None
    for i in range(packs):
        found = _mined(index, anchors.where(number == i).collect(), positives, negatives, low, high)
        if found is not None:
            out = found if out is None else out.union(found)
    if out is None:
        return index.rows.sparkSession.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    return out


def hard_negatives(rows: DataFrame) -> DataFrame:
    """The query's form: labels of ids divisible by 7 move on by one of ten, ids divisible by 50 are anchors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    index = build(quantised(rows, label=moved))
    return mine(index, index.rows.where("id % 50 = 0"))


ORACLE = """
with e as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.id as anchor, b.id, a.label = b.label as same,
    cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
  from e a join e b on a.id % 50 = 0 and a.id <> b.id
),
positives as (
  select anchor, id, score from scored where same qualify row_number() over (partition by anchor order by score desc, id) <= 5
),
ranked as (
  select p.anchor, p.id as positive, p.score as high, n.id as negative, n.score as low,
    row_number() over (partition by p.anchor, p.id order by n.score desc, n.id) as place
  from positives p join scored n on p.anchor = n.anchor and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor as anchor_id, positive as positive_id, cast(place as integer) as rank, negative as negative_id,
  high as positive_score, low as negative_score from ranked where place <= 3
"""
