"""Repeated passages by a common-prefix interval tree over an enhanced suffix array.

Texts are their UTF-8 bytes. Every string of ``LENGTH`` bytes has a key: the least hash among its strings of
``_GRAM`` bytes. Equal strings have equal keys, so a repeat can only be among strings of one key, and strings
that follow one another in a text mostly have theirs from the same place: such a run is a spot. Spots whose key
stands nowhere else end there; for the others the run's bytes, a region, go to the task of their key.

Equal regions of a key (by a hash of their bytes) are one string with several places, joined before any text moves.
Over the different regions of a key the task sorts the suffixes whose first ``LENGTH`` bytes recur, measures
the common prefix of neighbours, and scans these with a stack: every interval of suffixes with a common prefix of
``LENGTH`` bytes or more is a node of the interval tree. A node whose occurrences are preceded by different bytes
(or begin a region, where the byte before is another key's matter) can't be extended to the left: a
maximal repeat of these regions. ``repeat_groups`` lists it with the first place of each child, so that each place
comes once and the tree holds all occurrences of every node. A repeat that is longer than a region comes
out as overlapping groups, one per key, each with all occurrences; ``removals`` joins them per text.

A key with more than ``_CROWD`` different regions does not go to one task: each of its strings is a row then,
grouped by two 64-bit hashes of its bytes with pre-aggregation, and every string but the first is a repeat.

Defined results: a text of fewer bytes than ``LENGTH``, empty or null (as empty) keeps all. Rows come in
the order of doc_id, rows without one last, rows that share one by a hash of the text. Rows equal in both are one
document, judged once and returned each. Other texts with the same bytes as an earlier document lose all of
them (if they have ``LENGTH``). An empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.llm import hashing
from botlens.llm.common import arrow_column, row_blocks, saved, text_bytes

LENGTH = 100
_GRAM, _CROWD, _SALTS = 32, 4096, 8
_BLOCK, _REGIONS, _ROWS = 1 << 19, 1 << 19, 1 << 14
_LAST = (1 << 63) - 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[: len(values) - (width - size)], values[width - size :])


def _runs(texts: pa.Array, length: int) -> Iterator[tuple]:
    """For blocks of texts: first row, and row, key, region's hash, first start and number of starts of each run."""
    gram = min(_GRAM, length)
    width = length - gram + 1
    data, offsets = text_bytes(texts)
    for start, stop in row_blocks(offsets, _BLOCK):
        part = data[offsets[start] : offsets[stop]]
        if len(part) < length:
            continue
        bounds = offsets[start : stop + 1] - offsets[start]
        begins = np.arange(len(part) - gram + 1)
        ranges = hashing.Ranges(part)
        hashes = ranges.hash(begins, begins + gram)
        # The place takes the hash's low bits: of equal strings the leftmost counts, whatever else repeats.
        low = np.uint64((1 << len(part).bit_length()) - 1)
        places = (_least((hashes & ~low) | begins.astype(np.uint64), width) & low).astype(np.int64)
        rows = np.searchsorted(bounds, np.arange(len(places)), "right") - 1
        whole = np.arange(len(places)) + length <= bounds[rows + 1]
        first = np.ones(len(places), bool)
        first[1:] = (places[1:] != places[:-1]) | (rows[1:] != rows[:-1])
        at = np.flatnonzero(first & whole)
        if len(at):
            counts = np.add.reduceat(whole.astype(np.int64), at)
            regions = hashing.mix(ranges.hash(at, at + counts + (length - 1)), 3).view(np.int64)
            yield start, rows[at], hashes[places[at]].view(np.int64), regions, at - bounds[rows[at]], counts


def _spots(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, mark, text) to a row per run: key, hash of the region, doc, mark, first start, number of starts, and
    whether an equal region stands earlier in the text."""
    for batch in batches:
        docs, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for first, rows, keys, regions, starts, counts in _runs(batch.column(2), length):
            order = np.lexsort((starts, regions, keys, rows))
            again = np.zeros(len(order), bool)
            again[1:] = np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in (rows, keys, regions, counts)])
            columns = [keys, regions, docs[first + rows], marks[first + rows], starts, counts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[order], pa.int64()) for c in columns), pa.array(again)],
                names=["key", "region", "doc", "mark", "start", "size", "again"],
            )


def _regions(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, mark, text, spots as (key, region, start, size)) to a row per spot with the region's bytes."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        spots = batch.column(3)
        keys, regions, starts, sizes = (spots.flatten().field(i).to_numpy() for i in range(4))
        rows = np.repeat(np.arange(batch.num_rows), spots.value_lengths().to_numpy())
        docs, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for at in range(0, len(rows), 8192):
            part = slice(at, at + 8192)
            begins = offsets[rows[part]] + starts[part]
            raw = [data[b : b + n].tobytes() for b, n in zip(begins.tolist(), (sizes[part] + (length - 1)).tolist())]
            columns = [keys[part], regions[part], docs[rows[part]], marks[rows[part]], starts[part]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(raw, pa.binary())], names=["key", "region", "doc", "mark", "start", "bytes"]
            )


class _Tree:
    """Different regions of some keys, each with its first place, and the interval tree of their suffixes."""

    def __init__(self, length: int):
        self.length, self.size = length, 0
        self.regions: list[tuple[int, int, tuple[int, int, int], bytes]] = []

    def add(self, key: int, region: int, place: tuple[int, int, int], data: bytes) -> None:
        self.regions.append((key, region, place, data))
        self.size += len(data)

    def groups(self) -> Iterator[tuple]:
        """Rows (key, node, length, doc, mark, start, first, region, below) of all maximal repeats."""
        suffixes, common = self._array([data for *_, data in self.regions])
        deep = common >= self.length
        starts = np.flatnonzero(deep & ~np.append(False, deep[:-1])) - 1
        stops = np.flatnonzero(deep & ~np.append(deep[1:], False)) + 1
        nodes = 0
        for at, stop in zip(starts.tolist(), stops.tolist()):
            for row in self._scan(suffixes[at:stop], common[at:stop], nodes):
                yield row
                nodes = max(nodes, row[1] + 1)

    def _array(self, regions: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes (region, offset) in order, where their first bytes recur; common prefix with the one before."""
        data = np.frombuffer(b"".join(regions), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(r) for r in regions]))).astype(np.int64)
        counts = np.diff(bounds) - (self.length - 1)
        rows = np.repeat(np.arange(len(regions)), counts)
        inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        begins = bounds[rows] + inner
        # Suffixes whose first bytes (by hash) stand once have no common prefix to speak of.
        _, same, often = np.unique(hashing.Ranges(data).hash(begins, begins + self.length), return_inverse=True, return_counts=True)
        recurs = often[same] > 1
        rows, inner, begins = rows[recurs], inner[recurs], begins[recurs]
        stops = bounds[rows + 1]
        # Seven bytes to a number, each as 1 to 256; 0 stands after a region's end and so sorts first.
        widest = int((stops - begins).max(initial=0))
        padded = np.concatenate((data, np.zeros(widest + 7, np.uint8)))
        columns = []
        for first in range(0, widest, 7):
            number = np.zeros(len(begins), np.int64)
            for i in range(first, first + 7):
                number = number * 512 + np.where(begins + i < stops, padded[np.minimum(begins + i, len(padded) - 1)].astype(np.int64) + 1, 0)
            columns.append(number)
        order = np.lexsort(columns[::-1]) if columns else np.zeros(0, np.int64)
        common = np.zeros(len(order), np.int64)
        open_ = np.ones(max(len(order) - 1, 0), bool)
        begins, stops = begins[order], stops[order]
        for i in range(widest):
            a, b = begins[:-1] + i, begins[1:] + i
            open_ &= (a < stops[:-1]) & (b < stops[1:]) & (padded[a] == padded[b])
            if not open_.any():
                break
            common[1:] += open_
        return np.stack((rows[order], inner[order]), axis=1), common

    def _scan(self, suffixes: np.ndarray, common: np.ndarray, number: int) -> Iterator[tuple]:
        """Close the intervals of one run of suffixes, inner ones first.

        An open interval holds its prefix length, its children as (first place, region of a leaf, node of a group),
        and the bytes before its occurrences.
        """
        stack: list[list] = []

        def close(interval: list) -> tuple[list[tuple], set]:
            """The interval as children of the next one: its first place, or all it holds if it is no group."""
            nonlocal number
            length, children, before = interval
            if len(before) < 2 and None not in before:
                return children, before
            node, number = number, number + 1
            least = min(place for place, _, _ in children)
            rows.extend((key, node, length, *place, place == least, leaf, below) for place, leaf, below in children)
            return [(least, None, node)], before

        rows: list[tuple] = []
        key = self.regions[suffixes[0][0]][0]
        following = np.append(common[1:], 0)
        for (row, offset), shared in zip(suffixes.tolist(), following.tolist()):
            _, region, (doc, mark, start), data = self.regions[row]
            children, before = [((doc, mark, start + offset), region, None)], {data[offset - 1] if offset else None}
            while True:
                if stack and stack[-1][0] >= shared:
                    stack[-1][1] += children
                    stack[-1][2] |= before
                else:
                    stack.append([shared, children, before])
                if stack[-1][0] <= shared:
                    break
                children, before = close(stack.pop())
                if not stack and shared < self.length:
                    break
        return iter(rows)


_GROUPS = "key bigint, node bigint, length bigint, doc bigint, mark bigint, start bigint, first boolean, region bigint, below bigint"


def _groups(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key (key, region, doc, mark, start, bytes) to the maximal repeats of each key."""
    kinds = [f.split() for f in _GROUPS.split(", ")]

    def written(tree: _Tree) -> Iterator[pa.RecordBatch]:
        rows = tree.groups()
        while part := list(itertools.islice(rows, _ROWS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.bool_() if kind == "boolean" else pa.int64()) for c, (_, kind) in zip(zip(*part), kinds)],
                names=[name for name, _ in kinds],
            )

    tree, last = _Tree(length), None
    for batch in batches:
        keys, regions, docs, marks, starts = (batch.column(i).to_pylist() for i in range(5))
        for key, region, doc, mark, start, data in zip(keys, regions, docs, marks, starts, batch.column(5)):
            if key != last and tree.size > _REGIONS:
                yield from written(tree)
                tree = _Tree(length)
            tree.add(key, region, (doc, mark, start), data.as_py())
            last = key
    yield from written(tree)


def _windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, region, doc, mark, start, bytes) to a row per string: two hashes, doc, mark, start."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(5))
        for first, stop in row_blocks(offsets, _BLOCK // 4):
            part, bounds = data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
            counts = np.diff(bounds) - (length - 1)
            rows = np.repeat(np.arange(stop - first), counts)
            inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            begins = bounds[rows] + inner
            docs, marks, starts = (batch.column(i).to_numpy()[first + rows] for i in (2, 3, 4))
            hashes = [hashing.Ranges(part, salt).hash(begins, begins + length).view(np.int64) for salt in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (*hashes, docs, marks, starts + inner)], names=["one", "two", "doc", "mark", "start"]
            )


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_column).cast("bigint"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _bytes_of(texts: DataFrame, regions: DataFrame, length: int) -> DataFrame:
    """key, region, doc, mark, start, bytes of regions (key, region, size, doc, mark, start)."""
    wanted = regions.groupBy("doc", "mark").agg(F.collect_list(F.struct("key", "region", "start", "size")).alias("spots"))
    whole = texts.groupBy("doc", "mark").agg(F.first("text").alias("text"))
    rows = whole.join(wanted, ["doc", "mark"]).select("doc", "mark", "text", "spots")
    kind = "key bigint, region bigint, doc bigint, mark bigint, start bigint, bytes binary"
    return rows.mapInArrow(functools.partial(_regions, length), kind)


def _first_marked(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows of groups of two and more places, with ``first`` for the least place (doc, mark, start).

    Firsts are found with pre-aggregation and met in ``_SALTS`` pieces a group.
    """
    at = F.struct("doc", "mark", "start")
    firsts = rows.groupBy(group).agg(F.min(at).alias("least"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(*group, "least", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc", "start"), F.lit(_SALTS)).cast("int"))
    return salted.join(firsts, [*group, "salt"]).withColumn("first", at == F.col("least"))


def _groups_of(texts: DataFrame, length: int) -> DataFrame:
    """All groups, in the columns of ``_GROUPS``."""
    none = F.lit(None).cast("bigint")
    kind = "key bigint, region bigint, doc bigint, mark bigint, start bigint, size bigint, again boolean"
    runs = texts.mapInArrow(functools.partial(_spots, length), kind)
    # An equal region further on in the same text is a repeat whatever other texts hold: it keeps to itself.
    spots = runs.withColumn("key", F.when(F.col("again"), F.xxhash64("key", "mark", "start")).otherwise(F.col("key")))
    place = F.xxhash64("mark", "start")  # the same place in copies of a text is one
    shared = runs.where("not again").select("key", place.alias("p")).groupBy("key")
    shared = shared.agg(F.min("p").alias("a"), F.max("p").alias("b")).where("a <> b").select("key", F.lit(True).alias("shared"))
    kept = spots.join(shared, "key", "left").where("again or shared").groupBy("key", "region", "size", "mark", "start", "again")
    kept = saved(kept.agg(F.min("doc").alias("doc")))
    own = kept.where("again").select(
        "key", F.col("region").alias("node"), (F.col("size") + length - 1).alias("length"), "doc", "mark", "start",
        F.lit(False).alias("first"), none.alias("region"), none.alias("below"),
    )
    places = kept.where("not again")
    equal = _first_marked(places, ["key", "region", "size"]).select(
        "key", F.col("region").alias("node"), (F.col("size") + length - 1).alias("length"), "doc", "mark", "start",
        "first", none.alias("region"), none.alias("below"),
    )
    different = places.groupBy("key", "region", "size").agg(F.min(F.struct("doc", "mark", "start")).alias("at"))
    different = saved(different.select("key", "region", "size", "at.*"))
    counts = different.groupBy("key").count().where("count > 1")
    plain = different.join(counts.where(F.col("count") <= _CROWD).select("key"), "key", "left_semi")
    by_key = _bytes_of(texts, plain, length).repartition("key").sortWithinPartitions("key")
    groups = own.union(equal).union(by_key.mapInArrow(functools.partial(_groups, length), _GROUPS))
    crowded = saved(counts.where(F.col("count") > _CROWD).select("key"))
    if crowded.isEmpty():
        return groups
    many = _bytes_of(texts, different.join(crowded, "key", "left_semi"), length)
    windows = many.mapInArrow(functools.partial(_windows, length), "one bigint, two bigint, doc bigint, mark bigint, start bigint")
    return groups.union(_first_marked(windows, ["one", "two"]).select(
        F.col("one").alias("key"), F.col("two").alias("node"), F.lit(length).cast("bigint").alias("length"), "doc", "mark", "start",
        "first", none.alias("region"), none.alias("below"),
    ))


def repeat_groups(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Maximal repeats of ``length`` bytes or more as an interval tree.

    key and node name a group; its string has ``length`` bytes and stands at ``start`` of the document (doc_id, or null,
    and the text's hash ``mark``); ``first`` marks its first place. A row stands for one place, or with ``region`` for
    all places of the group (key, node = region) of equal regions at the same offset, or with ``below`` for all those of
    the group (key, below). A region that comes again within its text is a row of its own, without its first place.
    Copies of a text are not listed, only their first document.
    """
    rows = _groups_of(_texts(docs, id_column, text_column), length)
    return rows.select("key", "node", "length", F.expr(f"nullif(doc, {_LAST})").alias("doc_id"), "mark", "start", "first", "region", "below")


def _cut(texts: list, spans: list) -> list:
    """What is left of each text without its spans (start, length)."""
    out = []
    for text, held in zip(texts, spans):
        data, kept, at, removed, runs = text.encode(), [], 0, 0, 0
        stop = -1
        for start, size in sorted((s["start"], s["length"]) for s in held):
            if start > stop:
                runs += 1
                kept.append(data[at:start])
                stop = start
            if start + size > stop:
                removed += start + size - stop
                at = stop = start + size
        kept.append(data[at:])
        out.append({"n_removed": removed, "n_spans": runs, "kept": hashlib.sha256(b"".join(kept)).hexdigest()})
    return out


def removals(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, when every byte goes that a string of
    ``length`` bytes covers which also starts earlier."""
    texts = _texts(docs, id_column, text_column)
    spans = _groups_of(texts, length).where("not first").groupBy("doc", "mark")
    spans = spans.agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    whole = texts.groupBy("doc", "mark").agg(F.first("text").alias("text")).join(spans, ["doc", "mark"])
    kind = "struct<n_removed: bigint, n_spans: bigint, kept: string>"
    cuts = whole.select("doc", "mark", arrow_column(_cut, kind)(F.col("text"), F.col("spans")).alias("cut"))
    rows = texts.select("doc", "mark", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    # Texts that stand more than once; a text of a third of all rows is met in pieces.
    again = rows.groupBy("sha").agg(F.min("doc").alias("earliest"), F.count("*").alias("n")).where("n > 1")
    again = again.select("sha", "earliest", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(_SALTS)).cast("int"))
    met = salted.join(again, ["sha", "salt"], "left").join(cuts, ["doc", "mark"], "left")
    copy = F.coalesce((F.col("doc") > F.col("earliest")) & (F.col("n_bytes") >= length), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    return met.select(
        F.expr(f"nullif(doc, {_LAST})").alias("doc_id"), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("cut.n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("cut.n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("cut.kept", "sha")).alias("kept_sha256"),
    )
