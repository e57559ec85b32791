"""Ranked lexical search over a length-stratified index.

A term is a maximal run of characters other than ASCII that is no letter or digit, A-Z lower-cased.
With N documents that have terms, L terms in all of them, n in one document, df documents with a term
and tf places of it in one document, a document scores for a query the sum, over the query's terms, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``
and ``m = 10 + (90 * n * N) div L``: integers throughout.

``build`` groups documents of equal m (a stratum) and cuts strata into blocks of at most ``_DOCS``
documents; a block holds its postings by term and, within a term, by falling tf, so an impact is computed
once per term and tf of a block, and the first tf of every term bounds what a query can score there.
``search`` visits, for each query, the blocks by falling bound and leaves out those that cannot reach the
query's best k so far. A first round over each task's best-bounded block gives all tasks a common threshold.

Rows move by range over (hash of m, hash of the document), so a stratum that holds a third of all documents
is cut over many tasks. Queries go to the tasks in packs of about ``_PACK`` terms, a single longer one alone;
each pack passes over the index once per round. Scores leave a task as at most k rows a query.

Defined results: null and empty texts have no terms; they neither count in N nor are found. Rows without
doc_id take no part; rows that share a doc_id are documents of their own and may both be listed. Query rows
that share an id (or have none) are one query with the terms of all of them. Queries without a term, or whose
terms no document has, give no row. Equal scores come by ascending doc_id. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from botlens.llm import hashing
from botlens.llm.common import row_blocks, saved, text_bytes

_BLOCK = 1 << 19
_DOCS, _BYTES, _PACK, _SAMPLE = 1024, 4 << 20, 200_000, 4096
#: Index rows that a task looks at together.
_VISITED = 128
_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _counted(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """For blocks of texts: number of terms per text, distinct terms, how many per text, and their tf."""
    data, offsets = text_bytes(texts)
    for start, stop in row_blocks(offsets, _BLOCK):
        part = hashing.LOWER_TABLE[data[offsets[start] : offsets[stop]]]
        bounds = offsets[start : stop + 1] - offsets[start]
        mask = _TERM[part]
        begins, ends = hashing.edges(mask, bounds)
        terms = _strings(part[mask], ends - begins).dictionary_encode()
        size = max(len(terms.dictionary), 1)
        rows = np.searchsorted(bounds, begins, "right") - 1
        pairs, tfs = np.unique(rows * size + terms.indices.to_numpy(), return_counts=True)
        rows_of = pairs // size
        yield (
            np.bincount(rows, minlength=stop - start), terms.dictionary.take(pa.array(pairs % size)),
            np.bincount(rows_of, minlength=stop - start), tfs,
        )


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n, the distinct terms joined by spaces, and their tf as 32-bit numbers."""
    for batch in batches:
        at = 0
        for sizes, terms, counts, tfs in _counted(batch.column(1)):
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            words = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), terms), " ")
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), len(counts), [None, pa.py_buffer(ends * np.int32(4)), pa.py_buffer(tfs.astype(np.int32))]
            )
            ids = batch.column(0).slice(at, len(sizes)).cast(pa.int64())
            at += len(sizes)
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), words, packed], names=["id", "n", "words", "tfs"])


def _terms(rows: DataFrame, id_column: str, text_column: str) -> DataFrame:
    plain = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    return plain.mapInArrow(_vectors, "id bigint, n bigint, words string, tfs binary").where("n > 0")


_INDEX = (
    "m bigint, ids array<bigint>, terms array<string>, dfs array<int>, groups array<int>,"
    " tfs array<int>, sizes array<int>, docs array<int>"
)


def _block(m: int, ids: list[pa.Array], words: list[pa.Array], tfs: list[bytes]) -> list:
    """One index row: ``groups`` counts the tf groups of each term, ``sizes`` the documents of each group."""
    lists = pc.split_pattern(pa.chunked_array(words).combine_chunks(), " ")
    terms = lists.flatten().dictionary_encode()
    codes = terms.indices.to_numpy()
    places = np.repeat(np.arange(len(lists), dtype=np.int32), pc.list_value_length(lists).to_numpy())
    tf = np.frombuffer(b"".join(tfs), np.int32)
    order = np.lexsort((places, -tf, codes))
    codes, tf, places = codes[order], tf[order], places[order]
    other = np.ones(len(codes), bool)
    other[1:] = (codes[1:] != codes[:-1]) | (tf[1:] != tf[:-1])
    starts = np.flatnonzero(other)
    size = len(terms.dictionary)
    return [
        m, pa.chunked_array(ids).combine_chunks(), terms.dictionary, np.bincount(codes, minlength=size),
        np.bincount(codes[starts], minlength=size), tf[starts], np.diff(np.append(starts, len(codes))), places,
    ]


def _row(block: list) -> pa.RecordBatch:
    kinds = [None, pa.int64(), pa.string(), *[pa.int32()] * 5]
    columns = [pa.array([block[0]], pa.int64())]
    for values, kind in zip(block[1:], kinds[1:]):
        flat = values if isinstance(values, pa.Array) else pa.array(values.astype(np.int32))
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat.cast(kind)))
    return pa.RecordBatch.from_arrays(columns, names=["m", "ids", "terms", "dfs", "groups", "tfs", "sizes", "docs"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (id, m, words, tfs) to index rows; a block ends with its stratum or when it is full."""
    m, ids, words, tfs, docs, size = None, [], [], [], 0, 0
    for batch in batches:
        strata = batch.column(1).to_numpy()
        bytes_at = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))))
        at = 0
        while at < len(strata):
            if ids and (strata[at] != m or docs >= _DOCS or size >= _BYTES):
                yield _row(_block(m, ids, words, tfs))
                ids, words, tfs, docs, size = [], [], [], 0, 0
            m = int(strata[at])
            same = strata[at : at + _DOCS - docs] != m
            stop = at + (int(same.argmax()) if same.any() else len(same))
            stop = min(stop, max(at + 1, int(np.searchsorted(bytes_at, bytes_at[at] + _BYTES - size, "right")) - 1))
            ids.append(batch.column(0).slice(at, stop - at))
            words.append(batch.column(2).slice(at, stop - at))
            tfs += batch.column(3).slice(at, stop - at).to_pylist()
            docs, size = docs + stop - at, size + int(bytes_at[stop] - bytes_at[at])
            at = stop
    if ids:
        yield _row(_block(m, ids, words, tfs))


class Index:
    """Blocks of a corpus as a table, with N (``documents``) and L (``places``)."""

    def __init__(self, blocks: DataFrame, documents: int, places: int):
        self.blocks, self.documents, self.places = blocks, documents, places


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The index of all documents, saved in the shared folder."""
    vectors = saved(_terms(docs.where(F.col(id_column).isNotNull()), id_column, text_column))
    documents, places = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    m = F.expr(f"10 + (90 * n * {documents}) div {places}")
    # Strata in the order of a hash, so that long documents are spread; a large stratum is cut by its documents.
    spread = [F.xxhash64("m"), F.xxhash64("id", "words")]
    rows = vectors.select("id", m.alias("m"), "words", "tfs").repartitionByRange(*spread).sortWithinPartitions(*spread)
    return Index(saved(rows.mapInArrow(_blocks, _INDEX)), documents, places)


class Pack:
    """Some queries: vocabulary, the terms of each query as numbers one after another, and weights."""

    def __init__(self, rows: list):
        terms: dict[object, set[str]] = {}
        for row in rows:
            terms.setdefault(row["id"], set()).update(row["words"].split(" "))
        self.ids = list(terms)
        self.words = sorted(set().union(*terms.values())) if terms else []
        numbers = {w: k for k, w in enumerate(self.words)}
        lists = [sorted(numbers[w] for w in t) for t in terms.values()]
        self.flat = np.array([k for t in lists for k in t], np.int64)
        self.ends = np.cumsum([0, *map(len, lists)])
        self.weights = np.zeros(len(self.words), np.int64)

    def weigh(self, documents: int, found: dict[int, int]) -> None:
        for k, df in found.items():
            self.weights[k] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))

    def _codes(self, terms: pa.Array) -> np.ndarray:
        codes = pc.index_in(terms, value_set=pa.array(self.words, pa.string()))
        return codes.fill_null(-1).to_numpy(zero_copy_only=False)

    def frequencies(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that hold each term of the pack, over blocks of (terms, dfs)."""
        total = np.zeros(len(self.words), np.int64)
        for batch in batches:
            codes = self._codes(batch.column(0).flatten())
            there = codes >= 0
            np.add.at(total, codes[there], batch.column(1).flatten().to_numpy()[there])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    def search(self, k: int, floors: np.ndarray, lead: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best k documents of each query in these blocks, without those below the query's floor.

        With ``lead`` each query visits only the best-bounded of every ``_VISITED`` blocks.
        """
        best = _Best(k, floors)
        for batch in batches:
            for at in range(0, batch.num_rows, _VISITED):
                self._visit_all(_Blocks(batch.slice(at, _VISITED), self), best, lead)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in best.rows()], names=["query", "doc_id", "score"])

    def _visit_all(self, blocks: _Blocks, best: _Best, lead: bool) -> None:
        bounds = np.array([np.add.reduceat(blocks.bound(b)[self.flat], self.ends[:-1]) for b in range(len(blocks))])
        first = bounds.argmax(axis=0)
        for b in np.argsort(-bounds.max(axis=1), kind="stable").tolist():
            queries = np.flatnonzero((bounds[b] >= best.floors) & ((first == b) if lead else True))
            if len(queries):
                blocks.open(b)
                for q in queries.tolist():
                    terms = self.flat[self.ends[q] : self.ends[q + 1]]
                    best.offer(q, blocks.ids, blocks.scores(terms, int(bounds[b, q])))


class _Blocks:
    """The blocks of one Arrow batch, seen through a pack's vocabulary."""

    def __init__(self, batch: pa.RecordBatch, pack: Pack):
        self.m = batch.column(0).to_numpy()
        arrays = [batch.column(i) for i in range(1, 8)]
        flat = [a.flatten() for a in arrays]
        ends = [np.concatenate(([0], np.cumsum(pc.list_value_length(a).to_numpy()))) for a in arrays]
        self.all_ids, self.id_ends = flat[0].to_numpy(), ends[0]
        self.codes, self.term_ends = pack._codes(flat[1]), ends[1]
        group_ends = np.concatenate(([0], np.cumsum(flat[3].to_numpy())))
        self.group_start, self.group_stop = group_ends[:-1], group_ends[1:]
        self.tfs, sizes = flat[4].to_numpy().astype(np.int64), flat[5].to_numpy()
        self.post_ends = np.concatenate(([0], np.cumsum(sizes)))
        self.docs = flat[6].to_numpy()
        self.weights = pack.weights
        self.place = np.full(len(pack.words), -1, np.int64)

    def __len__(self) -> int:
        return len(self.m)

    def _known(self, b: int) -> np.ndarray:
        first = self.term_ends[b]
        return first + np.flatnonzero(self.codes[first : self.term_ends[b + 1]] >= 0)

    def _impact(self, b: int, codes: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        return self.weights[codes] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * self.m[b]))

    def bound(self, b: int) -> np.ndarray:
        """The most that each term of the vocabulary can give in block b: its first tf is the largest."""
        out = np.zeros(len(self.place), np.int64)
        known = self._known(b)
        out[self.codes[known]] = self._impact(b, self.codes[known], self.tfs[self.group_start[known]])
        return out

    def open(self, b: int) -> None:
        """Impacts of block b, once per term and tf."""
        self.ids = self.all_ids[self.id_ends[b] : self.id_ends[b + 1]]
        known = self._known(b)
        self.place[:] = -1
        self.place[self.codes[known]] = np.arange(len(known))
        counts = self.group_stop[known] - self.group_start[known]
        groups = _ranges(self.group_start[known], counts)
        impacts = self._impact(b, np.repeat(self.codes[known], counts), self.tfs[groups])
        sizes = self.post_ends[groups + 1] - self.post_ends[groups]
        self.posted = np.repeat(impacts, sizes)
        self.posted_docs = self.docs[_ranges(self.post_ends[groups], sizes)]
        lengths = self.post_ends[self.group_stop[known]] - self.post_ends[self.group_start[known]]
        self.lists = np.concatenate(([0], np.cumsum(lengths)))

    def scores(self, terms: np.ndarray, bound: int) -> np.ndarray:
        at = self.place[terms]
        at = at[at >= 0]
        picked = _ranges(self.lists[at], self.lists[at + 1] - self.lists[at])
        docs, impacts = self.posted_docs[picked], self.posted[picked]
        if bound < 1 << 53:  # sums of doubles are exact
            return np.bincount(docs, impacts, minlength=len(self.ids)).astype(np.int64)
        out = np.zeros(len(self.ids), np.int64)
        np.add.at(out, docs, impacts)
        return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


class _Best:
    """The best k documents of each query so far; ``floors`` rise with the k-th score."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def offer(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.floors[query])
        if not len(good):
            return
        ids, scores = ids[good], scores[good]
        if query in self.held:
            ids, scores = np.concatenate((self.held[query][0], ids)), np.concatenate((self.held[query][1], scores))
        order = np.lexsort((ids, -scores))[: self.k]
        self.held[query] = ids[order], scores[order]
        if len(order) == self.k:
            self.floors[query] = scores[order[-1]]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        queries = [np.full(len(ids), q) for q, (ids, _) in self.held.items()]
        ids, scores = ([pair[i] for pair in self.held.values()] for i in (0, 1))
        return tuple(np.concatenate([none, *parts]) for parts in (queries, ids, scores))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(index: Index, pack: Pack, k: int) -> DataFrame:
    kind = "query bigint, doc_id bigint, score bigint"
    dfs = index.blocks.select("terms", "dfs").mapInArrow(pack.frequencies, "term bigint, df bigint")
    # One row for a term of the pack at most.
    pack.weigh(index.documents, {r["term"]: r["df"] for r in dfs.groupBy("term").agg(F.sum("df").alias("df")).collect()})
    floors = np.ones(len(pack.ids), np.int64)
    # Any blocks give a threshold that holds: about _SAMPLE of them do.
    share = min(1.0, _SAMPLE / max(index.documents / _DOCS, 1))
    some = index.blocks.where(F.pmod(F.xxhash64("m", F.get("ids", F.lit(0))), F.lit(1 << 62)) <= int(share * (1 << 62)))
    first = some.mapInArrow(functools.partial(pack.search, k, floors, True), kind)
    for row in _ranked(first, k).where(F.col("rank") == k).select("query", "score").collect():
        floors[row["query"]] = row["score"]
    found = index.blocks.mapInArrow(functools.partial(pack.search, k, floors, False), kind)
    names = found.sparkSession.createDataFrame(list(enumerate(pack.ids)), "query bigint, item_id bigint")
    return _ranked(found, k).join(names, "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def search(index: Index, items: DataFrame, k: int = 10, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents with a score above 0 of each item."""
    queries = saved(_terms(items, id_column, text_column).select("id", "words", F.size(F.split("words", " ")).alias("n")))
    total = queries.agg(F.sum("n")).first()[0] or 0
    packs = -(-total // _PACK) or 1
    number = F.pmod(F.xxhash64("id"), F.lit(packs))
    out = None
    for i in range(packs):
        pack = Pack(queries.where(number == i).select("id", "words").distinct().collect())
        if pack.ids:
            found = _searched(index, pack, k)
            out = found if out is None else out.union(found)
    if out is None:
        return items.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return out


ORACLE = r"""
with d as (
  select row_number() over () as id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents where doc_id is not null
),
sized as (select id, doc_id, w, len(w) as n from d where len(w) > 0),
totals as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as places from sized),
tf as (select id, doc_id, n, term, count(*) as tf from (select id, doc_id, n, unnest(w) as term from sized) group by all),
df as (select term, count(*) as df from tf group by term),
q as (
  select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
),
weighed as (select item_id, term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from q join df using (term), totals),
scored as (
  select item_id, id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // places)))) as bigint) as score
  from weighed join tf using (term), totals group by item_id, id, doc_id
),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scored where score > 0
)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 10
"""
