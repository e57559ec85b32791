"""Links and components of similar sets from the band keys of their signatures.

Two sets are candidates if they share a band key. Pairs within a bucket are never all written out:

1. in every bucket the node of the lowest rank leads; each node is compared with the leader that it
   shares most buckets with, one pair a node;
2. components of these links are numbered, and buckets that hold one component only are done;
3. in the others, members of different components are compared. Buckets in which more pairs are apart
   than ``many`` single members have are split by shingles, which is exact: nodes that such buckets
   connect are a crowd, shingles are ordered, rare ones first, and of two sets of the wanted similarity
   the first common shingle is within both sets' prefixes (all but the needed overlap less one), where
   sizes and places leave room for the overlap. Each node of a crowd is indexed once.

Pairs that share a bucket end up compared, excluded by their sets, or in one component, so no link
between components is lost, while a bucket of near copies costs a row a member. A sketch of single signature bits, where there is
one, drops hopeless pairs before the exact check.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import discard, saved, text_bytes
from botlens.llm.components import components

Check = Callable[[Column, Column], Column]
#: Sorted distinct shingles of each row of a column.
Shingles = Callable[[pa.Array], list[np.ndarray]]
#: Shingles are counted in so many slots by their lowest bits; any counts give a valid order.
_SLOTS = 1 << 18
#: Rows whose keys are dealt out together, slots to a shuffle partition, members of a bucket that are compared one step
#: after the other, and pairs of a larger one that are compared at once.
_ROWS_DEALT, _SLOTS_EACH, _COMPARED, _AT_ONCE = 1 << 16, 4, 64, 1 << 16
#: Numbers of 64 bits in which the sets of a bucket are held, and members of a bucket that is not worth it.
_BITS_HELD, _FEW = 1 << 20, 8


def size_steps(sizes: np.ndarray) -> np.ndarray:
    """Four steps of a set's size for each doubling."""
    return np.minimum(4 * np.log2(sizes), 63).astype(np.int8)


def _steps_apart(percent: int) -> int:
    """Steps that sizes of two sets of that similarity can differ by."""
    return math.ceil(4 * math.log2(100 / percent))


def packed_keys(keys: np.ndarray) -> np.ndarray:
    """The low 40 bits of each key, a row of bytes for each row of keys."""
    low = keys.astype("<i8").view(np.uint8).reshape(*keys.shape, 8)[:, :, :5]
    return np.ascontiguousarray(low).reshape(len(keys), 5 * keys.shape[1])


def packed(rows: np.ndarray, filled: np.ndarray | None = None) -> pa.Array:
    """Rows of an array as binary values; with ``filled``, they go to its true places and the others are empty."""
    at = np.arange(len(rows) + 1) if filled is None else np.concatenate(([0], np.cumsum(filled)))
    rows = np.ascontiguousarray(rows)
    wide = rows[:1].nbytes
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * wide).astype(np.int32)), pa.py_buffer(rows)])


def _dealt(slots: int, words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nodes, size steps, sketches and packed keys of many rows as one row for each slot, so that few rows are shuffled."""

    def dealt(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        nodes, steps, bits, keys = (np.concatenate(x) for x in zip(*held))
        # A set has an entry for each kind of sketch that it has; kinds have slots of their own.
        there = bits.any(axis=2)
        row, kind = np.nonzero(there)
        count = keys.shape[1]
        parts = keys[row].reshape(-1, 5)
        heads = np.zeros((len(parts), 4), np.uint8)
        heads[:, 1:] = parts[:, :3]
        heads[:, 0] = np.repeat(steps[row], count)
        slot = np.ascontiguousarray(parts[:, 3:]).view("<u2").ravel() + np.repeat(kind * 0x5A5B, count).astype(np.uint16)
        slot %= np.uint16(slots)
        order = np.argsort(slot, kind="stable")
        of = order // count
        counts = np.bincount(slot, minlength=slots)
        filled = np.flatnonzero(counts)
        at = np.concatenate(([0], np.cumsum(counts[filled])))
        columns = []
        for values in (heads[order], nodes[row][of], bits[row, kind][of]):
            wide = values[:1].nbytes
            columns.append(pa.Array.from_buffers(pa.binary(), len(filled), [None, pa.py_buffer((at * wide).astype(np.int32)), pa.py_buffer(values)]))
        return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), *columns], names=["slot", "heads", "nodes", "sketches"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not len(batch):
                continue
            bits = text_bytes(batch.column(2))[0].copy().view(np.uint64).reshape(len(batch), 2, words)
            keys = text_bytes(batch.column(3))[0].reshape(len(batch), -1, 5).copy()
            held.append((batch.column(0).to_numpy().copy(), batch.column(1).to_numpy().astype(np.uint8), bits, keys))
            rows += len(batch)
            if rows >= _ROWS_DEALT:
                yield dealt(held)
                held, rows = [], 0
        if held:
            yield dealt(held)

    return deal


def _most_apart(words: int, percent: int) -> int:
    """Bits of two sketches that differ at most: seven deviations more than the mean of pairs at so many percent."""
    share = (100 - percent) / 200
    return math.ceil(64 * words * share + 7 * math.sqrt(64 * words * share * (1 - share)))


def _beside(heads: np.ndarray, most: int) -> np.ndarray:
    """In order of key and size, whether a near size of the same key stands next to an entry."""
    near = (heads[1:] >> 8 == heads[:-1] >> 8) & (heads[1:] - heads[:-1] <= most)
    return (np.append(False, near) | np.append(near, False))[: len(heads)]


def _few_apart(x: np.ndarray, y: np.ndarray, apart: int) -> np.ndarray:
    """Whether sketches, of words on the last axis, are that near."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32) <= apart


def _with_partner(heads: np.ndarray, bits: np.ndarray, apart: int, most: int) -> np.ndarray:
    """Which entries have another one of the same key near by size and sketch; entries are in order of key and size."""
    count = len(heads)
    start = np.flatnonzero(np.append(True, heads[1:] >> 8 != heads[:-1] >> 8)) if count else np.zeros(0, int)
    size = np.diff(np.append(start, count))
    left = np.repeat(start + size, size) - np.arange(count)
    kept, open_at = np.zeros(count, bool), np.arange(count)
    for step in range(1, _COMPARED):
        open_at = open_at[left[open_at] > step]
        open_at = open_at[heads[open_at + step] - heads[open_at] <= most]
        if not len(open_at):
            break
        asked = open_at[~(kept[open_at] & kept[open_at + step])]
        near = asked[_few_apart(bits[asked], bits[asked + step], apart)]
        kept[near] = kept[near + step] = True
    # In larger buckets the ones without a partner so far meet all that are near in size.
    for a, b in zip(start[size > _COMPARED].tolist(), (start + size)[size > _COMPARED].tolist()):
        alone, at = a + np.flatnonzero(~kept[a:b]), 0
        while at < len(alone):
            some = alone[at : at + max(1, _AT_ONCE // (b - a))]
            at += len(some)
            low = a + np.searchsorted(heads[a:b], heads[some[0]] - most)
            high = a + np.searchsorted(heads[a:b], heads[some[-1]] + most, "right")
            near = _few_apart(bits[some, None], bits[None, low:high], apart)
            near[np.arange(len(some)), some - low] = False
            kept[some] |= near.any(axis=1)
            kept[low:high] |= near.any(axis=0)
    return kept


def _partnered(part: int, words: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Keys of a slot and their nodes that have a likely partner there."""
    apart, most = _most_apart(words, percent), _steps_apart(percent)

    def run(group: pa.Table) -> pa.Table:
        slot = group.column("slot")[0].as_py()
        heads, nodes, bits = (
            text_bytes(group.column(c))[0].view(kind) for c, kind in (("heads", "<u4"), ("nodes", "<i8"), ("sketches", "<u8"))
        )
        # By key and size; nearly all keys are those of one node alone.
        both = np.sort(heads.astype(np.uint64) << np.uint64(32) | np.arange(len(heads), dtype=np.uint64))
        heads = (both >> np.uint64(32)).astype(np.int64)
        kept = _beside(heads, most)
        heads, order = heads[kept], both[kept].astype(np.uint32)
        # A node that several tasks signed counts once.
        order = order[np.lexsort((nodes[order], heads))]
        first = np.append(True, (heads[1:] != heads[:-1]) | (nodes[order[1:]] != nodes[order[:-1]]))[: len(heads)]
        heads, order = heads[first], order[first]
        kept = _beside(heads, most)
        heads, order = heads[kept], order[kept]
        kept = _with_partner(heads, bits.reshape(-1, words)[order], apart, most)
        key = heads[kept] >> 8 | slot << 24 | part << 40
        return pa.table({"key": pa.array(key, pa.int64()), "node": pa.array(nodes[order[kept]], pa.int64())})

    return run


def bucket_members(signed: DataFrame, parts: int, words: int, percent: int) -> list[DataFrame]:
    """Saved tables of ``key, node`` of buckets, for nodes that another node of the bucket can be similar to, by size and sketch.

    ``signed`` has node, step, sketch (both kinds of :func:`hashing.sketches`) and ``keys_0`` to ``keys_{parts - 1}``, the
    packed keys of as many groups of bands; a node may come more than once. Groups are dealt out one after the other, in one
    exchange each that ends with the saved members: an entry is 3 bytes of the key, whose slot is known, the size, the node
    and its sketch, so members without a likely partner never leave their slot, and the disk holds one group's entries at a
    time, however many nodes share a key by chance. Keys that differ in what is left out meet, which only adds comparisons.
    """
    slots = min(_SLOTS_EACH * int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 14)
    found = []
    for part in range(parts):
        dealt = signed.select("node", "step", "sketch", f"keys_{part}").mapInArrow(
            _dealt(slots, words), "slot int, heads binary, nodes binary, sketches binary"
        )
        found.append(saved(dealt.groupBy("slot").applyInArrow(_partnered(part, words, percent), "key bigint, node bigint")))
    return found


def _counted(found: np.ndarray, ends: np.ndarray, members: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray] | None:
    """A function that counts what pairs of members have in common, for two arrays of their places; set i is
    ``found[ends[i]:ends[i + 1]]``, numbers below 2 ** 32. None if their bits would be too many to hold."""
    own = np.concatenate([found[ends[i] : ends[i + 1]] for i in members.tolist()])
    both = own << np.uint64(32) | np.repeat(np.arange(len(members), dtype=np.uint64), ends[members + 1] - ends[members])
    both.sort()
    number = both >> np.uint64(32)
    begins = np.append(True, number[1:] != number[:-1])
    column = np.cumsum(begins) - 1
    # What one set alone has is in no pair.
    shared = np.bincount(column)[column] > 1
    row, column = both[shared].astype(np.uint32), np.cumsum(begins[shared]) - 1
    words = (int(column[-1]) >> 6) + 1 if len(column) else 1
    if len(members) * words > _BITS_HELD:
        return None
    held = np.zeros((len(members), 64 * words), bool)
    held[row, column] = True
    bits = np.packbits(held, axis=1).view(np.uint64)

    def count(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        step = max(1, _AT_ONCE * 8 // words)
        parts = [np.bitwise_count(bits[x[i : i + step]] & bits[y[i : i + step]]).sum(axis=1, dtype=np.int64) for i in range(0, len(x), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    return count


def _met(found: np.ndarray, ends: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the sets x and y of each pair have in common, without bits."""
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(x), 1 << 11):
        some = np.stack((x[at : at + (1 << 11)], y[at : at + (1 << 11)]), axis=1).ravel()
        own = np.concatenate([found[ends[i] : ends[i + 1]] for i in some.tolist()])
        pair = np.repeat(np.arange(len(some), dtype=np.uint64) >> np.uint64(1), ends[some + 1] - ends[some])
        both = np.sort(pair << np.uint64(32) | own)
        twice = both[1:][both[1:] == both[:-1]] >> np.uint64(32)
        out.append(np.bincount(twice.astype(np.int64), minlength=len(some) // 2))
    return np.concatenate(out)


def _across(shingles: Shingles, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between different components of the buckets of a slot: similar pairs, one for each two components of a bucket."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        # The set of a node is made once, whatever buckets of the slot it is in.
        node, first, place = np.unique(group.column("node").to_numpy(), return_index=True, return_inverse=True)
        sets = shingles(group.column("held").take(pa.array(first)))
        size = np.array([len(x) for x in sets], np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        found = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.uint64)
        component = group.column("component").to_numpy()[first]
        keys = group.column("keys").combine_chunks()
        place = np.repeat(place, keys.value_lengths().to_numpy(zero_copy_only=False))
        key = keys.flatten().to_numpy()
        order = np.lexsort((node[place], size[place], key))
        key, place = key[order], place[order]
        stops = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        # Bands in which the same nodes meet are one bucket.
        buckets = {place[a:b].tobytes(): (a, b) for a, b in zip(np.append(0, stops[:-1]).tolist(), stops.tolist())}
        links, few = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]

        def alike(x: np.ndarray, y: np.ndarray, both: np.ndarray) -> None:
            similar = 100 * both >= percent * (size[x] + size[y] - both)
            x, y = x[similar], y[similar]
            least, most = np.minimum(component[x], component[y]), np.maximum(component[x], component[y])
            one = np.unique(np.stack((least, most)), axis=1, return_index=True)[1]
            links.append(node[np.stack((x[one], y[one]))])

        for a, b in buckets.values():
            members = place[a:b]
            sizes = size[members]
            different, which, counts = np.unique(component[members], return_inverse=True, return_counts=True)
            # Those outside of the largest component meet all others that are near in size; two outside ones meet once.
            outside = which != counts.argmax()
            others, at, common = np.flatnonzero(outside), 0, None
            while at < len(others):
                some = others[at : at + max(1, _AT_ONCE // (b - a))]
                at += len(some)
                low = np.searchsorted(sizes, -(-percent * sizes[some[0]] // 100))
                high = np.searchsorted(sizes, 100 * sizes[some[-1]] // percent, "right")
                x, y = np.repeat(some, high - low), np.tile(np.arange(low, high), len(some))
                meet = (which[x] != which[y]) & (~outside[y] | (x < y))
                x, y = x[meet], y[meet]
                if b - a <= _FEW:
                    few.append(members[np.stack((x, y))])
                    continue
                if common is None:
                    common = _counted(found, ends, members) or (lambda x, y, members=members: _met(found, ends, members[x], members[y]))
                alike(members[x], members[y], common(x, y))
        x, y = np.unique(np.sort(np.concatenate(few, axis=1), axis=0), axis=1)
        alike(x, y, _met(found, ends, x, y))
        x, y = np.concatenate(links, axis=1)
        return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})

    return run


def links_across(nodes: DataFrame, labels: DataFrame, sets: DataFrame, shingles: Shingles, percent: int) -> DataFrame:
    """``a, b``: similar pairs of one bucket in different components, one at least for each two components of a bucket
    that have any; ``nodes`` has node and keys, ``sets`` as in :func:`linked`.

    All members of a bucket meet in one task with their sets, so a member costs a row, not each pair of members; pairs are
    counted as bits of the shingles that the bucket's members share, and what leaves the task are links. Buckets with one
    least component go to one task, where a node and its set come once.
    """
    labelled = nodes.select("node", "keys").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    entries = _by_bucket(labelled, "component").groupBy("least", "node").agg(F.first("value").alias("component"), F.collect_list("key").alias("keys"))
    open_nodes = saved(entries)
    slots = min(_SLOTS_EACH * int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 14)
    slot = F.pmod(F.xxhash64("least"), F.lit(slots)).cast("int").alias("slot")
    held = open_nodes.join(sets.toDF("node", "held"), "node").select(slot, "node", "component", "keys", "held")
    found = saved(held.groupBy("slot").applyInArrow(_across(shingles, percent), "a bigint, b bigint").distinct())
    discard(open_nodes)
    return found


def _by_bucket(nodes: DataFrame, value: str) -> DataFrame:
    """node, value, key and least (of the bucket's values), for buckets with two values or more.

    An outer join whose filter stands above it: a row for every node and key, whatever the sharing.
    """
    entries = nodes.select("node", F.col(value).alias("value"), F.explode("keys").alias("key"))
    ends = entries.groupBy("key").agg(F.min("value").alias("least"), F.max("value").alias("most")).where("least < most")
    joined = entries.join(ends, "key", "left")
    return joined.where(F.coalesce("least", "value") < F.coalesce("most", "value")).select("key", "node", "value", "least")


def leaders(nodes: DataFrame) -> DataFrame:
    """``a, b``: each node b of a shared bucket with the leader that it meets most often; leaders that
    follow no other come with a null ``a``."""
    entries = nodes.select("node", "rank", F.explode("keys").alias("key"))
    ends = entries.groupBy("key").agg(
        F.min_by("node", "rank").alias("lead"), F.min("node").alias("least"), F.max("node").alias("most")
    ).where("least < most")
    joined = entries.join(ends.select("key", "lead"), "key", "left")
    # Nothing is filtered before the counts, so the outer join has a row for every node and key.
    met = joined.groupBy("node", "lead").agg(F.count("*").alias("times"))
    other = F.when(F.col("lead") != F.col("node"), F.struct("times", F.col("lead").alias("a")))
    best = met.groupBy("node").agg(F.max(other).alias("best"), F.count("lead").alias("leads"))
    return best.where("leads > 0").select(F.col("best.a").alias("a"), F.col("node").alias("b"))


def _rarity(sets: DataFrame, shingles: Shingles) -> np.ndarray:
    """How many sets have a shingle of each slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            for found in shingles(batch.column(1)):
                np.add.at(total, (found & np.uint64(_SLOTS - 1)).astype(np.int64), 1)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    rows = sets.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_SLOTS, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def _prefixes(sets: DataFrame, shingles: Shingles, percent: int) -> DataFrame:
    """Size, place and shingle of each row's prefix in the order of rarity; ``sets`` has node, its set, and columns
    that go with every row of the prefix."""
    rarity = _rarity(sets, shingles)
    carried = [f for f in sets.schema.fields if f.name != sets.columns[1]]

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, firsts = [], [np.zeros(0, np.uint64)]
            for found in shingles(batch.column(1)):
                order = np.lexsort((found, rarity[(found & np.uint64(_SLOTS - 1)).astype(np.int64)]))
                sizes.append(len(found))
                firsts.append(found[order[: len(found) - (percent * len(found) + 99) // 100 + 1]])
            counts = np.array([len(f) for f in firsts[1:]], np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            places = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            kept = [batch.column(i).take(pa.array(row)) for i in range(batch.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.array(sizes, np.int64)[row]), pa.array(places), pa.array(np.concatenate(firsts).view(np.int64))],
                names=[*names, "size", "place", "shingle"],
            )

    names = [f.name for f in carried]
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in carried]
    return sets.mapInArrow(prefix, ", ".join([*kinds, "size bigint", "place bigint", "shingle bigint"]))


def _crowds(members: DataFrame) -> DataFrame:
    """``node, crowd``: nodes that crowded buckets connect, over any number of them, are one crowd."""
    links = members.select("lead", "node").distinct()
    labels = components(links)
    nodes = members.select("node").distinct()
    return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("crowd"))


def _crowded_pairs(members: DataFrame, nodes: DataFrame, sets: DataFrame, shingles: Shingles, percent: int) -> DataFrame:
    """``x, y, sx, sy``: members of one crowd in different components that can be similar enough.

    A node has its prefix in the index once, however many crowded buckets it is in. Members of one bucket
    are in one crowd, so every pair of a bucket is met; shingles that one component only has are left out.
    """
    crowds = _crowds(members).join(members.select("node", "component").distinct(), "node")
    there = crowds.join(nodes.select("node", "sketch"), "node")
    held = sets.toDF("node", "held").join(there, "node").select("node", "held", "crowd", "component", "sketch")
    entries = saved(_prefixes(held, shingles, percent))
    ends = entries.groupBy("crowd", "shingle").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    shared = entries.join(ends.where("least < most").select("crowd", "shingle"), ["crowd", "shingle"], "left_semi")
    names = {"node": ("x", "y"), "component": ("cx", "cy"), "size": ("nx", "ny"), "place": ("px", "py"), "sketch": ("sx", "sy")}
    left, right = (shared.select("crowd", "shingle", *(F.col(n).alias(to[i]) for n, to in names.items())) for i in (0, 1))
    met = left.join(right, ["crowd", "shingle"]).where("cx < cy")
    met = met.where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    room = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))
    return met.where((100 + percent) * room >= percent * (F.col("nx") + F.col("ny"))).select("x", "y", "sx", "sy")


def cross_pairs(nodes: DataFrame, labels: DataFrame, sets: DataFrame, shingles: Shingles, percent: int,
                plausible: Check | None, many: int) -> DataFrame:
    """``a, b``: pairs of one bucket in different components; ``nodes`` has node, keys and a sketch."""
    labelled = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = saved(_by_bucket(labelled, "component").select("key", "node", F.col("value").alias("component")))
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("size"), F.min("node").alias("lead"))
    within = sizes.groupBy("key").agg(
        F.sum("size").alias("n"), F.sum(F.col("size") * F.col("size")).alias("own"), F.min("lead").alias("lead")
    )
    crowded = within.where(F.col("n") * F.col("n") - F.col("own") > many * many).select("key", "lead")
    crowded = saved(crowded)
    few = members.join(crowded, "key", "left_anti")
    pieces = saved(few.join(nodes.select("node", "sketch"), "node"))
    sizes = pieces.groupBy("key", "component").agg(F.count("*").alias("size"))
    order = F.struct("size", "component")
    small = sizes.select("key", F.col("component").alias("from"), order.alias("o1"))
    big = sizes.select("key", F.col("component").alias("to"), order.alias("o2"))
    meetings = small.join(big, "key").where("o1 < o2").select("key", "from", "to")
    left = pieces.select("key", F.col("component").alias("from"), F.col("node").alias("x"), F.col("sketch").alias("sx"))
    right = pieces.select("key", F.col("component").alias("to"), F.col("node").alias("y"), F.col("sketch").alias("sy"))
    pairs = meetings.join(left, ["key", "from"]).join(right, ["key", "to"]).select("x", "y", "sx", "sy")
    if not crowded.isEmpty():
        inside = saved(members.join(crowded, "key").select("lead", "node", "component").distinct())
        pairs = pairs.union(_crowded_pairs(inside, nodes, sets, shingles, percent))
    if plausible is not None:
        pairs = pairs.where(plausible(F.col("sx"), F.col("sy")))
    found = saved(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    for done in (members, crowded, pieces):
        discard(done)
    return found


def linked(nodes: DataFrame, verify: Callable[[DataFrame], DataFrame], first: DataFrame, sets: DataFrame,
           shingles: Shingles, percent: int, plausible: Check | None = None, many: int = 64) -> DataFrame:
    """``node, component`` of all nodes but the smallest of each component.

    ``nodes`` has node, rank, keys and sketch (null if there is none); ``verify`` keeps the pairs ``a, b``
    that are similar enough; ``first`` is a saved table of :func:`leaders`; ``sets`` has node and a column
    from which ``shingles`` makes the sets whose Jaccard similarity is to be ``percent`` at least.
    """
    tried = first.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = saved(verify(tried))
    labels = components(links)
    others = cross_pairs(nodes, labels, sets, shingles, percent, plausible, many)
    more = saved(verify(others.join(tried, ["a", "b"], "left_anti")))
    discard(others)
    return _relabelled(links, labels, more)


def linked_in_buckets(nodes: DataFrame, verify: Callable[[DataFrame], DataFrame], first: DataFrame, sets: DataFrame,
                      shingles: Shingles, percent: int) -> DataFrame:
    """The same, where pairs across components are judged within their bucket's task (:func:`links_across`)."""
    links = saved(verify(first.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()))
    labels = components(links)
    return _relabelled(links, labels, links_across(nodes, labels, sets, shingles, percent))


def _relabelled(links: DataFrame, labels: DataFrame, more: DataFrame) -> DataFrame:
    """The components with more links."""
    if not more.isEmpty():
        # What is linked already goes in as its component, a round less than from the start.
        before, labels = labels, components(labels.toDF("a", "b").union(more))
        discard(before)
    discard(links)
    discard(more)
    return labels
