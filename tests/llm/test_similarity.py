"""Components, near copies and fuzzy lines against brute force."""

import random
import re

import numpy as np
import pytest
from corpus_fixtures import docs_of, no_docs  # noqa: E402, F401

from pyspark.sql import functions as F

from botlens.llm import banding, hashing, line_dedup, near_dedup
from botlens.llm.common import saved
from botlens.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(count, pairs):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def test_components_of_chains_stars_and_repeats(spark):
    draw = random.Random(1)
    pairs = [(i, i + 1) for i in range(20)] + [(50, 50 + i) for i in range(15)] + [(70, 70), (71, 72), (72, 71)]
    pairs += [(draw.randrange(80, 140), draw.randrange(80, 140)) for _ in range(30)]
    rows = spark.createDataFrame([*pairs, (None, 3), (3, None)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(rows).collect()}
    want = roots(140, pairs)
    assert found == {i: r for i, r in enumerate(want) if i != r}
    assert components(rows.where("false")).count() == 0


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_texts():
    """Copies, edited copies in chains, a shared passage, short and odd texts."""
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "one", "One", "a b c d", "a  b\tc d", "Été x"]
    passage = draw.choices(vocabulary, k=40)
    for _ in range(12):
        base = draw.choices(vocabulary, k=draw.choice([6, 30, 120]))
        texts.append(" ".join(base))
        for _ in range(draw.randint(0, 5)):
            base = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                base[draw.randrange(len(base))] = draw.choice(vocabulary)
            texts.append(draw.choice([" ", "  ", "\n"]).join(base))
    texts += [" ".join(passage + draw.choices(vocabulary, k=draw.randint(5, 60))) for _ in range(30)]
    return texts + texts[9:14]


def test_near_duplicates_are_the_exact_components(spark, docs_of, no_docs):
    texts = near_texts()
    sets = [shingles(t) for t in texts]
    pairs = [
        (i, j) for j in range(len(sets)) for i in range(j)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    want = roots(len(texts), pairs)
    assert len(set(want)) < len(texts)
    docs = docs_of(texts)
    rows = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    assert [rows[i].component_id for i in range(len(texts))] == want
    assert [rows[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())
    stage = near_dedup.one_of_each(docs)
    assert stage.columns == docs.columns
    assert {r.doc_id for r in stage.collect()} == {i for i, r in enumerate(want) if i == r}
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_rows_without_id_and_repeated_ids(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (None, "something else"), (9, text)], "doc_id bigint, text string")
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert rows == sorted([(5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (9, 5, False)], key=str)


def normal(line):
    return " ".join(x for x in re.split("[\x20\x09-\x0d]+", line.translate(LOW)) if x)


def removed_by_brute_force(texts):
    first, every = {}, []
    for d, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            if normal(line):
                every.append((d, k, normal(line)))
                first.setdefault(normal(line), (d, k))
    lines = sorted(first, key=first.get)
    sets = [{s[i : i + line_dedup.CHARS] for i in range(max(1, len(s) - line_dedup.CHARS + 1))} for s in lines]
    pairs = [(i, j) for j in range(len(lines)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    kept = {first[lines[r]] for r in roots(len(lines), pairs)}
    return {(d, k) for d, k, _ in every if (d, k) not in kept}, every


@pytest.mark.parametrize("seed", [3, 4])
def test_line_dedup_keeps_one_line_per_component(spark, docs_of, no_docs, seed):
    draw = random.Random(seed)
    pool = ["".join(draw.choices("abcde fghé", k=draw.choice([3, 20, 150, 300]))) for _ in range(25)]
    pool += [p[:60] + draw.choice("xyz") + p[61:] for p in pool if len(p) > 200] + ["", "  ", "x"]
    texts = [None, "", "\n\n"] + ["\n".join(draw.choice([str.upper, str])(draw.choice(pool)) for _ in range(draw.randint(1, 6))) for _ in range(40)]
    gone, every = removed_by_brute_force(texts)
    docs = docs_of(texts)
    rows = {r.doc_id: r for r in line_dedup.line_verdicts(docs).collect()}
    assert len(rows) == len(texts)
    for d in range(len(texts)):
        assert rows[d].n_lines == sum(1 for e in every if e[0] == d)
        assert rows[d].removed_lines == ",".join(str(k) for k in sorted(k for e, k in gone if e == d))
    stage = line_dedup.without_repeats(docs)
    assert stage.columns == docs.columns
    for r in stage.collect():
        text = texts[r.doc_id]
        want = text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (r.doc_id, k) not in gone)
        assert r.text == want
    assert line_dedup.line_verdicts(no_docs).count() == 0


def test_pairs_of_one_crowded_bucket_are_all_compared(spark):
    """Several hundred components share one band, and similar ones nothing else."""
    draw = random.Random(8)
    sets = []
    for _ in range(200):
        own = draw.sample(range(1 << 40), draw.choice([4, 20, 60]))
        base = list(range(draw.choice([0, 10, 40]))) + own
        sets.append(set(base))
        if draw.random() < 0.5:
            sets.append({*base[: len(base) - len(base) // draw.choice([5, 8, 12])], draw.randrange(1 << 40)})
    draw.shuffle(sets)
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    want = roots(len(sets), pairs)
    assert len(set(want)) > 128 and len(pairs) > 50
    nodes = spark.createDataFrame([(i, i, [-1, i]) for i in range(len(sets))], "node bigint, rank bigint, keys array<bigint>")
    nodes = nodes.withColumn("sketch", F.lit(None).cast("bigint"))
    packed = [(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in enumerate(sets)]
    table = spark.createDataFrame(packed, "node bigint, shingles binary")

    def verify(pairs):
        return pairs.where(F.udf(lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]), "boolean")("a", "b"))

    found = banding.linked(nodes, verify, saved(banding.leaders(nodes)), table, near_dedup._unpacked, 75)
    labels = {r.node: r.component for r in found.collect()}
    assert [labels.get(i, i) for i in range(len(sets))] == want


def test_rows_that_share_an_id_lose_no_line(spark):
    """A line goes only if it stays elsewhere, whatever rows share their doc_id."""
    own, common = "same second line of both", "the common line of everyone and more"
    rows = [(5, f"row a first line of its own\n{own}"), (5, f"\n{common}"), (1, common), (5, f"\n{common}"), (7, None), (7, "  \n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = sorted((r.doc_id, r.text) for r in line_dedup.without_repeats(docs).where("text is not null").collect())
    assert left == sorted([(5, rows[0][1]), (5, ""), (1, common), (5, ""), (7, "  \n")])
    told = sorted(tuple(r) for r in line_dedup.line_verdicts(docs).collect())
    assert told == sorted([(1, 1, 0, ""), (5, 2, 0, ""), (5, 1, 1, "1"), (5, 1, 1, "1"), (7, 0, 0, ""), (7, 0, 0, "")])
    # Two texts of one id that hold the same line: it stays in one of them.
    twins = spark.createDataFrame([(5, f"{own}\nx one"), (5, f"{own}\nx two that differs")], "doc_id bigint, text string")
    assert sum(r.text.count(own) for r in line_dedup.without_repeats(twins).collect()) == 1


def test_blank_lines_have_empty_sets():
    sets = line_dedup._line_sets(["abcdefg", "", "  ", "abcdefg"])
    assert [len(x) for x in sets] == [3, 0, 0, 3] and (sets[0] == sets[3]).all()


def test_short_lines_with_one_inner_edit_are_linked(spark, docs_of):
    draw = random.Random(9)
    texts = ["".join(draw.sample("abcdefghijklmnopqrstuvwxyz0123456789.,;:-_+", 41)) for _ in range(40)]
    texts += [t[:20] + "#" + t[21:] for t in texts]
    rows = {r.doc_id: r.removed_lines for r in line_dedup.line_verdicts(docs_of(texts)).collect()}
    assert [rows[i] for i in range(80)] == [""] * 40 + ["0"] * 40


def test_bands_of_lines_hardly_miss_a_pair_at_the_threshold():
    numbers = np.random.default_rng(10)
    missed = 0
    for _ in range(5000):
        both = numbers.integers(1 << 63, size=80, dtype=np.uint64)
        pair = [hashing.signature(s, line_dedup.BANDS * line_dedup.ROWS) for s in (both[:70], both[10:])]
        keys = hashing.band_keys(np.array(pair), line_dedup.BANDS)
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 5


def test_two_large_components_of_one_bucket_do_not_write_all_pairs(spark):
    sets = [{*range(60), 1000 + i} for i in range(150)] + [{*range(30, 90), 2000 + i} for i in range(150)] + [{*range(30, 90), 3000}]
    nodes = spark.createDataFrame([(i, [-1, i]) for i in range(301)], "node bigint, keys array<bigint>")
    nodes = nodes.withColumn("sketch", F.lit(None).cast("bigint"))
    labels = spark.createDataFrame([(i, i // 150 * 150) for i in range(300) if i % 150], "node bigint, component bigint")
    packed = [(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in enumerate(sets)]
    table = spark.createDataFrame(packed, "node bigint, shingles binary")
    pairs = banding.cross_pairs(nodes, labels, table, near_dedup._unpacked, 75, None, 64)
    assert {(r.a, r.b) for r in pairs.collect()} == {(i, 300) for i in range(150, 300)}


def test_search_for_leaders_gets_shared_keys_only(spark, docs_of, monkeypatch):
    """Forty keys of every line went through three shuffles; lines without a partner have none now."""
    draw = random.Random(11)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=60)) for _ in range(400)]
    texts += ["\n".join(t[:30] + "#" + t[31:] for t in texts[:3]), "\n".join(texts[3:5])]
    seen = []

    def kept(nodes):
        seen.extend(nodes.collect())
        return banding.leaders(nodes)

    monkeypatch.setattr(line_dedup, "leaders", kept)
    monkeypatch.setattr(line_dedup, "_BLOCK", 1 << 12)  # signed in many blocks
    rows = {r.doc_id: r.removed_lines for r in line_dedup.line_verdicts(docs_of(texts)).collect()}
    assert [rows[i] for i in range(402)] == [""] * 400 + ["0,1,2", "0,1"]
    assert len(seen) == 6 and all(r["keys"] for r in seen)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name) == "false"


def test_signatures_of_many_sets_hardly_miss_a_pair_at_the_threshold():
    numbers = np.random.default_rng(12)
    for size, step in ((8, 1), (16, 2), (80, 10), (9000, 1125)):
        count = 2000 if size < 1000 else 20
        pairs = [numbers.integers(1 << 64, size=size, dtype=np.uint64) for _ in range(count)]
        sets = [part for both in pairs for part in (both[step:], both[:-step])]
        sets = [np.concatenate((s, s[: len(s) // 2])) for s in sets]  # repeats count once
        ends = np.cumsum([0] + [len(s) for s in sets])
        signed, sizes = hashing.signatures(np.concatenate(sets), ends, line_dedup.BANDS * line_dedup.ROWS)
        assert (abs(sizes - (size - step)) <= 1 + size // 100).all()
        keys = hashing.band_keys(signed, line_dedup.BANDS)
        assert (~(keys[::2] == keys[1::2]).any(axis=1)).sum() <= 2
        bits = hashing.sketches(np.concatenate(sets), ends, signed, sizes, 2).view(np.uint64).reshape(-1, 2, 2)
        assert bits.any(axis=(0, 2)).tolist() == [size < 100, size > 64]
        assert np.bitwise_count(bits[::2] ^ bits[1::2]).sum(axis=2).max() <= banding._most_apart(2, 75)
    alone, _ = hashing.signatures(sets[0], np.array([0, len(sets[0])]), line_dedup.BANDS * line_dedup.ROWS)
    assert (alone[0] == signed[0]).all()


def test_members_of_a_crowded_bucket_without_a_likely_partner_stay_in_their_slot(spark):
    """All members of a bucket of more than 64 were kept, with their sketches, and got an index of prefixes."""
    numbers = np.random.default_rng(13)
    bits = numbers.integers(1 << 64, size=(300, 2, 3), dtype=np.uint64)
    bits[:150, 1] = 0  # small sets have one kind of sketch, large ones the other
    bits[150:, 0] = 0
    bits[170, 1] = bits[160, 1] ^ np.uint64(1 << 40 | 7)
    bits[299, 1] = bits[160, 1]
    keys = banding.packed_keys(np.repeat(np.array([[77, 78]]), 300, axis=0))
    steps = [20] * 299 + [40]  # the last one is too large to be a partner
    rows = [(i, s, bytearray(b.tobytes()), bytearray(k.tobytes())) for i, (s, b, k) in enumerate(zip(steps, bits, keys))]
    signed = spark.createDataFrame([*rows, rows[0], rows[160]], "node bigint, step tinyint, sketch binary, keys_0 binary")
    (found,) = banding.bucket_members(signed, 1, 3, 75)
    rows = found.collect()
    assert sorted(r.node for r in rows) == [160, 160, 170, 170] and len({r.key for r in rows}) == 2


@pytest.mark.parametrize("held", [1 << 20, 0])
def test_links_across_components_are_those_of_brute_force(monkeypatch, held):
    import pyarrow as pa

    monkeypatch.setattr(banding, "_BITS_HELD", held)  # 0: sets are counted without bits
    monkeypatch.setattr(banding, "_AT_ONCE", 1 << 10)
    draw = random.Random(14)
    sets, component = [], []
    for c in range(120):
        base = draw.sample(range(1 << 60), draw.choice([4, 20, 60]))
        for k in range(draw.choice([1, 1, 2, 30])):
            sets.append(sorted({*base[: len(base) - draw.randrange(1 + len(base) // 3)], *draw.sample(range(1 << 60), draw.randrange(3))}))
            component.append(5000 + 2 * c + k % 2)  # each base is two components that hang together
    keys = [sorted({-1, -2 - i % 3, draw.randrange(40)}) for i in range(len(sets))]
    group = pa.table({
        "slot": pa.array([0] * len(sets), pa.int32()), "node": range(len(sets)), "component": component, "keys": keys,
        "held": pa.array([np.array(x, np.uint64).tobytes() for x in sets], pa.binary()),
    })
    found = banding._across(lambda c: near_dedup._unpacked(c), 75)(group)
    pairs = list(zip(found["a"].to_pylist(), found["b"].to_pylist()))
    alike = lambda i, j: 100 * len({*sets[i]} & {*sets[j]}) >= 75 * len({*sets[i]} | {*sets[j]})
    assert all(a < b and component[a] != component[b] and alike(a, b) for a, b in pairs)
    met = [
        tuple(sorted((component[i], component[j]))) for j in range(len(sets)) for i in range(j)
        if {*keys[i]} & {*keys[j]} and component[i] != component[j] and alike(i, j)
    ]
    assert {tuple(sorted((component[a], component[b]))) for a, b in pairs} == {*met} and len(met) > 10 * len({*met}) > 100
    assert len(pairs) < len(met) / 2


def test_components_of_lines_that_only_later_pairs_link(spark):
    """Several hundred components share one band; what their leaders do not link is linked within the bucket."""
    draw = random.Random(15)
    sets = []
    for _ in range(150):
        base = [*range(draw.choice([0, 10, 40])), *draw.sample(range(100, 1 << 40), draw.choice([4, 20, 60]))]
        sets.append({*base})
        if draw.random() < 0.5:
            sets.append({*base[: len(base) - len(base) // draw.choice([5, 8, 12])], draw.randrange(100, 1 << 40)})
    draw.shuffle(sets)
    alike = lambda i, j: 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    want = roots(len(sets), [(i, j) for j in range(len(sets)) for i in range(j) if alike(i, j)])
    nodes = spark.createDataFrame([(i, i, [-1, i]) for i in range(len(sets))], "node bigint, rank bigint, keys array<bigint>")
    table = spark.createDataFrame([(i, bytearray(np.array(sorted(s), np.uint64).tobytes())) for i, s in enumerate(sets)], "node bigint, shingles binary")
    verify = lambda pairs: pairs.where(F.udf(alike, "boolean")("a", "b"))
    found = banding.linked_in_buckets(nodes, verify, saved(banding.leaders(nodes)), table, near_dedup._unpacked, 75)
    labels = {r.node: r.component for r in found.collect()}
    assert [labels.get(i, i) for i in range(len(sets))] == want and len({*want}) < len(want)


def test_pipeline_bounds_the_rows_of_an_arrow_batch(spark, docs_of):
    """An executor that went through all stages held 10,000 texts several times."""
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in (("10000", "2000"), ("0", "2000"), ("500", "500")):
            spark.conf.set(name, given)
            corpus_pipeline.STAGES[0][1](spark, docs_of(["one text"]), "")
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
