"""Repeated passages, hard negatives and ranked search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_fixtures import docs_of, no_docs  # noqa: F401

from botlens.llm import hard_negatives, lexical, suffix_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- op11 -----------------------------------------------------------------------------------------

def cut_by_hand(rows, length):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, hash)}; rows come by id (None last)."""
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(data[p : p + length])
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[doc, text] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeating_texts():
    draw = random.Random(11)

    def prose(n, letters="abcdefgh é\n"):
        return "".join(draw.choices(letters, k=n))

    shared = [prose(60), prose(35), prose(200)]
    texts = [None, "", "short", "x" * 300, "x" * 29, "ab" * 120, "\0" * 90, "abc" * 40 + "ab" * 30, shared[2], shared[2]]
    for _ in range(60):
        parts = [draw.choice([prose(draw.randint(1, 80)), draw.choice(shared), draw.choice(shared)[draw.randint(0, 20) :]])
                 for _ in range(draw.randint(1, 6))]
        texts.append("".join(parts))
        if draw.random() < 0.3:  # a near copy
            near = list(texts[-1])
            near[draw.randrange(len(near))] = "Z"
            texts.append("".join(near))
    return texts + texts[12:15]


@pytest.mark.parametrize("crowd", [4096, 2])
def test_repeated_bytes_go(spark, docs_of, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "_CROWD", crowd)
    texts = repeating_texts()
    found = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removals(docs_of(texts), 30).collect()}
    want = cut_by_hand(list(enumerate(texts)), 30)
    assert found == {i: want[i, t] for i, t in enumerate(texts)}
    assert sum(v[1] > 0 for v in found.values()) > 20


def test_ids_that_are_missing_or_shared(spark, no_docs):
    a, b = "the one passage of thirty bytes and more", "another passage that has forty-one bytes."
    rows = [(None, a), (None, b), (7, a), (7, a), (7, b + a), (3, b), (9, "")]
    found = suffix_dedup.removals(spark.createDataFrame(rows, "doc_id bigint, text string"), 30).collect()
    kept = sorted((r.doc_id if r.doc_id is not None else 99, r.n_bytes, r.n_removed) for r in found)
    # Document 3 has b first; of the two texts of document 7 one comes first and keeps a.
    once = [k for k in kept if k[0] == 7]
    assert [k for k in kept if k[0] != 7] == [(3, 41, 0), (9, 0, 0), (99, 40, 40), (99, 41, 41)]
    assert len(once) == 3 and {k[1] for k in once} == {40, 81}
    assert once in ([(7, 40, 0), (7, 40, 0), (7, 81, 81)], [(7, 40, 40), (7, 40, 40), (7, 81, 41)])
    assert suffix_dedup.removals(no_docs, 30).count() == 0


def test_groups_hold_all_occurrences(spark, docs_of):
    """Every string of the length that stands twice is in a group of all its places."""
    texts = [t for t in dict.fromkeys(repeating_texts()) if t]
    length = 30
    rows = suffix_dedup.repeat_groups(docs_of(texts), length).collect()
    data = [t.encode() for t in texts]
    members = defaultdict(list)
    for r in rows:
        members[r.key, r.node].append(r)

    def places(key, node, shift=0):
        for r in members[key, node]:
            if r.region is not None and (key, r.region) in members:
                equal = [(m.doc_id, m.start) for m in members[key, r.region]]
                base = next(m.start for m in members[key, r.region] if m.first)
                yield from ((d, s + r.start - base) for d, s in equal)
            elif r.below is not None:
                yield from places(key, r.below)
            else:
                yield r.doc_id, r.start

    strings = defaultdict(set)
    for d, text in enumerate(data):
        for p in range(len(text) - length + 1):
            strings[text[p : p + length]].add((d, p))
    listed = defaultdict(set)
    for (key, node), group in members.items():
        size = group[0].length
        for d, p in set(places(key, node)):
            assert size >= length
            for q in range(p, p + size - length + 1):
                listed[data[d][q : q + length]].add((d, q))
        firsts = [(r.doc_id, r.start) for r in group if r.first]
        assert not firsts or len(firsts) == 1
    for string, where in strings.items():
        if len(where) > 1:
            first = min(where)
            assert where - {first} <= listed[string]


# --- op12 -----------------------------------------------------------------------------------------

def mined_by_hand(rows):
    rows = {i: (label, np.floor(256 * np.array(v)).astype(np.int64)) for i, label, v in rows}
    out = []
    for a, (label, vector) in rows.items():
        if a % 50:
            continue
        scores = {i: int(v @ vector) for i, (_, v) in rows.items() if i != a}
        positives = sorted((i for i in scores if rows[i][0] == label), key=lambda i: (-scores[i], i))[:5]
        for p in positives:
            fit = [i for i in scores if rows[i][0] != label and 50 * scores[p] <= 100 * scores[i] <= 95 * scores[p]]
            for rank, n in enumerate(sorted(fit, key=lambda i: (-scores[i], i))[:3], 1):
                out.append((a, p, rank, n, scores[p], scores[n]))
    return sorted(out)


def test_hard_negatives_by_hand(spark):
    draw = np.random.default_rng(5)
    rows = [(i, int(draw.integers(0, 3)), draw.normal(size=20).round(2).tolist()) for i in range(600)]
    rows += [(i + 1000, r[1], list(r[2])) for i, r in enumerate(rows[:40])]  # ties
    whole = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    odd = [(2000, None, [1.0] * 20), (2050, 1, None), (2100, 1, [1.0, None]), (2150, 1, [float("nan")] * 20),
           (2200, 1, [float("inf")]), (None, 1, [1.0] * 20), rows[3]]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, label int, embedding array<float>")
    found = sorted(tuple(r) for r in hard_negatives.hard_negatives(frame.selectExpr("*", "1 as id", "2 as score")).collect())
    exact = [(i, label, np.array(v, np.float32).astype(float)) for i, label, v in whole]
    assert found == mined_by_hand(exact) and len(found) > 100
    assert hard_negatives.hard_negatives(frame.where("false")).count() == 0


def test_intervals_hold_and_help():
    draw = np.random.default_rng(6)
    vectors = draw.integers(-120, 120, size=(4000, 64))
    vectors[:10] = 0
    codes = hard_negatives.Codes(vectors.astype(float))
    everyone, out = np.arange(len(vectors)), 0
    for q in range(0, 4000, 400):
        low, high = hard_negatives.Query(vectors[q].astype(float)).intervals(codes, everyone)
        exact = vectors @ vectors[q]
        assert (low <= exact).all() and (exact <= high).all()
        out += (high < np.sort(exact)[-6]).sum()
    assert out > 0.5 * 10 * 4000  # most rows cannot be among the best


def test_short_vectors_and_huge_components(spark):
    rows = [(50, 0, [1e30, 1.0]), (51, 0, [1e30]), (53, 1, [9e29, 0.5, 3.0]), (54, 1, [-1e30]), (55, 0, [])]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>"))
    # 51 scores 2^54, 55 scores 0; only the first has a window, and 53 scores 2^54 + 256 * 128, above 95 percent.
    assert found.collect() == []


# --- op13 -----------------------------------------------------------------------------------------

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def ranked_by_hand(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs if d is not None and terms(t)]
    number, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(terms(text))
    out = []
    for item, words in queries.items():
        scores = []
        for d, c in counts:
            m = 10 + (90 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in words if w in c
            )
            if score > 0:
                scores.append((-score, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(1024, 200_000), (3, 40)])
def test_ranking_by_hand(spark, monkeypatch, sizes):
    monkeypatch.setattr(lexical, "_DOCS", sizes[0])
    monkeypatch.setattr(lexical, "_PACK", sizes[1])
    draw = random.Random(13)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "x2", "日本"]
    texts = [None, "", " .,; ", "w1", "W1", "w1 w1 w1", "w1 w2", " ".join(["w3"] * 500)]
    texts += [" ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 12, 12, 80]))) for _ in range(150)]
    texts += texts[20:50]  # ties
    docs = list(enumerate(texts)) + [(None, "w1 w2 w3")]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 20)))) for i in range(12)]
    items += [(3, "w1 w2"), (90, None), (91, "unknown"), (92, "W1"), (None, "w2 été")]
    frame = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id bigint, text string, rank int, m string")
    index = lexical.build(frame)
    found = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((tuple(r) for r in found), key=str) == ranked_by_hand(docs, items)


def test_ranking_of_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    assert lexical.search(lexical.build(no_docs), items).count() == 0
    full = spark.createDataFrame([(1, "w1 w2"), (2, "w3")], "doc_id bigint, text string")
    assert lexical.search(lexical.build(full), items.where("false")).count() == 0
