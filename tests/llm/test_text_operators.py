"""Row-wise operators against libraries and brute force."""

import hashlib
import random
import re

import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from corpus_fixtures import docs_of, no_docs  # noqa: E402, F401

from botlens.llm import bpe, decontaminate, quality_pu, quality_rules, token_counts  # noqa: E402

PATH = public.path("byte_bpe_50k.json")
PIECES = public.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n", "a", "é" * 3, "x" * 70_000, " " * 70_000, "one two\n" * 3, "<|endoftext|>a"]


@pytest.fixture(scope="module")
def known():
    return bpe.vocabulary(PATH)


def reference():
    return tokenizers.Tokenizer.from_file(PATH)


def test_bpe_equals_the_library(known):
    library, draw = reference(), random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "'s", "'ll", "'", "1", "!", "é", "中", "\U0001f600", "\x1c", "\x85", "<|endoftext|>", "ing"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 60))) for _ in range(300)]
    texts += ["a" * 150_000, " " * 66_000 + "y", "!" * 66_000 + "'s", "ab" * 40_000 + "'ll"]
    for text in texts:
        tokens = [t for block in bpe.encode(known, text) for t in block]
        assert tokens == library.encode(text, add_special_tokens=False).ids
        assert bpe.Decoder(known).feed(tokens, True) == library.decode(tokens, skip_special_tokens=False)


def test_long_words_need_the_lookahead_only(known):
    draw = random.Random(2)
    for _ in range(20):
        data = "".join(draw.choices("abcdeth", k=5000)).encode()
        word, most, out = bpe.LongWord(known), 0, []
        for at in range(0, len(data), 97):
            out += word.feed(data[at : at + 97])
            most = max(most, len(word.held))
        assert out + word.finish() == known.merge(data)
        assert most < bpe._WINDOW + known.lookahead


def test_decoder_holds_back_unfinished_characters(known):
    tokens = [t for block in bpe.encode(known, "é中\U0001f600") for t in block]
    decoder = bpe.Decoder(known)
    assert "".join(decoder.feed([t]) for t in tokens) + decoder.feed([], True) == "é中\U0001f600"
    assert bpe.Decoder(known).feed(tokens[:1], True) in ("é", "�")


def test_bpe_rows(spark, docs_of, no_docs):
    library = reference()
    for row in bpe.round_trips(docs_of(ODD), PATH).collect():
        ids = library.encode(ODD[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((ODD[row.doc_id] or "").encode()).hexdigest()
    assert bpe.round_trips(no_docs, PATH).count() == 0


def test_token_counts_equal_the_library():
    draw = random.Random(3)

    def expected(library, text):
        marked = token_counts.MARK + text.replace(" ", token_counts.MARK)
        done = library.encode(marked, add_special_tokens=False) if text else None
        sizes = [(len(marked[a:b].encode()) if i == 0 else 1) for i, (a, b) in zip(done.ids, done.offsets)] if done else []
        return sum(sizes)

    for _ in range(300):  # small vocabularies are full of ties
        scores = {
            draw.choice(["", "▁"]) + "".join(draw.choices("abc", k=draw.randint(1, 4))): float(draw.randint(-4, -1))
            for _ in range(draw.randint(2, 12))
        }
        library = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", min(scores.values())), *scores.items()], 0, False))
        text = "".join(draw.choices("abcd é", k=draw.randint(0, 14)))
        assert token_counts.Pieces(scores).text_counts(text)[0] == expected(library, text)


def test_token_count_rows(docs_of, no_docs):
    rows = {r.doc_id: r for r in token_counts.token_counts(docs_of(ODD), PIECES).collect()}
    assert (rows[0].n_tokens, rows[1].n_tokens) == (0, 0)
    assert rows[6].n_chars == 70_000 and rows[6].n_tokens > 0
    assert token_counts.token_counts(no_docs, PIECES).count() == 0


def brute_hits(items, words, window):
    hit, found = set(), set()
    for item, text in items:
        own = decontaminate.words_of(text)
        size = min(window, len(own))
        wins = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)} if own else set()
        for j in range(len(words) - size + 1):
            if own and tuple(words[j : j + size]) in wins:
                hit.update(range(j, j + size))
                found.add(item)
    return len(hit), found


def test_automaton_finds_every_window():
    draw = random.Random(4)
    for _ in range(500):
        window, letters = draw.choice([2, 3, 4, 5]), "abcd"[: draw.randint(1, 4)]
        items = [(k, " ".join(draw.choices(letters, k=draw.randint(0, 9)))) for k in range(draw.randint(0, 5))]
        words = decontaminate.words_of(" ".join(draw.choices(letters + "x", k=draw.randint(0, 25))))
        automaton = decontaminate.Automaton(items, window)
        runs, found = automaton.matches(words)
        assert (sum(b - a for a, b in runs), {automaton.items[k] for k in found}) == brute_hits(items, words, window)


def test_contamination_does_not_depend_on_shards(spark, docs_of):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = docs_of([None, "", passage, "x " + passage[:60].upper() + " y", "clean words only", passage])
    items = spark.createDataFrame([(1, passage), (2, None), (3, "short one"), (None, "w1 w2"), (1, passage)], "item_id bigint, text string")
    one = decontaminate.contamination(docs, items).orderBy("doc_id").collect()
    assert one == decontaminate.contamination(docs, items, max_words=5).orderBy("doc_id").collect()
    assert [r.contaminated for r in one] == [False, False, True, True, False, True]
    assert one[2].n_items == 2 and one[2].n_hit == 30
    kept = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, items).collect()}
    assert set(kept) == {0, 1, 4} | ({3} if 3 in kept else set()) and kept[4] == "clean words only" and kept[0] is None
    assert decontaminate.contamination(docs, items.where("false")).where("contaminated").count() == 0


def test_repeated_windows_and_lines():
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice(["a", "b", "cc"]) + draw.choice([" ", "\n", "  "]) for _ in range(draw.randint(0, 40)))
        words, hit = text.split(), set()
        wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        for i, w in enumerate(wins):
            if wins.count(w) > 1:
                hit.update(range(i, i + 8))
        assert quality_rules.Text(text).n_repeat_words == len(hit)
        lines = [x for x in text.split("\n") if x.strip()]
        assert quality_rules.Text(text).n_dup_lines == len(lines) - len(set(lines))


def test_rule_order_changes_cost_only(docs_of, no_docs):
    texts = [*ODD, "good words stand here in some numbers " * 3, "LOUD!! " * 40, "a # b # c # d # " * 9, " ".join(f"w{i}" for i in range(50))]
    verdicts = [quality_rules.passes(quality_rules.Text(t), quality_rules.RULES) for t in texts]
    order = quality_rules.measured_order(texts)
    assert {r.name for r in order} == {r.name for r in quality_rules.RULES}
    assert verdicts == [quality_rules.passes(quality_rules.Text(t), order) for t in texts]
    docs = docs_of(texts)
    kept = {r.doc_id for r in quality_rules.measured(docs).where("kept").collect()}
    assert kept == {i for i, v in enumerate(verdicts) if v}
    stage = quality_rules.kept_documents(docs)
    assert stage.columns == docs.columns and {r.doc_id for r in stage.collect()} == kept
    assert quality_rules.measured(no_docs).count() == 0


def test_words_end_at_ascii_spaces_only():
    """A no-break space does not part words, in no measure."""
    text = quality_rules.Text("W1Q\u00a0ab " * 30 + "AB\u2003CD EF\x0bGH x")
    assert text.n_words == 34 and text.n_shouted == 3


def test_rules_run_until_the_first_rejection():
    seen = []
    rules = [quality_rules.Rule(n, lambda t, n=n: seen.append(n) or n == "b") for n in "abc"]
    assert not quality_rules.passes(quality_rules.Text("x"), rules) and seen == ["a", "b"]


def test_positive_unlabelled_scores(spark):
    draw = random.Random(6)
    good = lambda: " ".join("".join(draw.choices("aeirstn", k=draw.randint(2, 8))) for _ in range(60)) + "."
    bad = lambda: " | ".join("".join(draw.choices("AEIRS#", k=4)) for _ in range(60))
    kinds = [draw.random() < 0.7 for _ in range(600)]
    docs = spark.createDataFrame([(i, good() if k else bad()) for i, k in enumerate(kinds)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, int(k), 0) for i, k in enumerate(kinds) if i % 2], "doc_id bigint, quality int, toxic int"
    )
    model = quality_pu.trained(docs, labels)
    assert 0.5 < model.prior < 0.9
    rows = quality_pu.scored(docs, model).collect()
    right = sum(r.predicted == int(kinds[r.doc_id]) for r in rows if r.held_out)
    assert right >= 0.95 * sum(r.held_out for r in rows) > 0
    again = quality_pu.scored(spark.createDataFrame([(1, None), (None, ""), (2, "x")], docs.schema), model).collect()
    assert all(0 <= r.score <= 1 for r in again) and again[0].score == again[1].score
    untrained = quality_pu.trained(docs, labels.where("false"))
    assert {r.score for r in quality_pu.scored(docs.limit(3), untrained).collect()} == {0.5}


def test_labels_of_held_out_rows_do_not_matter(spark):
    import zlib

    docs = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(80)], "doc_id bigint, text string")
    rows = [(i, 1, 0) for i in range(0, 80, 2)]
    turned = [(i, 0 if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in rows]
    schema = "doc_id bigint, quality int, toxic int"
    a, b = (quality_pu.trained(docs, spark.createDataFrame(r, schema)) for r in (rows, turned))
    assert a.prior == b.prior and all((x == y).all() for x, y in zip(a.weights, b.weights))
    assert re.match("[0-9.]+", str(a.prior))
