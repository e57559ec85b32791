"""Personal data, licenses, archives and the pipeline."""

import hashlib
import math
import random
import re

import pytest
from corpus_fixtures import docs_of, no_docs  # noqa: E402, F401

from botlens.llm import licenses, pii, warc

LOW = str.maketrans(licenses._UPPER, licenses._LOWER)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_stay(spark, docs_of, no_docs):
    draw = random.Random(1)
    parts = [
        "a@b.c", "a", "@", "b.co", "1.2.3.4", ".", "5", "255", "256", "+49 ", "(30) ", "4111 1111 1111 1111", " ", "-", "é",
        "\U0001f600", "x@y.z_q@r.s", "0", "\n", " (at) ", "john", "+1 (988) 555-2485", "555-123-4567 ",
    ]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "1" * 3000, "1.2.3.4 " * 600, "x@y.zz " * 300, "1 " * 2000]
    rows = pii.personal_data(docs_of(texts)).collect()
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        spans = [s for s in r.spans.split(",") if s]
        assert set(joined(want).split(",")) - {""} <= set(spans) and len(spans) == len(want) + r.n_added
    assert pii.personal_data(no_docs).count() == 0


def test_hostile_texts_take_linear_time(spark):
    import time

    texts = [(i, t) for i, t in enumerate(["a." * 100_000, "1" * 200_000, "1 " * 100_000, "1." * 100_000, "+1" * 100_000])]
    judge = pii.Judge((), (), (None,) * 4)
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    started = time.perf_counter()
    assert pii.personal_data(rows, judge).count() == 5
    assert time.perf_counter() - started < 60


def test_trees_add_what_base_patterns_miss(spark):
    judge = pii.Judge(((2, 9.5, 0.0, 1.0),), (1.0,), (None, None, None, 0.5))  # ten digits or more
    docs = spark.createDataFrame([(1, "call 555-123-4567 or +1 (988) 555-2485"), (2, "call 555-1234"), (3, None)], "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.personal_data(docs, judge).collect()}
    assert found == {1: "phone:5:17,phone:21:38", 2: "", 3: ""}
    texts = {r.doc_id: r.text for r in pii.redacted(docs, judge).collect()}
    assert texts == {1: "call [phone] or [phone]", 2: "call 555-1234", 3: None}


def test_fitted_trees_add_loose_forms_and_leave_look_alikes(spark):
    draw = random.Random(5)
    rows = []
    for i in range(400):
        card = "".join(draw.choices("123456789", k=15))
        card += next(c for c in "0123456789" if luhn(card + c))
        spans = (f"{draw.choice('abcdef')}x.{i}@mail{i % 7}.example.com", card, f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}")
        rows.append((i, f"thing er the {draw.choice(spans)} Ond hre, and {draw.choice(spans)} stion."))
    judge = pii.fitted(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [m is not None and m[0] >= 0.95 and m[1] >= 0.5 for m in judge.measured] == [True, False, True, True]
    added = {
        "write to john [at] example [dot] org today": "email:9:36", "mail jane (at) example dot com please": "email:5:30",
        "thing er the 4111.1111.1111.1111 on": "card:13:32", "credit card: 4111/1111/1111/1111 on": "card:13:32",
        "call 555-123-4567 now": "phone:5:17",
    }
    left = [
        "version 10.20.300.4000 is out", "date 2021-03-04 - 2021-05 it was", "order 555-123-4567 came", "300.400.500.600 is no host",
        "order 123-4567890-1234567 came", "thing er the 4111.1111.1111.1112 on", "we meet at noon dot com", "04/05/2021 was a day",
    ]
    docs = spark.createDataFrame(list(enumerate([*added, *left])), "doc_id bigint, text string")
    found = [r.spans for r in sorted(pii.personal_data(docs, judge).collect())]
    assert found == [*added.values(), *[""] * len(left)]


def test_trees_are_fitted_on_all_documents(spark, monkeypatch):
    """Documents beyond the first four thousand were left out of the fit."""
    rows = [(i, f"er the a{i}.b@mail{i}.example.com Ond") for i in range(6000)]
    seen = []
    made = pii._examples

    def kept(places):
        seen.append((places.count(), places.select("doc").distinct().count()))
        return made(places)

    monkeypatch.setattr(pii, "_examples", kept)
    judge = pii.fitted(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert seen == [(6000, 6000)] and judge.thresholds[0] is not None


def scan(text):
    low = (text or "").translate(LOW)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, starts, labels = word.findall(low), [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    every, best = set(labels), 0.0
    for label, template in licenses.TEMPLATES:
        parts = template.split()
        need = set(zip(parts, parts[1:]))
        step = next(2**i for i in range(20) if 2**i >= len(parts))
        for at in range(0, len(words), step):
            block = words[at : at + 2 * step]
            common = len(set(zip(block, block[1:])) & need)
            if common >= math.ceil(len(need) * licenses.THRESHOLD - 1e-9):
                every.add(label)
                best = max(best, common / len(need))
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(labels)), ",".join(sorted(every)), 1.0 if starts else best


def test_license_scan_is_exact(spark, docs_of, no_docs):
    draw = random.Random(2)
    voc = "cc by CC By all rights reserved general public license GPL licensed under the mit released License Apache version 2.0 é x _ - .".split()
    texts = [draw.choice(["", " ", "  ", ", ", "\n"]).join(draw.choices([*voc, "\n"], k=draw.randint(0, 30))) for _ in range(400)]
    texts += [None, "", "All   rights reserved.", "cc by cc by", "Released under MIT license", licenses.TEMPLATES[1][1].upper(), "a" * 100_000]
    for _, text in licenses.TEXTS:
        words = text.split()
        for lost in (1, 3, 12):
            kept = [w for w in words if draw.randrange(100) >= lost]
            texts.append("filler " * draw.randrange(300) + "\n".join(" ".join(kept[i : i + 9]) for i in range(0, len(kept), 9)) + " word" * 40)
    rows = licenses.license_scan(docs_of(texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want, got = scan(texts[r.doc_id]), tuple(r)[1:]
        assert got[:6] == want[:6] and abs(got[6] - want[6]) < 1e-12, texts[r.doc_id]
    assert licenses.license_scan(no_docs).count() == 0


def test_wrapped_texts_are_found_and_scattered_words_are_not(spark, docs_of):
    wrapped = [
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public\nLicense",
        "tree " * 5000 + "\n".join(licenses.TEXTS[0][1].split()) + " tree" * 5000,
    ]
    scattered = [
        " ".join(sorted(licenses.TEMPLATES[1][1].split())),
        "released under the apache license",
        " and then ".join(licenses.TEMPLATES[9][1].split()),
        " ".join(w + " tree" * 40 for w in licenses.TEMPLATES[0][1].split()),
    ]
    rows = sorted(licenses.license_scan(docs_of(wrapped + scattered)).collect())
    assert [r.labels for r in rows] == ["bsd", "gpl", "mit", "", "", "", ""]
    assert [r.score for r in rows[3:]] == [0.0] * 4


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, data string")


def test_archives_come_back(spark, tmp_path):
    long, odd = "é" * 200_000, "x\r\n\r\nWARC/1.1\r\n" * 20
    rows = pages(spark, [
        (3, "u", "same" * 40, "d"), (1, "u\r\nv", "same" * 40, "d"), (2, None, "same" * 40, "d"), (4, "u", "ab", "d"), (5, "u", "ab", "d"),
        (6, "u", None, "d"), (7, "u", long, "d"), (8, "u", odd, "d"), (None, "u", "same" * 40, "d"), (None, "u", "alone" * 40, "d"), (1, "u", "same" * 40, "d"),
    ])
    got = sorted(map(tuple, warc.written_and_read(rows, f"file://{tmp_path}/w").collect()), key=str)
    size, digest = 160, hashlib.sha256(b"same" * 40).hexdigest()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [
        (1, size, digest, "response", None), (1, size, digest, "response", None), (2, size, digest, "revisit", 1),
        (3, size, digest, "revisit", 1), (None, size, digest, "revisit", 1), (4, 2, sha("ab"), "response", None),
        (5, 2, sha("ab"), "response", None), (6, 0, sha(""), "response", None), (7, 400_000, sha(long), "response", None),
        (8, len(odd), sha(odd), "response", None), (None, 200, sha("alone" * 40), "response", None),
    ]
    assert got == sorted(want, key=str)
    assert warc.written_and_read(rows.where("false"), f"file://{tmp_path}/e").count() == 0


def test_chunks_are_small_and_carry_digests(spark, tmp_path):
    text = "payload " * 50_000
    listed = warc.write_archives(warc.with_digests(pages(spark, [(1, "u", text, "")])), f"file://{tmp_path}/w")
    rows = warc.chunks(listed, 1000).orderBy("chunk").collect()
    assert [r.chunk for r in rows] == list(range(400)) and max(len(r.data) for r in rows) == 1000
    assert b"".join(r.data for r in rows).decode() == text
    assert rows[9].digest_so_far == hashlib.sha256(text[:10_000].encode()).hexdigest() and rows[-1].last


def test_broken_payloads_are_noticed(spark):
    rows = spark.createDataFrame(
        [("1", 0, True, "response", None, "00", 1, 1, "11", b"x")], warc._CHUNKS
    )
    with pytest.raises(Exception, match="broken payload"):
        warc.payloads(rows).collect()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(7)
    sentence = lambda n: " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(n))
    passage, shared = sentence(30), sentence(60)
    clean = [sentence(40) + "\n" + sentence(30) for _ in range(6)]
    near = sentence(200).split()
    in_lines = lambda n: "\n".join(" ".join(near[i : i + n]) for i in range(0, 200, n))
    texts = [
        *clean, in_lines(17), in_lines(41), "short text", "# $ % " * 30, clean[0] + " " + passage, sentence(50) + "\n" + shared, sentence(50) + "\n" + shared, None,
    ]
    folder = str(tmp_path / "t")
    frame = spark.createDataFrame([(i, t, "en", "s", 1, "extra") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint, made string")
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(seen["quality_rules"]) == set(range(len(texts))) - {8, 9, 13}
    assert shared in seen["line_dedup"][11].text and shared not in seen["line_dedup"][12].text
    assert set(range(6)) <= set(seen["near_dedup"]) and not {6, 7} <= set(seen["near_dedup"])
    assert passage not in " ".join(r.text or "" for r in seen["decontamination"].values())
    assert all(seen["decontamination"][i].text == texts[i] for i in range(1, 6))
    direct = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert direct == seen["bpe"]
    for r in direct.values():
        text = seen["decontamination"][r.doc_id].text
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_queries_are_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(entry.oracle_sql()) <= names
