"""License scan: fixed phrases, and an exact set-similarity join with license templates.

Text blocks are overlapping windows of words, across line breaks, so wrapped texts are found: a template
whose length in words rounds up to the power of two c meets windows of 2c words, one begins every c words
(any c + 1 neighbouring words are within one). Tokens are pairs of neighbouring words, so words that merely
stand about in a window do not make a license; a block's set holds its distinct pairs. A template is
contained in a block if at least ``threshold`` of the template's pairs are in it. The join is exact:

* pairs are ordered by their frequency in all blocks, rare ones first (pairs of templates only: no other
  can be common to both sides);
* prefix: a block that has all but ``size - need`` of a template's pairs has one of its first
  ``size - need + 1``, so blocks and templates meet on those alone;
* length: a block needs ``need`` distinct pairs;
* position: what follows the first common pair on either side bounds the overlap;
* the overlap of what is left is counted on the full sets.

Everything is built-in functions; templates are a fixed list and so small enough to broadcast.

Defined results: null text is empty and has no words. Rows that share doc_id and text share their
result; rows without id have one as well. An empty table gives an empty table; other columns are not
looked at. Words are compared lower-cased A-Z. A block never has more than 2c words, however long
the text or its lines are.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botlens.llm.common import saved

#: Phrases and labels of the base scan.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Public license texts and notices, and their labels.
TEXTS = (
    ("mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution."""),
    ("isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache-2.0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License."""),
    ("gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details."""),
    ("lgpl", """
        This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
        Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)
        any later version."""),
    ("mpl-2.0", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)
#: Templates of the join and their labels: single sentences, and the texts above as words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
    *((label, " ".join(re.findall("[0-9a-z]+", text.lower()))) for label, text in TEXTS),
)
THRESHOLD = 0.8
#: In Java's classes: what parts words, and what words consist of.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrase(words: str) -> str:
    return f"{_GAP}++".join(words.split())


#: No phrase begins with a word that another ends with, so places never share words.
_ANY_PHRASE = f"(?i)(?<!{_WORD})(?:{'|'.join(_phrase(p) for p, _ in PHRASES)})(?!{_WORD})"


def _n_words(text: Column) -> Column:
    """Number of words: gaps leave an empty part at either end."""
    parts = F.split(text, f"{_GAP}++")
    ends = (F.element_at(parts, 1) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return F.size(parts) - ends


def _base(text: Column) -> dict[str, Column]:
    """Base columns of a text without nulls."""
    there = text.rlike(_ANY_PHRASE)
    between = F.when(there, F.split(text, _ANY_PHRASE, -1))
    found = F.when(there, F.regexp_extract_all(text, F.lit(_ANY_PHRASE), F.lit(0)))
    n_words = _n_words(text).cast("bigint")
    last = F.element_at(found, -1)
    label = F.lit(None).cast("string")
    labels = F.transform(found, lambda m: _label(m, label))
    return {
        "n_words": n_words,
        "n_base": F.when(there, F.size(found)).otherwise(0).cast("bigint"),
        "first_word": _n_words(F.element_at(between, 1)).cast("bigint"),
        "last_word": n_words - _n_words(last) - _n_words(F.element_at(between, -1)),
        "base": F.when(there, F.array_distinct(labels)).otherwise(F.array().cast("array<string>")),
    }


def _label(match: Column, label: Column) -> Column:
    for phrase, name in PHRASES:
        label = F.when(F.lower(F.substring(match, 1, 1)) == phrase[0], F.lit(name)).otherwise(label)
    return label


def template_pairs() -> list[tuple[int, str, int, str, str]]:
    """template, label, class of its length, and the two words, of each distinct pair of a template."""
    out = []
    for number, (label, template) in enumerate(TEMPLATES):
        words = template.split()
        size = 1 << (len(words) - 1).bit_length()
        out += [(number, label, size, a, b) for a, b in dict.fromkeys(zip(words, words[1:]))]
    return out


def blocks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_hash, class, block (its number) and shared (distinct template pairs, as numbers) of each
    window of words that has a pair of a template of its class; pairs are numbered by :func:`_numbers`."""
    known = sorted({(c, *numbered) for _, _, c, *pair in template_pairs() for numbered in [(*pair, _numbers()[tuple(pair)])]})
    # A few hundred rows of the fixed list.
    pairs = docs.sparkSession.createDataFrame(known, "class int, a string, b string, pair int")
    words = F.filter(F.split(F.translate(F.coalesce(F.col(text_column), F.lit("")), _UPPER, _LOWER), f"{_GAP}++"), lambda w: w != "")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), words.alias("words"))
    following = F.arrays_zip(F.col("words").alias("a"), F.slice("words", F.lit(2), F.size("words")).alias("b"))
    places = rows.select("doc_id", "text_hash", F.posexplode(following).alias("at", "two"))
    hits = places.select("doc_id", "text_hash", "at", "two.a", "two.b").join(F.broadcast(pairs), ["a", "b"])
    last = F.floor(F.col("at") / F.col("class")).cast("int")
    # A window of 2c words from block * c on: a pair is in the last one that has begun, and in the one before
    # unless its second word is already behind that one's end.
    inside = F.array_compact(F.array(last, F.when((last > 0) & (F.col("at") % F.col("class") < F.col("class") - 1), last - 1)))
    windows = hits.select("doc_id", "text_hash", "class", "pair", F.explode(inside).alias("block"))
    return windows.groupBy("doc_id", "text_hash", "class", "block").agg(F.collect_set("pair").alias("shared"))


def _numbers() -> dict[tuple[str, str], int]:
    """A number for each different pair of words of the templates."""
    return {pair: i for i, pair in enumerate(sorted({(a, b) for *_, a, b in template_pairs()}))}


def _ranked_templates(spark: SparkSession, counts: DataFrame) -> tuple[dict[int, int], DataFrame]:
    """Ranks of pairs by frequency, rare ones first, and templates with sorted ranks and needed overlap."""
    found = {r["pair"]: r["n"] for r in counts.collect()}  # at most one row for each pair of the fixed list
    numbers = _numbers()
    order = {pair: i for i, pair in enumerate(sorted(numbers.values(), key=lambda p: (found.get(p, 0), p)))}
    templates: dict[tuple, list[int]] = {}
    for template, label, size, a, b in template_pairs():
        templates.setdefault((template, label, size), []).append(order[numbers[a, b]])
    rows = [(*key, sorted(ranks), needed(len(ranks))) for key, ranks in templates.items()]
    return order, spark.createDataFrame(rows, "template int, label string, class int, ranks array<int>, need int")


def needed(pairs: int) -> int:
    """How many of a template's pairs a block must have."""
    return math.ceil(pairs * THRESHOLD - 1e-9)


def contained(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_hash, label and share for every template contained in a block of a document."""
    spark = docs.sparkSession
    table = saved(blocks(docs, id_column, text_column))
    counts = table.select(F.explode("shared").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    order, templates = _ranked_templates(spark, counts)
    rank_of = F.array(*(F.lit(order[pair]) for pair in sorted(order)))
    prefixes = templates.select(
        "template", "label", "class", "ranks", "need",
        F.posexplode(F.slice("ranks", F.lit(1), F.size("ranks") - F.col("need") + 1)).alias("at", "rank"),
    )
    ranked = table.select("doc_id", "text_hash", "class", "block", F.array_sort(F.transform("shared", lambda p: F.get(rank_of, p))).alias("held"))
    rows = ranked.select("*", F.size("held").alias("size"), F.posexplode("held").alias("place", "rank"))
    bound = F.least(F.size("held") - F.col("place"), F.size("ranks") - F.col("at"))
    # Prefixes are part of the fixed list: a few hundred rows.
    met = rows.join(F.broadcast(prefixes), ["class", "rank"]).where((F.col("size") >= F.col("need")) & (bound >= F.col("need")))
    overlap = F.size(F.array_intersect("held", "ranks"))
    return (
        met.select("doc_id", "text_hash", "label", "need", overlap.alias("overlap"), F.size("ranks").alias("full"))
        .where("overlap >= need").select("doc_id", "text_hash", "label", (F.col("overlap") / F.col("full")).alias("share"))
    )


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is 1 where a base phrase stands, else the largest share of a template that a block
    contains, else 0.
    """
    found = (
        contained(docs, id_column, text_column).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), *(c.alias(n) for n, c in _base(text).items()))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
