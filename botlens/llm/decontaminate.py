"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' normalised words go into one automaton. Each document's words are streamed through it;
after each word the state and the matching length tell the longest run of words, ending here, that
some item holds. A run of ``window`` words or more is a hit, and so is a whole item that is shorter.
Only runs of words that all occur in items are streamed: any other word sets the automaton back to
its start anyway.

Items are collected in shards of at most ``max_words`` words, one automaton each, by hash of the
item; one shard is the usual case. More items mean more passes, never dropped items.

Defined results: null and empty texts have no words and no hits, null and empty items no windows.
Items without id can hit but are not listed; repeated item ids are listed once. Rows that share
doc_id and text share their result. Empty tables give empty results or no hits.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Sequence
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import LOWER, arrow_column, fresh

WINDOW = 10
#: ASCII that is no letter or digit parts words; A-Z becomes a-z.
_WORDS = bytes(
    32 if b < 128 and not chr(b).isalnum() else LOWER[b] for b in range(256)
)
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton over words; state 0 is the start."""

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.words: dict[bytes, int] = {}
        self.items: list[object] = []
        numbered = []
        for item, text in items:
            words = words_of(text)
            if words:
                numbered.append([self.words.setdefault(w, len(self.words)) for w in words])
                self.items.append(item)
                self._add(numbered[-1])
        self.shortest = min((min(len(n), window) for n in numbered), default=window)
        # Items of each state whose longest string has a window or more; short items by their state.
        self.holders: dict[int, list[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for k, numbers in enumerate(numbered):
            state, marked = 0, set()
            for number in numbers:
                state = self.next[state][number]
                above = state
                while above > 0 and self.length[above] >= window and above not in marked:
                    marked.add(above)
                    self.holders.setdefault(above, []).append(k)
                    above = self.link[above]
            if len(numbers) < window:
                self.short.setdefault(state, []).append((len(numbers), k))
        self.short_above: dict[int, int] = {}  # nearest state on the way up that ends a short item
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            link = self.link[state]
            if link in self.short or link in self.short_above:
                self.short_above[state] = link if link in self.short else self.short_above[link]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.link) - 1

    def _split(self, state: int, word: int, length: int) -> int:
        """A state for the shorter strings of the one that ``word`` leads to."""
        target = self.next[state][word]
        copy = self._state(length, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _add(self, numbers: Sequence[int]) -> None:
        last = 0
        for word in numbers:
            if word in self.next[last]:
                target, length = self.next[last][word], self.length[last] + 1
                last = target if self.length[target] == length else self._split(last, word, length)
                continue
            state = self._state(self.length[last] + 1, 0, {})
            above = last
            while above >= 0 and word not in self.next[above]:
                self.next[above][word] = state
                above = self.link[above]
            if above >= 0:
                target, length = self.next[above][word], self.length[above] + 1
                self.link[state] = target if self.length[target] == length else self._split(above, word, length)
            last = state

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit runs (first word, word after the last; merged, ascending) and the items found."""
        known = np.array(list(map(self.words.get, words, repeat(-1))), np.int64)
        edges = np.diff(np.concatenate(([0], (known >= 0).view(np.int8), [0])))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = stops - starts >= self.shortest
        runs: list[tuple[int, int]] = []
        found: set[int] = set()
        for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
            self._run(known[start:stop].tolist(), start, runs, found)
        return runs, found

    def _run(self, numbers: list[int], offset: int, runs: list, found: set[int]) -> None:
        following, link, lengths, window = self.next, self.link, self.length, self.window
        state = length = 0
        for position, word in enumerate(numbers, offset + 1):
            target = following[state].get(word)
            while target is None and state:
                state = link[state]
                length = lengths[state]
                target = following[state].get(word)
            if target is None:
                length = 0
                continue
            state, length = target, length + 1
            hit = 0
            if length >= window:
                hit, above = length, state
                while lengths[link[above]] >= window:
                    above = link[above]
                found.update(self.holders[above])
            if self.short:
                above = state if state in self.short else self.short_above.get(state)
                while above is not None:
                    for size, item in self.short[above]:
                        if size <= length:
                            found.add(item)
                            hit = max(hit, size)
                    above = self.short_above.get(above)
            if hit:
                first = position - hit
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, position))


def cut(automata: Sequence[Automaton], text: str | None, runs: Sequence[tuple[int, int]]) -> str | None:
    """The text without the hit words; what grows together and hits anew is cut too."""
    while runs:
        spans = [m.span() for m in _WORD.finditer(text)]
        kept, at = [], 0
        for first, stop in runs:
            kept.append(text[at : spans[first][0]])
            at = spans[stop - 1][1]
        text = "".join([*kept, text[at:]])
        words = words_of(text)
        runs = merged(run for a in automata for run in a.matches(words)[0])
    return text


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, stop in sorted(runs):
        if out and out[-1][1] >= first:
            first, stop = out[-1][0], max(stop, out.pop()[1])
        out.append((first, stop))
    return out


def automata(items: DataFrame, window: int = WINDOW, max_words: int = 200_000,
             id_column: str = "item_id", text_column: str = "text") -> list[Automaton]:
    """One automaton for each ``max_words`` words of the items, which are counted first."""
    size = F.sum(F.octet_length(text_column))  # a word takes two bytes with the space after it
    total = items.agg(size).first()[0] or 0
    shards = -(-total // (2 * max_words)) or 1
    shard = F.pmod(F.xxhash64(text_column), F.lit(shards))
    rows = items.where(F.col(text_column).isNotNull()).select(id_column, text_column)
    return [Automaton(rows.where(shard == k).collect(), window) for k in range(shards)]


def _scan(parts: Sequence[Automaton], texts: list) -> list:
    out = []
    for text in texts:
        words = words_of(text)
        runs, items = [], set()
        for part in parts:
            hits, found = part.matches(words)
            runs += hits
            items |= {part.items[k] for k in found}
        runs = merged(runs) if len(parts) > 1 else runs
        listed = sorted(str(i) for i in items if i is not None)
        hit = sum(stop - first for first, stop in runs)
        out.append({
            "n_words": len(words), "n_hit": hit, "n_items": len(items),
            "items_sha256": hashlib.sha256(",".join(listed).encode()).hexdigest(),
            "contaminated": hit > 0,
        })
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_words: int = 200_000,
                  id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    kind = "struct<n_words: bigint, n_hit: bigint, n_items: bigint, items_sha256: string, contaminated: boolean>"
    scan = functools.partial(_scan, automata(items, window, max_words))
    name = fresh(docs, "made")
    made = arrow_column(scan, kind)(F.col(text_column)).alias(name)
    return docs.select(id_column, made).select(id_column, f"{name}.*")


def _clean(parts: Sequence[Automaton], max_coverage: float, texts: list) -> list:
    out = []
    for text in texts:
        words = words_of(text)
        runs = merged(run for part in parts for run in part.matches(words)[0])
        hit = sum(stop - first for first, stop in runs)
        dropped = bool(words) and hit > max_coverage * len(words)
        out.append({"dropped": dropped, "text": None if dropped else cut(parts, text, runs)})
    return out


def clean_text(text: Column, parts: Sequence[Automaton], max_coverage: float = 0.5) -> Column:
    """Struct of ``dropped`` (more than ``max_coverage`` of the words are hits) and the ``text``
    without hit words; null text stays null."""
    return arrow_column(functools.partial(_clean, parts, max_coverage), "struct<dropped: boolean, text: string>")(text)


def decontaminated(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5,
                   window: int = WINDOW, text_column: str = "text") -> DataFrame:
    """Documents with hit words cut out, without those that mostly consist of hits; columns stay."""
    name = fresh(docs, "clean")
    clean = clean_text(F.col(text_column), automata(items, window), max_coverage)
    rows = docs.withColumn(name, clean).where(~F.col(f"{name}.dropped"))
    return rows.withColumn(text_column, F.col(f"{name}.text")).drop(name)
