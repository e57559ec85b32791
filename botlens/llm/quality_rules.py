"""Quality rules as a short-circuit cascade.

Every rule names the measure of a text it needs. Measures are computed when the first rule asks
for them and kept for the next one. On a bounded sample of texts each rule's cost (seconds a text)
and selectivity (share of texts it rejects) are measured; the rules then run in the order of
rejections per second, and the first rejection ends the work on a text. The order changes the
cost only: a text is kept if no rule rejects it, in any order.

Defined results: null text has no words, as has the empty one; both fail the word count. Repeated
rows give repeated results; an empty table gives an empty table; no column but the text is read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import arrow_column, fresh

#: White space between words, symbols that count, words of a repeat window.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


class Text:
    """Measures of one text, each computed when it is first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def _lines(self) -> tuple[int, int]:
        lines = [line for line in self.text.split("\n") if line.strip(SPACE)]
        return len(lines), len(lines) - len(set(lines))

    @property
    def n_lines(self) -> int:
        return self._lines[0]

    @property
    def n_dup_lines(self) -> int:
        return self._lines[1]

    @cached_property
    def _numbers(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of eight that the text holds twice or more.

        Windows are numbered by doubling: pairs of words, pairs of pairs, pairs of fours. As soon
        as all of a length differ, no longer one can repeat.
        """
        numbers, width = self._numbers, 1
        if len(numbers) <= WINDOW:
            return 0
        while width < WINDOW:
            high = int(numbers.max()) + 1
            both = numbers[:-width] * high + numbers[width:]
            width *= 2
            found, numbers, counts = np.unique(both, return_inverse=True, return_counts=True)
            if len(found) == len(both):
                return 0
        edges = np.zeros(self.n_words + 1, np.int64)
        starts = np.flatnonzero(counts[numbers] > 1)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(edges)))

    @cached_property
    def n_same_words(self) -> int:
        """Words equal to the word before."""
        return int(np.count_nonzero(self._numbers[1:] == self._numbers[:-1]))

    @cached_property
    def n_shouted(self) -> int:
        """Words of two letters or more without a small one."""
        return sum(1 for w in map(bytes.decode, self.words) if len(w) > 1 and w.isupper())


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a text fails; it must not depend on other rules."""

    name: str
    rejects: Callable[[Text], bool]


#: Rules that the base verdict consists of.
BASE = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
)
#: Production rules: the base and what marks tables, symbol noise, shouting, stutter and boilerplate.
RULES = (
    *BASE,
    Rule("symbols", lambda t: 100 * t.n_symbols > 10 * t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * t.n_lines),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
    Rule("shouting", lambda t: 100 * t.n_shouted > 50 * t.n_words),
    Rule("stutter", lambda t: 100 * t.n_same_words > 20 * t.n_words),
)


def passes(text: Text, rules: Sequence[Rule]) -> bool:
    return not any(rule.rejects(text) for rule in rules)


def measured_order(texts: Sequence[str | None], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Rules by rejections per second on the texts; without texts, the order as given."""
    if not texts:
        return list(rules)

    def value(rule: Rule) -> float:
        rejected, began = 0, time.perf_counter()
        for text in texts:
            rejected += rule.rejects(Text(text))
        return rejected / (time.perf_counter() - began + 1e-9)

    return sorted(rules, key=value, reverse=True)


def sampled_order(docs: DataFrame, text_column: str = "text", sample_rows: int = 500) -> list[str]:
    """Names of the rules in the order measured on up to ``sample_rows`` texts picked by hash."""
    picked = docs.where(F.pmod(F.xxhash64(text_column), F.lit(16)) == 0).select(text_column)
    texts = [row[0] for row in picked.limit(sample_rows).collect()]
    return [rule.name for rule in measured_order(texts)]


def _measures(names: Sequence[str]) -> Callable[[list], list]:
    ordered = [next(r for r in RULES if r.name == name) for name in names]

    def run(texts: list) -> list:
        out = []
        for value in texts:
            text = Text(value)
            failed = not passes(text, BASE)
            out.append({
                "n_words": text.n_words, "word_chars": text.word_chars, "n_symbols": text.n_symbols,
                "n_dup_lines": text.n_dup_lines, "n_repeat_words": text.n_repeat_words,
                "base_failed": failed, "kept": not failed and passes(text, ordered),
            })
        return out

    return run


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base measures and verdict of every text: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept."""
    kind = (
        "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint,"
        " n_repeat_words: bigint, base_failed: boolean, kept: boolean>"
    )
    made = arrow_column(_measures(sampled_order(docs, text_column)), kind)
    name = fresh(docs, "made")
    return docs.select(id_column, made(F.col(text_column)).alias(name)).select(id_column, f"{name}.*")


def kept_column(text: Column, order: Sequence[str]) -> Column:
    """Whether no rule rejects the text; rules run in the given order until one does."""
    ordered = [next(r for r in RULES if r.name == name) for name in order]
    return arrow_column(lambda texts: [passes(Text(t), ordered) for t in texts], "boolean")(text)


def kept_documents(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    return docs.where(kept_column(F.col(text_column), sampled_order(docs, text_column)))
