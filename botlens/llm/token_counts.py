"""Exact unigram-tokenizer token counts, without making the tokens.

An Aho-Corasick automaton over the vocabulary names every piece that ends at each character; dynamic
programming carries, for each place, the best score of a segmentation that ends there and its number
of tokens. No back pointers are kept, only the last places that a piece can reach back to.

Fixed rules of the tokenizer: spaces become U+2581, one is put in front of the text; scores add up in
double precision; at each place pieces are tried from the longest to the shortest and a later one
must be strictly better; a character that is no piece of its own costs ten less than the lowest score
and counts as its UTF-8 bytes.

No piece goes on with U+2581 after another character (checked when a vocabulary is read), so every
segmentation breaks before such a run and texts fall into chunks; counts of short chunks are kept.

Defined results: null and empty texts have no tokens. Repeated rows give repeated results; an empty
table gives an empty table; no column but the text is read.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import arrow_column, fresh

#: The mark of a space and what an unknown character costs.
MARK, UNKNOWN_COST = "▁", 10.0
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Chunks up to this length have their counts remembered, this many of them.
_SHORT, _REMEMBERED = 40, 300_000


class Pieces:
    """Vocabulary of a unigram model: piece to score."""

    def __init__(self, scores: dict[str, float]):
        if any(MARK in piece.lstrip(MARK) for piece in scores):
            raise ValueError("a piece holds a space mark after another character")
        self.longest = max(map(len, scores))
        self.unknown = min(scores.values()) - UNKNOWN_COST
        self.found = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.found.add_word(piece, (len(piece), score))
        self.found.make_automaton()
        self.counts: dict[str, tuple[int, int]] = {}

    def count(self, chunk: str) -> tuple[int, int]:
        """Tokens of a chunk and how many of them are bytes of unknown characters."""
        known = self.counts.get(chunk)
        if known is None:
            known = self._best(chunk)
            if len(chunk) <= _SHORT:
                if len(self.counts) >= _REMEMBERED:
                    self.counts.clear()
                self.counts[chunk] = known
        return known

    def _best(self, chunk: str) -> tuple[int, int]:
        # Ring buffers over the places that pieces reach back to; place p is held at p % size.
        size = self.longest + 1
        scores, tokens, unknown = [0.0] * size, [0] * size, [0] * size
        place = 0
        matches = self.found.iter(chunk)
        end, piece = next(matches, (len(chunk), None))
        while place < len(chunk):
            best, best_tokens, best_unknown, single = None, 0, 0, False
            while end == place:
                length, score = piece
                at = (place + 1 - length) % size
                total = scores[at] + score
                if best is None or total > best:
                    best, best_tokens, best_unknown = total, tokens[at] + 1, unknown[at]
                single = single or length == 1
                end, piece = next(matches, (len(chunk), None))
            if not single:
                at = place % size
                total = scores[at] + self.unknown
                if best is None or total > best:
                    extra = len(chunk[place].encode())
                    best, best_tokens, best_unknown = total, tokens[at] + extra, unknown[at] + extra
            place += 1
            at = place % size
            scores[at], tokens[at], unknown[at] = best, best_tokens, best_unknown
        return tokens[place % size], unknown[place % size]

    def text_counts(self, text: str | None) -> tuple[int, int]:
        """Tokens of a whole text and how many of them are bytes."""
        if not text:
            return 0, 0
        marked = MARK + text.replace(" ", MARK)
        tokens = unknown = 0
        known, count = self.counts.get, self.count
        for chunk in _CHUNK.finditer(marked) if len(marked) > 1 << 20 else _CHUNK.findall(marked):
            if not isinstance(chunk, str):
                chunk = chunk.group()
            found = known(chunk) or count(chunk)
            tokens += found[0]
            unknown += found[1]
        return tokens, unknown


def read_pieces(path: str) -> dict[str, float]:
    """Pieces and scores of a vocabulary file, without control, unknown, byte and unused ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skipped = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    numbers = (i for i in range(model.get_piece_size()) if not any(is_so(i) for is_so in skipped))
    return {model.id_to_piece(i): model.get_score(i) for i in numbers}


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(read_pieces(path))


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_chars, n_tokens, n_bytes (tokens that are bytes of unknown characters)."""
    def run(texts: list) -> list:
        known, out = pieces(path), []
        for text in texts:
            tokens, unknown = known.text_counts(text)
            out.append({"n_chars": len(text or ""), "n_tokens": tokens, "n_bytes": unknown})
        return out

    made = arrow_column(run, "struct<n_chars: bigint, n_tokens: bigint, n_bytes: bigint>")
    name = fresh(docs, "made")
    return docs.select(id_column, made(F.col(text_column)).alias(name)).select(id_column, f"{name}.*")
