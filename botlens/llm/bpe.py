"""Byte-level BPE with bounded lookahead, and a decoder that is fed token by token.

**Encoding.** A pair at the right end of the bytes read so far may still merge differently once
more bytes arrive, but only so far back: :func:`sufficient_lookahead` computes from the merge
list how many bytes after a token decide whether it stands. Tokens that end at least that many
bytes before the end of what was read are final and leave the buffer, so a word of any length
takes a buffer of constant size.

**Decoding.** Bytes of tokens go through an incremental UTF-8 machine that holds back at most
three bytes of an unfinished character and turns broken sequences into U+FFFD.

Defined results: null text is the empty text (no token, empty decoding); repeated rows give
repeated results; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import arrow_column, fresh

#: The pre-tokenizer of the byte-level vocabularies, with Unicode's white space.
_SPLIT = regex.compile(
    r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def _of_kind(kind: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == kind)


#: The same for texts without characters from U+0250 on, with the classes written out: faster.
_WIDE = re.compile("[^\x00-\u024f]")
_NARROW_SPLIT = re.compile(
    r" ?[{L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+".format(
        L=_of_kind("L"), N=_of_kind("N"), S=r"\t-\r \x85\xa0"
    )
)
_RUNS = {
    "letters": regex.compile(r"\p{L}*"),
    "numbers": regex.compile(r"\p{N}*"),
    "symbols": regex.compile(r"[^\p{White_Space}\p{L}\p{N}]*"),
    "space": regex.compile(r"\p{White_Space}*"),
}
#: Characters read at a time, and the length from which an unfinished word is given out in parts.
_BLOCK, _LONG = 1 << 16, 1 << 12
#: Bytes of a long word that are merged at a time, besides the lookahead.
_WINDOW = 512
#: Words whose tokens are remembered.
_REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes after a token that decide whether it stands, for any text.

    ``ahead[v]``: the bytes after ``v`` that can matter for its standing at the current rank. The
    merge (u, v) takes u from whoever looks at it, if v follows and stands, which takes len(v) and
    what v needs; the token uv is as sure as v is. Ranks are taken in order, so one pass suffices.
    """
    ahead: dict[bytes, int] = {}
    for left, right in merges:
        need = ahead.get(right, 0)
        ahead[left] = max(ahead.get(left, 0), len(right) + need)
        ahead[left + right] = max(ahead.get(left + right, 0), need)
    return max(ahead.values(), default=0)


class Vocabulary:
    """Merge list, byte strings and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.bytes: dict[int, bytes] = {}
        for token, number in model["vocab"].items():
            if all(c in alphabet for c in token):
                self.bytes[number] = bytes(alphabet[c] for c in token)
            else:
                self.bytes[number] = token.encode()
        for token, number in self.special.items():
            self.bytes[number] = token.encode()
        number_of = {b: n for n, b in self.bytes.items() if n not in self.special.values()}
        self.first = [number_of.get(bytes([b]), -1) for b in range(256)]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        as_bytes = [tuple(bytes(alphabet[c] for c in part) for part in pair) for pair in pairs]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.made = [number_of[left + right] for left, right in as_bytes]
        for rank, (left, right) in enumerate(as_bytes):
            self.rank_of.setdefault((number_of[left], number_of[right]), rank)
        self.lookahead = sufficient_lookahead(as_bytes)
        self.words: dict[str, tuple[int, ...]] = {}
        self.text_of = {n: str(n) for n in self.bytes}

    def merge(self, data: bytes) -> list[int]:
        """Tokens of bytes that belong together: the lowest rank first, then the leftmost."""
        tokens = [self.first[b] for b in data]
        return self._merge_long(tokens) if len(tokens) > 64 else self._merge_short(tokens)

    def _merge_short(self, tokens: list[int]) -> list[int]:
        rank_of, made, none = self.rank_of.get, self.made, len(self.made)
        ranks = [rank_of(pair, none) for pair in zip(tokens, tokens[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            tokens[i] = made[best]
            del tokens[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((tokens[i - 1], tokens[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((tokens[i], tokens[i + 1]), none)
        return tokens

    def _merge_long(self, tokens: list[int]) -> list[int]:
        rank_of, size = self.rank_of.get, len(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = [(r, i, *p) for i, p in enumerate(zip(tokens, tokens[1:])) if (r := rank_of(p)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != left or j >= size or tokens[j] != right:
                continue
            tokens[i], tokens[j], after[i] = self.made[rank], -1, after[j]
            for k, m in ((before[i], i), (i, after[i])):
                if k >= 0 and m < size:
                    before[m] = k
                    pair = (tokens[k], tokens[m])
                    if (found := rank_of(pair)) is not None:
                        heapq.heappush(queue, (found, k, *pair))
        return [t for t in tokens if t >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        known = self.words.get(word)
        if known is None:
            known = tuple(self.merge(word.encode()))
            if len(self.words) >= _REMEMBERED:
                self.words.clear()
            self.words[word] = known
        return known


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class LongWord:
    """Tokens of one word that is fed in parts; holds a window and the lookahead at most."""

    def __init__(self, known: Vocabulary):
        self.known, self.held = known, b""

    def feed(self, data: bytes) -> Iterator[int]:
        self.held += data
        size, ahead = _WINDOW + self.known.lookahead, self.known.lookahead
        start = 0
        while len(self.held) - start >= size:
            end, sure = start, start + size - ahead
            for token in self.known.merge(self.held[start : start + size]):
                end += len(self.known.bytes[token])
                if end > sure:
                    break
                yield token
                start = end
        self.held = self.held[start:]

    def finish(self) -> list[int]:
        rest, self.held = self.known.merge(self.held), b""
        return rest


class Encoder:
    """Tokens of a text that is fed in blocks of any size."""

    def __init__(self, known: Vocabulary):
        self.known, self.carry, self.open, self.kind = known, "", None, ""

    def feed(self, block: str, last: bool = False) -> list[int]:
        text, out = self.carry + block, []
        self.carry = ""
        if self.open is not None:
            text = self._continue(text, last, out)
        if not text:
            return out
        words = (_SPLIT if _WIDE.search(text) else _NARROW_SPLIT).findall(text)
        # A word is sure once two more have begun: endings, contractions and white space look ahead.
        sure = words if last else words[:-2]
        get, word, extend = self.known.words.get, self.known.word, out.extend
        for w in sure:
            extend(get(w) or self._whole(w) if len(w) > _LONG else get(w) or word(w))
        self.carry = "" if last else "".join(words[-2:])
        if len(self.carry) > _LONG:
            self._open(words[-2:], out)
        return out

    def _whole(self, word: str) -> list[int]:
        long = LongWord(self.known)
        return [*long.feed(word.encode()), *long.finish()]

    def _open(self, words: list[str], out: list[int]) -> None:
        """The text ends within a long word: go on with it as an open one."""
        *before, word = words
        if before and len(word) <= 2:  # the long one is sure but for what a contraction takes
            return
        for w in before:
            out.extend(self._whole(w))
        body = word[1:] if word[0] == " " and len(word) > 1 and not word[1].isspace() else word
        self.kind = next(k for k, run in _RUNS.items() if run.match(body).end())
        self.open = LongWord(self.known)
        self._continue(word, False, out, head=len(word) - len(body))

    def _continue(self, text: str, last: bool, out: list[int], head: int = 0) -> str:
        """Feed the open word; returns the text after it, or nothing while the word goes on.

        The last white space of a run is carried: it goes with what follows, if anything does.
        """
        end = _RUNS[self.kind].match(text, head).end()
        if end == len(text) and not last:
            keep = end - 1 if self.kind == "space" and end else end
            out.extend(self.open.feed(text[:keep].encode()))
            self.carry = text[keep:]
            return ""
        if self.kind == "space" and end < len(text) and end:
            end -= 1
        out.extend(self.open.feed(text[:end].encode()))
        out.extend(self.open.finish())
        self.open = None
        return text[end:]


class Decoder:
    """Text of tokens that are fed in blocks of any size."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, tokens: list[int], last: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.known.bytes.__getitem__, tokens)), last)


def encode(known: Vocabulary, text: str) -> Iterator[list[int]]:
    """Blocks of tokens of a text. Special tokens written out in it are themselves."""
    parts = [text]
    if known.special and any(s in text for s in known.special):
        parts = regex.split(f"({'|'.join(map(regex.escape, known.special))})", text)
    for part in parts:
        if part in known.special:
            yield [known.special[part]]
            continue
        encoder = Encoder(known)
        for start in range(0, len(part), _BLOCK):
            yield encoder.feed(part[start : start + _BLOCK], start + _BLOCK >= len(part))


def digests(path: str, text: str | None) -> dict:
    """Count and digests of one text's tokens and of their decoding, block by block."""
    known = vocabulary(path)
    decoder, ids, decoded, count = Decoder(known), hashlib.sha256(), hashlib.sha256(), 0
    name = known.text_of.__getitem__
    for tokens in encode(known, text or ""):
        if tokens:
            ids.update((("," if count else "") + ",".join(map(name, tokens))).encode())
            count += len(tokens)
            decoded.update(decoder.feed(tokens).encode())
    decoded.update(decoder.feed([], True).encode())
    return {"n_tokens": count, "ids_sha256": ids.hexdigest(), "decoded_sha256": decoded.hexdigest()}


def encode_column(text: Column, path: str) -> Column:
    """Token ids of a text column; null is the empty text."""
    def ids(texts: list) -> list:
        known = vocabulary(path)
        return [[i for block in encode(known, t or "") for i in block] for t in texts]

    return arrow_column(ids, "array<int>")(text)


def decode_column(tokens: Column, path: str) -> Column:
    """Text of a column of token ids; null is the empty text."""
    def texts(lists: list) -> list:
        known = vocabulary(path)
        return [Decoder(known).feed(ids or [], True) for ids in lists]

    return arrow_column(texts, "string")(tokens)


def round_trips(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256."""
    kind = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
    made = arrow_column(lambda texts: [digests(path, t) for t in texts], kind)
    name = fresh(docs, "made")
    return docs.select(id_column, made(F.col(text_column)).alias(name)).select(id_column, f"{name}.*")
