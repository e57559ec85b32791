"""Hashes of words, lines and shingles of whole Arrow batches, and circulant MinHash.

Hashes of byte ranges come from one prefix sum per batch: every byte value has a fixed random
64-bit number, position i weighs it with ``BASE ** i``, and the sum of a range times the inverse
power of its start does not depend on where the range stands. A final mix spreads the bits.

Circulant MinHash takes two permutations of 2 ** 20 places: the first (a mixed hash, its top bits)
places a shingle, the second ranks the places. Coordinate k is the least rank among the places
shifted by k, so all coordinates of a shingle are one contiguous piece of the second permutation.
"""

from __future__ import annotations

import functools

import numpy as np

from botlens.llm.common import LOWER

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACES = 20
LOWER_TABLE = np.frombuffer(LOWER, np.uint8)
SPACE_TABLE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    v = values ^ np.uint64(salt * 0xD1342543DE82EF95 % (1 << 64))
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def _byte_numbers(salt: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64), 1000 + salt)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for positions below ``size`` at least."""
    if len(_powers[0]) < size:
        size = 1 << (size - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Ranges:
    """Hashes of any byte ranges of one array."""

    def __init__(self, data: np.ndarray, salt: int = 0):
        up, self.down = _power(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_numbers(salt)[data] * up[: len(data)], out=self.sums[1:])

    def hash(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts])


def edges(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs of True that do not cross a bound."""
    size = len(mask)
    inner = bounds[(bounds > 0) & (bounds < size)]
    before = np.zeros(size, bool)
    before[1:] = mask[:-1]
    before[inner] = False
    after = np.zeros(size, bool)
    after[:-1] = mask[1:]
    after[inner - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


@functools.lru_cache(maxsize=4)
def _ranks(coordinates: int) -> np.ndarray:
    """Pieces of ``coordinates`` ranks that begin at each place; the permutation closes to a ring."""
    places = np.arange(1 << _PLACES, dtype=np.uint64)
    ranks = np.argsort(mix(places, 77), kind="stable").astype(np.int32)
    ring = np.concatenate([ranks, ranks[:coordinates]])
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set of 64-bit shingles (repeats do no harm)."""
    pieces = _ranks(coordinates)
    places = (mix(shingles, 5) >> np.uint64(64 - _PLACES)).astype(np.int64)
    best = pieces[places[:2048]].min(axis=0)
    for at in range(2048, len(places), 2048):
        np.minimum(best, pieces[places[at : at + 2048]].min(axis=0), out=best)
    return best


#: Parts into which :func:`signatures` deals a set, pieces that are reduced together, pieces and sets at a time.
_PARTS, _FOLD, _HELD, _SETS = 4, 16, 4096, 1024
#: Sets below this size have a sketch of the whole.
_FEW = 64


@functools.lru_cache(maxsize=4)
def _coded_ranks(coordinates: int) -> np.ndarray:
    """The pieces of :func:`_ranks` as one item each, ranks in 16 bits: below 4096 as they are, above with twelve
    bits after the leading one. Equal ranks stay equal; of different ones less than one in 4096 become so."""
    ranks = np.ascontiguousarray(_ranks(1)[:, 0]).astype(np.int64)
    shift = np.maximum(np.floor(np.log2(np.maximum(ranks, 1))).astype(np.int64) - 12, 0)
    codes = (shift * 4096 + (ranks >> shift)).astype(np.uint16)
    ring = np.concatenate([codes, codes[:coordinates]])
    return np.ndarray((1 << _PLACES,), f"V{2 * coordinates}", ring, strides=(2,))


def signatures(shingles: np.ndarray, ends: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Circulant MinHash of many non-empty sets, and their sizes up to collisions of places: set i is
    ``shingles[ends[i]:ends[i + 1]]``, well mixed numbers, with repeats at will.

    Two bits of a shingle say which quarter of the coordinates it counts for. The similarities of the quarters spread
    around that of the sets, and the chance that no band agrees does not rise by that (its logarithm is concave in the
    similarity). A set without shingles for a quarter gives all it has.
    """
    found = [_signed(shingles, ends[i : i + _SETS + 1], coordinates) for i in range(0, len(ends) - 1, _SETS)]
    if not found:
        return np.zeros((0, coordinates), np.uint16), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def sketches(shingles: np.ndarray, ends: np.ndarray, signed: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """Lowest bits of so many coordinates of the whole sets that are small, then of the quarters of those that are not.

    Quarters of few shingles may have none in common, so sets that can be three quarters of a small one or the other way
    round have both kinds; zeros stand for the kind that a set has not.
    """
    out = np.zeros((len(sizes), 2 * words), np.int64)
    of_part = signed.reshape(len(signed), _PARTS, signed.shape[1] // _PARTS)[:, :, : 64 * words // _PARTS]
    out[:, words:] = _bits(of_part.reshape(len(signed), 64 * words))
    out[sizes < _FEW, words:] = 0
    pieces = _coded_ranks(64 * words)
    small = np.flatnonzero(sizes < _FEW * 3 // 2)
    starts, counts = ends[small], ends[small + 1] - ends[small]
    stops = np.cumsum(counts)
    at = 0
    while at < len(small):  # so many sets at a time that their pieces stay small
        end = max(at + 1, int(np.searchsorted(stops, stops[at] - counts[at] + _HELD, "right")))
        begin = stops[at:end] - counts[at:end] - (stops[at] - counts[at])
        own = np.arange(counts[at:end].sum()) + np.repeat(starts[at:end] - begin, counts[at:end])
        places = (mix(shingles[own], 7) >> np.uint64(64 - _PLACES)).astype(np.int64)
        lows = np.minimum.reduceat(pieces[places].view(np.uint16).reshape(-1, 64 * words), begin, axis=0)
        out[small[at:end], :words] = _bits(lows)
        at = end
    return out


def _bits(coordinates: np.ndarray) -> np.ndarray:
    return np.packbits(coordinates & 1, axis=1).view(np.int64)


def _signed(shingles: np.ndarray, ends: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for few sets: set, quarter and place are one number of 32 bits."""
    count, width = len(ends) - 1, coordinates // _PARTS
    pieces = _coded_ranks(width)
    taken = (shingles[ends[0] : ends[-1]] >> np.uint64(62 - _PLACES)).astype(np.uint32)
    taken |= np.repeat(np.arange(count, dtype=np.uint32) << np.uint32(_PLACES + 2), np.diff(ends))
    taken.sort()
    taken = taken[np.append(True, taken[1:] != taken[:-1])]
    parts = (taken >> np.uint32(_PLACES)).astype(np.int32)
    places = (taken & np.uint32((1 << _PLACES) - 1)).astype(np.int32)
    held = np.bincount(parts, minlength=count * _PARTS)
    sizes = held.reshape(count, _PARTS).sum(axis=1)
    bare = np.flatnonzero(held == 0)
    if len(bare):
        first = np.concatenate(([0], np.cumsum(sizes)))
        given = sizes[bare // _PARTS]
        at = np.arange(given.sum()) - np.repeat(np.cumsum(given) - given, given) + np.repeat(first[bare // _PARTS], given)
        order = np.argsort(np.concatenate((parts, np.repeat(bare, given))), kind="stable")
        places = np.concatenate((places, places[at]))[order]
        held[bare] = given
    # Each part is filled up with its last place to whole folds; every part has coordinates of its own.
    folds = (held + _FOLD - 1) // _FOLD
    starts, stops = np.cumsum(held) - held, np.cumsum(folds)
    begin = (stops - folds) * _FOLD
    at = np.arange(stops[-1] * _FOLD, dtype=np.int32) + np.repeat((starts - begin).astype(np.int32), folds * _FOLD)
    at = np.minimum(at, np.repeat((starts + held - 1).astype(np.int32), folds * _FOLD), out=at)
    shift = np.arange(count * _PARTS, dtype=np.int32) % _PARTS * width
    places = places[at] + np.repeat(shift, folds * _FOLD) & (1 << _PLACES) - 1
    lows = np.empty((stops[-1], width), np.uint16)
    for at in range(0, len(places), _HELD):
        block = pieces[places[at : at + _HELD]].view(np.uint16).reshape(-1, _FOLD * width)
        half = _FOLD * width // 2
        while half >= width:
            block = np.minimum(block[:, :half], block[:, half : 2 * half])
            half //= 2
        lows[at // _FOLD : at // _FOLD + len(block)] = block
    return np.minimum.reduceat(lows, stops - folds, axis=0).reshape(count, coordinates), sizes


@functools.lru_cache(maxsize=8)
def _weights(size: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, size + 1, dtype=np.uint64), salt) | np.uint64(1)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each signature; bands have keys of their own."""
    rows = signatures.shape[1] // bands
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    sums = (parts * _weights(rows, 31)).sum(axis=2, dtype=np.uint64) + _weights(bands, 32)
    return mix(sums).view(np.int64)


def sequences(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` neighbouring values."""
    count = len(values) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    weights = _weights(length, 33)
    out = values[:count] * weights[0]
    for j in range(1, length):
        out = out + values[j : j + count] * weights[j]
    return mix(out)
