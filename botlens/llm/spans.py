"""Where a pattern stands in a text, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 256


def _sums(values: Column) -> Column:
    """0 and the running sums of an array of numbers."""
    start = F.array(F.lit(0))
    return F.aggregate(values, start, lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x)))


def running_sums(values: Column) -> Column:
    """0 and the running sums; long arrays go piece by piece, so their cost stays near linear."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")),
        lambda i: F.slice(values, i * _CHUNK + 1, F.lit(_CHUNK)),
    )
    bases = _sums(F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x)))
    inner = F.transform(
        F.arrays_zip(pieces.alias("p"), F.slice(bases, 1, F.size(pieces)).alias("b")),
        lambda z: F.transform(F.slice(_sums(z["p"]), 2, F.size(z["p"])), lambda x: x + z["b"]),
    )
    long = F.concat(F.array(F.lit(0)), F.flatten(inner))
    return F.when(F.size(values) <= _CHUNK, _sums(values)).otherwise(long)


def gaps(text: Column, pattern: str, guard: Column | None = None) -> tuple[Column, Column]:
    """The text between matches and the matches, as arrays; no match gives the text and no match.

    ``guard`` is a cheap condition that every text with a match fulfils.
    """
    there = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    between = F.when(there, F.split(text, pattern, -1)).otherwise(F.array(text))
    found = F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return between, found


def starts(between: Column, found: Column) -> Column:
    """Start of each match in code points."""
    steps = F.transform(
        F.arrays_zip(F.slice(between, 1, F.size(found)).alias("g"), found.alias("m")),
        lambda z: F.length(z["g"]) + F.length(z["m"]),
    )
    before = F.slice(running_sums(steps), 1, F.size(found))
    return F.transform(
        F.arrays_zip(before.alias("b"), F.slice(between, 1, F.size(found)).alias("g")),
        lambda z: z["b"] + F.length(z["g"]),
    )
