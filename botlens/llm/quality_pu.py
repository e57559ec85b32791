"""Text quality by positive-unlabelled learning.

Trusted positives are documents with label 1; documents without a label are the unlabelled web text.
A small network minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss, so its output estimates the chance of being good. The class prior is estimated
first: classifiers of positives against unlabelled are trained on each half of the sample, and on the
halves they did not see the smallest ratio of (unlabelled above a score) to (positives above it), with
the sampling error of both added, is the share of positives among the unlabelled.

The fit uses a bounded sample, ``sample_rows`` positives and as many unlabelled documents, picked by
the hash of their ids; every document is scored. Labels come only from rows whose crc32 of the id as
text, mod 4, is not 2; label 0, language, source and id are never looked at.

Defined results: null text is the empty text; it has all measures 0 and a score like any other.
Documents without id are scored and not held out; they never take part in the fit. With no positives
or no unlabelled documents the score is 0.5 everywhere. Repeated rows get repeated scores.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botlens.llm.common import arrow_column, fresh
from botlens.llm.quality_rules import Text

#: A document counts as good from this score on.
THRESHOLD = 0.7
SAMPLE_ROWS = 20_000
_ENDS = tuple(".!?:;\"'»”…")


def measures(text: str | None) -> list[float]:
    """Numbers that describe the form of a text, whatever its language."""
    t = Text(text)
    n, chars = t.n_words, len(t.text)
    if not n:
        return [0.0] * 22
    count = t.text.count
    numbers = t._numbers
    kinds = np.bincount(numbers)
    letters = max(t.word_chars, 1)
    lines = max(t.n_lines, 1)
    ended = sum(1 for line in t.text.split("\n") if line.rstrip().endswith(_ENDS))
    upper, marks = t.n_shouted, count("!")
    return [
        math.log1p(n), math.log1p(chars), letters / n, t.n_symbols / n, count("|") / n, marks / n, count("?") / n,
        upper / n, sum(map(count, "0123456789")) / letters, count(".") / n, count(",") / n,
        t.n_same_words / n, len(kinds) / n, len(kinds) / math.sqrt(n), float(kinds.max()) / n, t.n_dup_lines / lines,
        t.n_repeat_words / n, n / lines, ended / lines, 1 - len(t.text.encode("ascii", "ignore")) / chars,
        sum(map(count, "()[]{}=/\\_")) / n, float(n < 20),
    ]


@dataclass(frozen=True)
class Model:
    """Standardisation and weights of the network, and the class prior it was fitted with."""

    middle: np.ndarray
    spread: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(rows), 0.5)
        return _sigmoid(_forward(self.weights, self._scaled(rows))[0])

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.middle) / self.spread, -8, 8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(weights: tuple[np.ndarray, ...], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    hidden = np.tanh(rows @ w1 + b1)
    return hidden @ w2 + b2[0], hidden


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 3000,
           hidden: int = 16, seed: int = 7) -> tuple[np.ndarray, ...]:
    """Adam on the non-negative risk; without a prior, on positives against unlabelled."""
    draw = np.random.default_rng(seed)
    width = positive.shape[1]
    weights = [draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), draw.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        p = positive[draw.integers(0, len(positive), 256)]
        u = unlabelled[draw.integers(0, len(unlabelled), 256)]
        rows = np.concatenate((p, u))
        out, inner = _forward(weights, rows)
        good = _sigmoid(out)
        slope = np.empty(len(rows))
        if prior is None:
            slope[:256], slope[256:] = (good[:256] - 1) / 512, good[256:] / 512
        else:
            loss_p, loss_u = np.logaddexp(0, out[:256]).mean(), np.logaddexp(0, out[256:]).mean()
            if loss_u - prior * loss_p >= 0:
                slope[:256] = prior * (good[:256] - 1) / 256 - prior * good[:256] / 256
                slope[256:] = good[256:] / 256
            else:  # the negative part has become negative: step back out of it
                slope[:256], slope[256:] = prior * good[:256] / 256, -good[256:] / 256
        back = np.outer(slope, weights[2]) * (1 - inner**2)
        slopes = [rows.T @ back, back.sum(0), inner.T @ slope, np.array([slope.sum()])]
        rate = 0.01 * (1 - step / (steps + 1))
        for i, g in enumerate(slopes):
            g = g + 1e-4 * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(weights)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from the scores of both on rows not trained on."""
    doubt = 1 / math.sqrt(len(unlabelled)) + 1 / math.sqrt(len(positive))
    at = np.sort(positive)
    above_p = 1 - np.arange(len(at)) / len(at)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), at) / len(unlabelled)
    best = int(np.argmin((above_u + doubt) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """Model of measure rows; needs two rows of each kind."""
    width = 22
    if min(len(positive), len(unlabelled)) < 2:
        return Model(np.zeros(width), np.ones(width), (), 0.5)
    every = np.concatenate((positive, unlabelled))
    shape = Model(every.mean(0), every.std(0) + 1e-6, (), 0.5)
    p, u = shape._scaled(positive), shape._scaled(unlabelled)
    held_p, held_u = np.empty(len(p)), np.empty(len(u))
    for half in (0, 1):
        apart = _train(p[half::2], u[half::2], None, steps=1500)
        for held, rows in ((held_p, p), (held_u, u)):
            held[1 - half :: 2] = _sigmoid(_forward(apart, rows[1 - half :: 2])[0])
    prior = estimated_prior(held_p, held_u)
    return Model(shape.middle, shape.spread, _train(p, u, prior), prior)


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id",
            text_column: str = "text") -> Model:
    """Fit on at most ``sample_rows`` trusted positives and ``sample_rows`` unlabelled documents."""
    marked = labels.where("quality is not null").select(F.col("doc_id").alias("_id"), "quality")
    good = marked.where((F.col("quality") == 1) & ~held_out(F.col("_id"))).select("_id").distinct()
    ids = docs.select(F.col(id_column).alias("_id")).where("_id is not null")
    unmarked = ids.join(marked, "_id", "left_anti").distinct()

    def some(rows: DataFrame, kind: int) -> DataFrame:
        return rows.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows).withColumn("_kind", F.lit(kind))

    # At most 2 * sample_rows ids, whatever the size of the tables: small enough to broadcast.
    picked = F.broadcast(some(good, 1).union(some(unmarked, 0)))
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(picked, "_id")
    rows = texts.select("_kind", "_id", measure_column(F.col("_text")).alias("_x")).toArrow()
    order = np.lexsort((rows["_id"].to_numpy(), rows["_kind"].to_numpy()))
    kind = rows["_kind"].to_numpy()[order]
    x = np.array(rows["_x"].to_pylist(), float).reshape(-1, 22)[order]
    draw = np.random.default_rng(11).permutation(len(x))
    x, kind = x[draw], kind[draw]
    return fit(x[kind == 1], x[kind == 0])


def measure_column(text: Column) -> Column:
    return arrow_column(lambda texts: [measures(t) for t in texts], "array<double>")(text)


def _scores(model: Model, texts: list) -> list:
    return model.scores(np.array([measures(t) for t in texts]).reshape(-1, 22)).tolist()


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    name = fresh(docs, "score")
    score = arrow_column(functools.partial(_scores, model), "double")(F.col(text_column))
    rows = docs.select(id_column, score.alias(name))
    predicted = (F.col(name) >= THRESHOLD).cast("int")
    return rows.select(id_column, held_out(F.col(id_column)).alias("held_out"), F.col(name).alias("score"), predicted.alias("predicted"))
