"""Machine-learning steps on window features, all on MLlib or plain columns."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from botlens import values
from botlens.functions import scores
from botlens.operators.neighbours import nearest_rows

UNSCALED_FEATURES = tuple(n for n in values.FEATURE_NAMES if n not in values.SCALED_FEATURES)


def assemble_features(windows: DataFrame) -> DataFrame:
    """All model features as doubles: a missing column or a NULL becomes 0."""
    return windows.withColumns(dict(zip(values.FEATURE_NAMES, _feature_columns(windows), strict=True)))


def _feature_columns(windows: DataFrame) -> list[Column]:
    def feature(name: str) -> Column:
        if name not in windows.columns:
            return F.lit(0.0)
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    return [feature(name) for name in values.FEATURE_NAMES]


def scaling_stages() -> list:
    """Pipeline stages that standardize the numeric features and keep the others."""
    return [
        VectorAssembler(inputCols=list(values.SCALED_FEATURES), outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *UNSCALED_FEATURES], outputCol="features"),
    ]


def scale_features(features: DataFrame) -> DataFrame:
    """Replace the numeric features by their standard scores."""
    model = Pipeline(stages=scaling_stages()[:2]).fit(features)
    scaled = model.transform(features).withColumn("_s", vector_to_array("scaled"))
    named = {name: F.col("_s")[i] for i, name in enumerate(values.SCALED_FEATURES)}
    return scaled.withColumns(named).drop("_s", "numeric", "scaled")


def class_weights(labeled: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight``, so that both classes (0 and 1) weigh the same in total.

    The class sizes are one aggregated row that every task reads as a constant. Rows
    without a label are left out.
    Input that is costly to compute should be checkpointed: it is read twice.
    """
    labeled = labeled.where(F.col(label).isNotNull())
    total = F.count(F.lit(1))
    size = labeled.agg(total.alias("n"), F.sum(F.col(label).cast("bigint")).alias("p"))
    rows = size.select(F.struct("n", "p")).scalar()
    ones = rows["p"]
    mine = F.when(F.col(label) == 1, ones).otherwise(rows["n"] - ones)
    return labeled.withColumn("weight", rows["n"] / (mine * 2))


CELL_FEATURES = (
    "Request_Type", "Protocol", "ua_is_empty", "ua_is_tool", "ua_is_browser",
    "is_encrypted", "is_failure",
)


def unit_hash(*parts: Column) -> Column:
    """A repeatable number in [0, 1) made from the parts."""
    digest = F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(2**32))


def oversample(labeled: DataFrame, key: Column, label: str = "label") -> DataFrame:
    """Repeat rows of the smaller class (0 or 1) until both have about the same size.

    Every row is repeated the whole number of times the ratio asks for; a hash of
    ``key`` decides who gets the fractional copy, so a rerun gives the same rows.
    ``copy`` numbers the copies from 0. Rows without a label are left out. Many copies
    are made in two steps, so that no row holds them all.
    """
    labeled = labeled.where(F.col(label).isNotNull())
    size = labeled.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("p")
    ).select(F.struct("n", "p")).scalar()
    ones, zeros = size["p"], size["n"] - size["p"]
    mine = F.when(F.col(label) == 1, ones).otherwise(zeros)
    ratio = F.greatest(ones, zeros) / mine
    whole = F.floor(ratio)
    copies = whole + (unit_hash(key.cast("string")) < ratio - whole).cast("int")
    span = 1000
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / span))
    some = labeled.withColumns({"_copies": copies, "_block": F.explode(blocks)})
    numbers = F.sequence(F.col("_block") * span, F.least(F.col("_block") * span + (span - 1), F.col("_copies") - 1))
    return some.withColumn("copy", F.explode(numbers)).drop("_copies", "_block")


_NUMERIC_FEATURES = tuple(n for n in values.FEATURE_NAMES if n not in CELL_FEATURES)


def interpolate_minority(
    features: DataFrame, key: str, label: str = "label", copies: int = 1, pieces: int = 64
) -> DataFrame:
    """Synthetic rows of class 1, each between a row and a near one of its class (SMOTE).

    Rows with the same 0/1 features form a cell, so those features stay 0 or 1. In
    a cell, rows stand in the order of the size of their numeric features (in
    steps), then of a hash of the key; each is combined with the ``copies`` rows
    after it, and after the last row the first ones follow. So every row makes
    exactly ``copies`` rows, and a cell of one row repeats itself.

    Rows are sorted in pieces: a size step and one of ``pieces`` ranges of the hash.
    A piece gets the first rows of those after it, so the result does not depend
    on ``pieces`` and no task sorts a whole cell.
    """
    minority = features.where(F.col(label) == 1).select(
        F.col(key).cast("string").alias(key),
        *[F.col(name).cast("double").alias(name) for name in values.FEATURE_NAMES],
    )
    size = sum((F.log1p(F.abs(n)) for n in _NUMERIC_FEATURES), F.lit(0.0))
    cell = list(CELL_FEATURES)
    placed = minority.withColumns({
        "_step": F.floor(size * 8), "_hash": unit_hash(F.col(key)),
        "_piece": F.floor(unit_hash(F.col(key)) * pieces), "_row": F.struct(*_NUMERIC_FEATURES),
    })
    piece = Window.partitionBy(*cell, "_step", "_piece")
    in_piece = piece.orderBy("_hash", key)
    steps = range(1, copies + 1)
    ordered = placed.withColumns({
        "_at": F.row_number().over(in_piece), "_rows": F.count(F.lit(1)).over(piece),
        **{f"_next{n}": F.lead("_row", n).over(in_piece) for n in steps},
    })
    # The first rows of each piece, at most ``copies``; a cell has a bounded number of pieces.
    heads = (
        ordered.where(F.col("_at") <= copies).groupBy(*cell, "_step", "_piece")
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_row"))).alias("_head"))
        .select(*cell, "_step", "_piece", F.transform("_head", lambda h: h["_row"]).alias("_head"))
    )
    in_cell = Window.partitionBy(*cell).orderBy("_step", "_piece")
    following = F.flatten(F.collect_list("_head").over(in_cell.rowsBetween(1, copies)))
    start = F.slice(F.flatten(F.collect_list("_head").over(
        Window.partitionBy(*cell).orderBy("_step", "_piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )), 1, copies)
    after = heads.select(
        *cell, "_step", "_piece",
        F.slice(F.concat(following, F.flatten(F.array_repeat(start, copies))), 1, copies).alias("_after"),
    )
    joined = ordered.join(after, [*cell, "_step", "_piece"])
    others = F.array(*[
        F.struct(
            F.lit(n).alias("step"),
            F.when(F.col("_at") + n <= F.col("_rows"), F.col(f"_next{n}"))
            .otherwise(F.get("_after", F.col("_at") + n - F.col("_rows") - 1)).alias("row"),
        )
        for n in steps
    ])
    pairs = joined.withColumn("_other", F.explode(others))
    share = unit_hash(F.col(key), F.col("_other.step").cast("string"))
    between = {
        n: F.col(n) + F.col("_share") * (F.col(f"_other.row.{n}") - F.col(n)) for n in _NUMERIC_FEATURES
    }
    made = pairs.withColumn("_share", share).withColumns(between)
    new_key = F.concat_ws("|", key, F.col("_other.step").cast("string"))
    return made.select(
        new_key.alias(key), *values.FEATURE_NAMES, F.lit(1).alias(label)
    )


#: Steps of a standard deviation in which :func:`interpolate_nearest` measures.
NEAREST_STEPS = 10_000


def interpolate_nearest(features: DataFrame, key: str, label: str = "label", copies: int = 1) -> DataFrame:
    """Synthetic rows of class 1, each between a row and one of its nearest rows (SMOTE by nearest neighbours).

    Rows with the same 0/1 features are neighbours, by distance of their numeric features in standard deviations
    of the class (in steps of a ten-thousandth), then by key. Row n of the ``copies`` goes towards the n-th nearest; with
    fewer neighbours it starts over, and a row without any repeats itself. So every row makes exactly ``copies``.
    Input that is costly to compute should be checkpointed: it is read more than once.
    """
    numeric = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in _NUMERIC_FEATURES]
    flags = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in CELL_FEATURES]
    minority = features.where(F.col(label) == 1).select(F.col(key).cast("string").alias(key), *numeric, *flags)
    # One row of nine numbers.
    spread = minority.agg(*[F.stddev_samp(n).alias(n) for n in _NUMERIC_FEATURES]).first()
    scaled = [F.floor(F.lit(float(NEAREST_STEPS)) * (F.col(n) / F.lit(spread[n] or 1.0)) + F.lit(0.5)).cast("double") for n in _NUMERIC_FEATURES]
    near = nearest_rows(minority, key, CELL_FEATURES, _NUMERIC_FEATURES, scaled, copies)
    pairs = near.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    other = F.get("nearest", F.when(F.size("nearest") > 0, F.pmod(F.col("_step") - 1, F.size("nearest"))))["row"]
    share = unit_hash(F.col(key), F.col("_step").cast("string"))
    between = {n: F.col(n) + share * (F.coalesce(other[n], F.col(n)) - F.col(n)) for n in _NUMERIC_FEATURES}
    new_key = F.concat_ws("|", key, F.col("_step").cast("string"))
    return pairs.select(
        new_key.alias(key), *[(between[n] if n in between else F.col(n)).alias(n) for n in values.FEATURE_NAMES], F.lit(1).alias(label)
    )


def train_forest(
    labeled: DataFrame, label: str = "label", weight: str | None = "weight",
    trees: int = 20, depth: int = 8, seed: int = 7,
) -> PipelineModel:
    """Fit scaling and a random forest; the model takes assembled features."""
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed
    )
    if weight:
        forest = forest.setWeightCol(weight)
    scaling = Pipeline(stages=scaling_stages()).fit(labeled)
    # The forest reads its input several times: vectors are made once and kept until it is fitted.
    rows = scaling.transform(labeled).select("features", label, *([weight] if weight else []))
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([*scaling.stages, forest.fit(rows)])
    finally:
        rows.unpersist()


def predict_probability(windows: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``bot_probability``, the model's probability of class 1, on the executors."""
    windows = windows.drop("bot_probability")
    whole = windows.select(F.struct("*").alias("_row"), "*")
    scored = model.transform(assemble_features(whole))
    return scored.select("_row.*", vector_to_array("probability")[1].alias("bot_probability"))


def predict_threshold(scored: DataFrame, threshold: float) -> DataFrame:
    """Verdict on a given ``bot_probability``."""
    return scored.withColumn("bot_probability", F.col("bot_probability").cast("double")).withColumns({
        "is_bot": scores.verdict(F.col("bot_probability"), threshold),
        "prediction_method": F.lit(values.MODEL_METHOD),
    })


def sigmoid_normalize(scored: DataFrame, column: str = "bot_probability", when: str = "auto") -> DataFrame:
    """Map raw scores into 0..1.

    ``auto`` does so for all rows if any score of the table lies outside 0..1,
    ``always`` and ``never`` need no look at the data (use them on streams).
    """
    score = F.col(column)
    if when == "never":
        return scored
    if when == "always":
        return scored.withColumn(column, scores.sigmoid(score))
    outside = scored.agg(F.coalesce(F.max((score < 0) | (score > 1)), F.lit(False))).scalar()
    return scored.withColumn(column, F.when(outside, scores.sigmoid(score)).otherwise(score))


def prediction_stats(scored: DataFrame, column: str = "bot_probability") -> DataFrame:
    return scored.agg(*stats_columns(column))


def stats_columns(column: str = "bot_probability") -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.min(column).alias("min_probability"),
        F.max(column).alias("max_probability"),
        F.avg(column).alias("mean_probability"),
    ]


Predictor = Callable[[np.ndarray], np.ndarray]


def apply_foreign_model(windows: DataFrame, predict: Predictor) -> DataFrame:
    """Score with any Python model: ``predict`` maps a (rows, 16) array to probabilities.

    Runs on the executors in Arrow batches, on tables and streams. Only the
    features go to Python and only the score comes back.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            rows = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
            yield pd.Series(np.asarray(predict(rows), dtype="float64"))

    return windows.withColumn("bot_probability", score(*_feature_columns(windows)))


def logistic_model(weights: dict[str, float], intercept: float) -> Predictor:
    """A logistic model with given weights."""
    vector = np.array([weights.get(name, 0.0) for name in values.FEATURE_NAMES])

    def predict(rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(rows @ vector + intercept)))

    return predict


def python_model(spark: SparkSession, model) -> Predictor:
    """A fitted Python model with ``predict_proba`` (class 1 is taken) or else ``predict``.

    The pickled model is broadcast, so an executor fetches it once and not with
    every task, and a Python worker unpickles it once.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    opened = {}

    def predict(rows: np.ndarray) -> np.ndarray:
        if "model" not in opened:
            opened["model"] = pickle.loads(shared.value)
        fitted = opened["model"]
        if hasattr(fitted, "predict_proba"):
            return np.asarray(fitted.predict_proba(rows))[:, 1]
        return np.asarray(fitted.predict(rows), dtype="float64")

    return predict


def onnx_model(path: str) -> Predictor:
    """An ONNX model file, opened once per Python worker; executors must be able to read it.

    The first output holds one probability per row, or one per class (1 is taken).
    """
    opened = {}

    def predict(rows: np.ndarray) -> np.ndarray:
        if "session" not in opened:
            import onnxruntime

            opened["session"] = onnxruntime.InferenceSession(path, providers=["CPUExecutionProvider"])
        session = opened["session"]
        inputs = {session.get_inputs()[0].name: rows.astype("float32")}
        found = np.asarray(session.run([session.get_outputs()[0].name], inputs)[0])
        return found[:, 1] if found.ndim == 2 and found.shape[1] == 2 else found.reshape(-1)

    return predict


def with_scaling(predict: Predictor, mean: Sequence[float], scale: Sequence[float]) -> Predictor:
    """Standardize the five numeric features, given in their fixed order, before the model."""
    places = [values.FEATURE_NAMES.index(name) for name in values.SCALED_FEATURES]
    center, spread = np.asarray(mean, dtype="float64"), np.asarray(scale, dtype="float64")

    def scaled(rows: np.ndarray) -> np.ndarray:
        rows = rows.copy()
        rows[:, places] = (rows[:, places] - center) / spread
        return predict(rows)

    return scaled
