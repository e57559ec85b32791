"""Judge and calibrate a model: scores out of fold, isotonic calibration, a threshold for a stated precision.

Scores are counted in steps of a thousandth, so calibration and thresholds work on at most 1,001 aggregated rows
however many windows there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botlens.lineage import stored
from botlens.operators import learning

STEPS = 1000


def fold_of(key: Column, folds: int) -> Column:
    """A fold from 0 on, by hash: the same key is always in the same one."""
    return F.floor(learning.unit_hash(key.cast("string"), F.lit("fold")) * folds).cast("int")


def out_of_fold(labeled: DataFrame, key: Column, folds: int = 3, **forest) -> DataFrame:
    """Assembled, labelled rows with the ``bot_probability`` of a forest that was fitted without their fold."""
    rows = stored(labeled.withColumn("fold", fold_of(key, folds)))
    scored = []
    for fold in range(folds):
        model = learning.train_forest(rows.where(F.col("fold") != fold), **forest)
        scored.append(learning.predict_probability(rows.where(F.col("fold") == fold), model))
    return reduce(DataFrame.unionByName, scored)


def _by_step(scored: DataFrame, label: str, column: str = "bot_probability") -> DataFrame:
    """At most 1,001 rows: score, rows, positives."""
    score = (F.round(F.col(column) * STEPS) / STEPS).alias("score")
    known = scored.where(F.col(label).isNotNull() & F.col(column).isNotNull())
    return known.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("ones"))


def fit_calibration(scored: DataFrame, label: str = "label") -> IsotonicRegressionModel:
    """A rising map from score to share of class 1; fit it on scores out of fold."""
    points = _by_step(scored, label).select("score", (F.col("ones") / F.col("n")).alias("share"), F.col("n").cast("double").alias("weight"))
    rows = VectorAssembler(inputCols=["score"], outputCol="at").transform(points)
    return IsotonicRegression(featuresCol="at", labelCol="share", weightCol="weight").fit(rows)


def calibrate(scored: DataFrame, model: IsotonicRegressionModel) -> DataFrame:
    """Replace ``bot_probability`` by the calibrated one."""
    whole = scored.select(F.struct(*[c for c in scored.columns if c != "bot_probability"]).alias("_row"), F.col("bot_probability").alias("_score"))
    rows = VectorAssembler(inputCols=["_score"], outputCol="at", handleInvalid="keep").transform(whole)
    return model.setFeaturesCol("at").setPredictionCol("_made").transform(rows).select("_row.*", F.col("_made").alias("bot_probability"))


def calibration_error(scored: DataFrame, label: str = "label", bins: int = 10) -> DataFrame:
    """One row: mean distance between score and share of class 1 over bins of scores, weighted by rows (0 is best)."""
    bin_ = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1))
    in_bin = _by_step(scored, label).groupBy(bin_.alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("ones").alias("ones"), F.sum(F.col("score") * F.col("n")).alias("scores")
    )
    return in_bin.agg((F.sum(F.abs(F.col("ones") - F.col("scores"))) / F.sum("n")).alias("calibration_error"))


def precision_thresholds(scored: DataFrame, label: str = "label") -> DataFrame:
    """For each score as a threshold: rows at or above it, precision and recall."""
    from_top = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = _by_step(scored, label)  # at most 1,001 rows, so one task sorts them
    summed = steps.select("score", F.sum("n").over(from_top).alias("row_count"), F.sum("ones").over(from_top).alias("found"))
    all_ones = F.max("found").over(Window.partitionBy())
    return summed.select(
        F.col("score").alias("threshold"), "row_count", (F.col("found") / F.col("row_count")).alias("precision"),
        F.try_divide(F.col("found").cast("double"), all_ones).alias("recall"),
    )


def threshold_for(scored: DataFrame, precision: float, label: str = "label") -> float | None:
    """The lowest threshold from which on the precision is reached; None if there is none."""
    return precision_thresholds(scored, label).where(F.col("precision") >= precision).agg(F.min("threshold")).first()[0]
