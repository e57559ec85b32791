"""Scores out of fold, calibration and thresholds."""

import pytest
from pyspark.sql import functions as F

from botlens.operators import judging, learning
from botlens.operators.detections import with_detection_id
from botlens.plans import detectors
from botlens.config import SENSITIVE


@pytest.fixture(scope="module")
def scores(spark):
    """Scores 0, 0.01, ... 0.99 with a true share of score squared, a thousand rows each."""
    return spark.range(100_000).select(
        (F.col("id") % 100 / 100).alias("bot_probability"), F.lit("x").alias("made"),
        (F.floor(F.col("id") / 100) < F.pow(F.col("id") % 100 / 100, 2) * 1000).cast("int").alias("label"),
    )


def test_calibration_finds_the_shares(scores):
    before = judging.calibration_error(scores).first()[0]
    made = judging.calibrate(scores, judging.fit_calibration(scores))
    assert made.columns == ["made", "label", "bot_probability"]
    assert before > 0.1 and judging.calibration_error(made).first()[0] < 0.002
    share = {r.bot_probability: r.s for r in made.groupBy("bot_probability").agg(F.avg("label").alias("s")).collect()}
    assert all(abs(p - s) < 0.002 for p, s in share.items())


def test_threshold_reaches_the_precision(scores):
    found = judging.threshold_for(scores, 0.8)
    for threshold, fits in ((found, True), (found - 0.01, False)):
        above = scores.where(F.col("bot_probability") >= threshold - 1e-9).agg(F.avg("label")).first()[0]
        assert (above >= 0.8) == fits
    assert judging.threshold_for(scores, 1.01) is None
    everything = judging.precision_thresholds(scores).orderBy("threshold").first()
    assert everything.row_count == 100_000 and everything.recall == 1.0
    assert judging.threshold_for(scores.where("false"), 0.5) is None


def test_every_row_is_scored_by_a_forest_that_has_not_seen_it(spark, dense):
    found = with_detection_id(detectors.fallback_detections(dense, SENSITIVE))
    rows = detectors.training_rows(found)
    scored = judging.out_of_fold(rows, F.col("detection_id"), trees=5, depth=4)
    assert scored.count() == rows.count() == scored.select("detection_id").distinct().count()
    assert scored.select("fold").distinct().count() == 3
    assert scored.where("bot_probability between 0 and 1").count() == rows.count()
    right = scored.where((F.col("bot_probability") >= 0.5) == (F.col("label") == 1)).count()
    assert right > 0.7 * rows.count()
    assert learning.predict_threshold(judging.calibrate(scored, judging.fit_calibration(scored)), 0.5).count() == rows.count()
