"""Scores, verdicts and explanations on window tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens import values
from botlens.config import Detection
from botlens.functions import scores


def rule_scores(windows: DataFrame, detection: Detection) -> DataFrame:
    """Part scores, weighted score and verdict of the rule detector."""
    parts = windows.withColumns({
        "burst_score": scores.burst_score(F.col("request_count"), detection.burst_threshold),
        "error_score": scores.error_score(F.col("error_ratio"), detection.error_ratio_threshold),
        "ua_score": F.col("ua_suspicious_ratio"),
    })
    total = scores.weighted(
        F.col("burst_score"), F.col("error_score"), F.col("ua_score"), detection.weights
    )
    return parts.withColumn("bot_score", total).withColumn(
        "is_bot", F.col("bot_score") >= detection.bot_score_threshold
    )


def rule_reasons(scored: DataFrame, legacy: bool = False) -> DataFrame:
    """Explain rule verdicts as text and as a list."""
    labels = scores.rule_labels()
    return scored.withColumns({
        "detection_reasons": scores.reasons(labels, legacy),
        "reasons": scores.reason_list(labels),
    })


def fallback_scores(windows: DataFrame, detection: Detection) -> DataFrame:
    """Rule-based bot probability on model features, for when there is no model."""
    probability = scores.weighted(
        scores.burst_score(F.col("requests_per_ip"), detection.burst_threshold),
        scores.error_score(F.col("failure_rate_per_ip"), detection.error_ratio_threshold),
        scores.agent_score(F.col("ua_is_tool"), F.col("ua_is_empty")),
        detection.weights,
    )
    return windows.withColumn("bot_probability", probability).withColumns({
        "is_bot": scores.verdict(F.col("bot_probability"), values.FALLBACK_THRESHOLD),
        "prediction_method": F.lit(values.RULE_METHOD),
    })


def model_reasons(scored: DataFrame, legacy: bool = False) -> DataFrame:
    labels = scores.model_labels()
    return scored.withColumns({
        "detection_reasons": scores.reasons(labels, legacy),
        "reasons": scores.reason_list(labels),
    })


def classify(scored: DataFrame) -> DataFrame:
    return scored.withColumn("classification", scores.classification(F.col("is_bot")))


def stamp(scored: DataFrame) -> DataFrame:
    """Add the processing time."""
    return scored.withColumn("detection_timestamp", F.current_timestamp())


def bot_alerts(scored: DataFrame) -> DataFrame:
    """Only rows with a bot verdict, boolean or 0/1."""
    return scored.where(F.col("is_bot").cast("boolean"))
