"""The rule detector, the model detector and its fallback, on tables or streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.config import Settings
from botlens.functions import scores
from botlens.operators import features, learning, panes, scoring, windows
from botlens.streaming.exact_windows import exact_windows


def rule_windows(events: DataFrame, settings: Settings) -> DataFrame:
    """Scored but not yet explained windows of the rule detector."""
    detection = settings.detection
    counted = windows.traffic_windows(
        features.suspicion_flags(events, settings),
        detection.window_duration,
        detection.slide_duration,
        detection.watermark_delay,
    )
    return scoring.rule_scores(windows.traffic_ratios(counted), detection)


def rule_detections(events: DataFrame, settings: Settings) -> DataFrame:
    """Log events to explained rule detections, one row per window and client."""
    scored = rule_windows(events, settings)
    explained = scoring.rule_reasons(scored, settings.detection.legacy_reasons)
    return windows.flatten_window(explained)


def model_windows(events: DataFrame, settings: Settings, temporal: str = "zero") -> DataFrame:
    """The model's 16 features per window and client.

    ``temporal="zero"`` keeps the two arrival-time features constant, as a model trained without
    them expects; ``"exact"`` computes them, on tables and on streams alike.
    """
    if temporal not in ("zero", "exact"):
        raise ValueError(f"temporal must be 'zero' or 'exact', not {temporal!r}")
    model, delay = settings.ml, settings.detection.watermark_delay
    rows = features.model_row_features(events)
    if events.isStreaming and temporal == "exact":
        grouped = exact_windows(rows, model.window_duration, model.slide_duration, delay)
    else:
        grouped = panes.feature_windows(rows, model.window_duration, model.slide_duration, delay, temporal == "exact")
    grouped = windows.fill_deviation(grouped)
    return grouped if temporal == "exact" else windows.no_arrival_times(grouped)


def _explained(scored: DataFrame, settings: Settings) -> DataFrame:
    named = scoring.model_reasons(scored, settings.detection.legacy_reasons)
    return windows.flatten_window(scoring.classify(named))


def judged_windows(
    features: DataFrame, settings: Settings, model: PipelineModel | learning.Predictor | None
) -> DataFrame:
    """Model features to explained detections, by a model or by the fallback without one."""
    if model is None:
        return _explained(scoring.fallback_scores(features, settings.detection), settings)
    apply = (
        learning.predict_probability
        if isinstance(model, PipelineModel)
        else learning.apply_foreign_model
    )
    return _explained(
        learning.predict_threshold(apply(features, model), settings.ml.prediction_threshold), settings
    )


def fallback_detections(events: DataFrame, settings: Settings, temporal: str = "zero") -> DataFrame:
    """Detections without a model: rule-based probability on the model features."""
    return judged_windows(model_windows(events, settings, temporal), settings, None)


def model_detections(
    events: DataFrame,
    settings: Settings,
    model: PipelineModel | learning.Predictor | None,
    temporal: str = "zero",
) -> DataFrame:
    """Detections by a fitted pipeline or Python predictor, or by the fallback without one."""
    return judged_windows(model_windows(events, settings, temporal), settings, model)


def load_model(spark, path: str | None) -> PipelineModel | None:
    """The saved model, or None if there is none at the path; a broken one raises."""
    if not path:
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return PipelineModel.load(path) if files.exists(target) else None


def training_rows(detections: DataFrame, label: str = "is_bot") -> DataFrame:
    """Assembled features with ``label`` and balancing ``weight``."""
    labeled = detections.withColumn("label", F.col(label).cast("int"))
    return learning.class_weights(learning.assemble_features(labeled))


def burst_windows(events: DataFrame, settings: Settings) -> DataFrame:
    """Request rate over its own window length."""
    detection = settings.detection
    counted = windows.traffic_windows(
        features.suspicion_flags(events, settings),
        detection.burst_window, detection.slide_duration, detection.watermark_delay,
    )
    score = scores.burst_score(F.col("request_count"), detection.burst_threshold)
    return counted.select("window", "client_ip", "request_count", score.alias("burst_score"))


def error_windows(events: DataFrame, settings: Settings) -> DataFrame:
    """Error ratio over its own, longer window length."""
    detection = settings.detection
    counted = windows.traffic_ratios(windows.traffic_windows(
        features.suspicion_flags(events, settings),
        detection.error_window, detection.slide_duration, detection.watermark_delay,
    ))
    score = scores.error_score(F.col("error_ratio"), detection.error_ratio_threshold)
    return counted.select(
        "window", "client_ip", "request_count", "total_errors", "error_ratio", score.alias("error_score")
    )
