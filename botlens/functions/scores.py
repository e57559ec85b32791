"""Score formulas, verdicts and explanations over one window of one client."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botlens import values
from botlens.config import Weights


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def burst_score(requests: Column, threshold: float) -> Column:
    """0 up to half the threshold, then linear, 1 from the threshold on."""
    half = F.lit(threshold / 2)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (requests - half) / half))


def error_score(error_ratio: Column, threshold: float) -> Column:
    """Error ratio as a share of the threshold, at most 1."""
    return F.least(F.lit(1.0), F.coalesce(error_ratio, F.lit(0.0)) / F.lit(threshold))


def agent_score(tool: Column, empty: Column) -> Column:
    return (
        F.when(tool == 1, values.TOOL_AGENT_SCORE)
        .when(empty == 1, values.EMPTY_AGENT_SCORE)
        .otherwise(0.0)
    )


def weighted(burst: Column, error: Column, agent: Column, weights: Weights) -> Column:
    return burst * weights.burst + error * weights.error + agent * weights.user_agent


def reasons(labels: dict[str, Column], legacy: bool = False) -> Column:
    """Join the labels whose condition holds.

    ``legacy`` keeps an empty slot for every label that does not apply
    (", , " for a row without any reason).
    """
    slots = [F.when(holds, F.lit(label)) for label, holds in labels.items()]
    if legacy:
        slots = [F.coalesce(slot, F.lit("")) for slot in slots]
    return F.concat_ws(", ", *slots)


def reason_list(labels: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in labels.items()]))


def rule_labels() -> dict[str, Column]:
    return {
        values.HIGH_RATE: F.col("burst_score") > values.REASON_FLOOR,
        values.HIGH_ERRORS: F.col("error_score") > values.REASON_FLOOR,
        values.SUSPICIOUS_AGENT: F.col("ua_score") > values.REASON_FLOOR,
    }


def model_labels() -> dict[str, Column]:
    return {
        values.HIGH_RATE: F.col("requests_per_ip") > values.FREQUENT_REQUESTS,
        values.HIGH_ERRORS: F.col("failure_rate_per_ip") > values.REASON_FLOOR,
        values.BOT_AGENT: F.col("ua_is_tool") == 1,
        values.EMPTY_AGENT: F.col("ua_is_empty") == 1,
        values.NON_BROWSER: F.col("ua_is_browser") == 0,
    }


def verdict(probability: Column, threshold: float) -> Column:
    """1 from the threshold on, else 0."""
    return F.when(probability >= threshold, F.lit(1)).otherwise(F.lit(0))


def classification(is_bot: Column) -> Column:
    return F.when(is_bot == 1, values.BOT_CLASS).otherwise(values.NORMAL_CLASS)


def sigmoid(score: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-score))


def detection_id(window_start: Column, client_ip: Column) -> Column:
    """Stable key of a detection: the same window and client always get the same id."""
    key = F.concat_ws("|", F.unix_seconds(window_start).cast("string"), client_ip)
    return F.sha2(key, 256)
