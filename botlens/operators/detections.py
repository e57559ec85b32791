"""Detection rows: identity, display form, newest row per client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens import values
from botlens.functions import scores


def with_detection_id(flat: DataFrame) -> DataFrame:
    """Add a stable id, so that replayed rows can be recognized."""
    key = scores.detection_id(F.col("window_start"), F.col("client_ip"))
    return flat.withColumn("detection_id", key)


def display_rows(flat: DataFrame) -> DataFrame:
    """Columns for a console, with defaults where a verdict is missing."""
    defaults = {
        "bot_probability": 0.0,
        "is_bot": 0,
        "classification": values.UNKNOWN_CLASS,
        "prediction_method": values.UNKNOWN_METHOD,
        "detection_reasons": "",
    }
    plain = ("window_start", "window_end", "client_ip", "requests_per_ip",
             "failure_rate_per_ip", "ua_is_tool", "ua_is_browser")
    filled = [F.coalesce(F.col(name), F.lit(v)).alias(name) for name, v in defaults.items()]
    return flat.select(*plain, *filled)


def latest_per_client(
    flat: DataFrame,
    newest: tuple[str, ...] = ("window_end",),
    keys: tuple[str, ...] = ("client_ip",),
) -> DataFrame:
    """The newest row of every client (or other key), as a keyed store would hold it.

    One maximum over (newest columns, rest of the row): it combines inside each
    task first, where a row number per client would sort all rows of a client in
    one task. Equal times are decided by the rest of the row.
    """
    order = [c for c in newest if c not in keys]
    rest = [c for c in flat.columns if c not in keys and c not in order]
    picked = flat.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    columns = [F.col(c) if c in keys else F.col(f"_best.{c}") for c in flat.columns]
    return picked.select(*columns)
