"""Saved searches: filters over detections and log events. Ranges include both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bots(detections: DataFrame) -> DataFrame:
    return detections.where("is_bot = 1")


def confident(detections: DataFrame, low: float = 0.8, high: float = 1.0) -> DataFrame:
    return detections.where(F.col("bot_probability").between(low, high))


def alerts(detections: DataFrame, above: float = 0.8) -> DataFrame:
    return detections.where(F.col("bot_probability") > above)


def of_client(rows: DataFrame, client_ip: str) -> DataFrame:
    return rows.where(F.col("client_ip") == client_ip)


def of_network(rows: DataFrame, prefix: str) -> DataFrame:
    """Clients whose address starts with the prefix, such as ``10.0.10.``."""
    return rows.where(F.col("client_ip").startswith(prefix))


def tool_bots(detections: DataFrame) -> DataFrame:
    return detections.where("ua_is_tool = 1 and is_bot = 1")


def scanning(detections: DataFrame, low: int = 5, high: int = 100) -> DataFrame:
    return detections.where("is_failure = 1").where(F.col("requests_per_ip").between(low, high))


def encrypted(detections: DataFrame) -> DataFrame:
    return detections.where("is_encrypted = 1")


def high_rate(detections: DataFrame, low: int = 10, high: int = 1000) -> DataFrame:
    return detections.where(F.col("requests_per_ip").between(low, high))


def failing_suspects(detections: DataFrame, low: float = 0.5, high: float = 1.0) -> DataFrame:
    suspect = (F.col("is_bot") == 1) | (F.col("ua_is_tool") == 1)
    return detections.where(suspect & F.col("failure_rate_per_ip").between(low, high))


def failed_requests(events: DataFrame) -> DataFrame:
    return events.where("status >= 400")


def requests_of_path(events: DataFrame, path: str = "/api/login") -> DataFrame:
    return events.where(F.col("path") == path)


def agents_with(events: DataFrame, word: str = "bot") -> DataFrame:
    return events.where(F.col("user_agent").contains(word))
