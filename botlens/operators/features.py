"""Row features of log events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botlens.config import Settings
from botlens.functions import agents, requests

Rule = Callable[[DataFrame], DataFrame]


def suspicion_flags(events: DataFrame, settings: Settings) -> DataFrame:
    """Log events with the User-Agent and status flags of the rule detector."""
    agent, status = F.col("user_agent"), F.col("status")
    known = settings.user_agent
    return events.withColumns({
        "ua_suspicious": agents.is_suspicious(
            agent, known.bot_patterns, known.whitelist, known.dash_is_empty
        ),
        "is_error_4xx": requests.is_client_error(status),
        "is_error_5xx": requests.is_server_error(status),
        "is_error": requests.is_failure(status),
        "is_success": requests.is_success(status),
    })


def model_row_features(events: DataFrame) -> DataFrame:
    """The per-request model features, plus time, client, agent and id if there is one.

    The upper-case names replace the raw columns of the same name.
    """
    agent = F.col("user_agent")
    keys = [c for c in ("timestamp", "event_id", "client_ip") if c in events.columns]
    raw = events.select(
        *keys,
        "user_agent",
        requests.port_or_default(F.col("port"), F.col("path")).alias("Port"),
        F.col("request_type").alias("_type"),
        requests.protocol_code(F.col("protocol")).alias("Protocol"),
        requests.payload(F.col("bytes_sent")).alias("Payload_Size"),
        requests.is_failure(F.col("status")).alias("is_failure"),
        agents.flag(agents.is_missing(agent)).alias("ua_is_empty"),
        agents.is_tool(agent).alias("ua_is_tool"),
        agents.is_browser(agent).alias("ua_is_browser"),
    )
    typed = raw.withColumn(
        "Request_Type", requests.request_type_code(F.col("_type"), F.col("Port"))
    ).drop("_type")
    return typed.withColumn(
        "is_encrypted", requests.is_encrypted(F.col("Port"), F.col("Request_Type"))
    )


class Rules:
    """User-defined detection rules, applied in the order they were added.

    A rule is a function from DataFrame to DataFrame that adds a column::

        rules = Rules()

        @rules.add
        def night_traffic(events):
            return events.withColumn("at_night", F.hour("timestamp") < 5)

        events.transform(rules)
    """

    def __init__(self, *rules: Rule):
        self._rules = list(rules)

    def add(self, rule: Rule) -> Rule:
        self._rules.append(rule)
        return rule

    def __call__(self, events: DataFrame) -> DataFrame:
        for rule in self._rules:
            events = events.transform(rule)
        return events


def admin_path_rule(events: DataFrame) -> DataFrame:
    return events.withColumn("suspicious_pattern", requests.is_admin_path(F.col("path")))


def probe_path_rule(events: DataFrame) -> DataFrame:
    return events.withColumn("probe_path", requests.is_probe_path(F.col("path")))
