"""Every operator as a query over the test tables: name -> (spark, folder) -> DataFrame.

Results are brought to one form: times as epoch seconds, doubles rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botlens import fixtures, schema, values
from botlens.config import SENSITIVE, STANDARD
from botlens.functions import addresses, agents, requests, scores
from botlens.lineage import checkpointed, stored
from botlens.operators import (
    arrivals, detections, features, judging, learning, panes, report, scoring, searches, sequences, windows,
)
from botlens.plans import detectors
from botlens.sources import access_log, tables, topic

Query = Callable[[SparkSession, str], DataFrame]

# Days of sparse traffic need long windows.
SPARSE = SENSITIVE.override({"detection": {
    "burst_threshold": 6, "window_duration": "1 day", "slide_duration": "12 hours",
}})
LEGACY = SENSITIVE.override({"detection": {"legacy_reasons": True}})
CLIENT, NETWORK = "10.0.0.1", "10.0.0."
FOREIGN_WEIGHTS = {"requests_per_ip": 0.2, "failure_rate_per_ip": 1.5, "ua_is_tool": 1.0}
FOREIGN_INTERCEPT = -3.0

_FINE, _COARSE = 6, 4
_COARSE_COLUMNS = {"payload_std_per_ip"}


def _sparse(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.access_logs(fixtures.events_table(spark, folder))


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.access_logs(fixtures.events_table(spark, folder), dense=True)


def _even(rows: DataFrame, *names: str) -> DataFrame:
    """Times as epoch seconds, doubles rounded; all columns unless some are named."""
    columns = []
    for name in names or rows.columns:
        kind = rows.schema[name].dataType.typeName()
        column = F.col(name)
        if kind == "timestamp":
            column = F.unix_seconds(column)
        elif kind == "double":
            column = F.round(column, _COARSE if name in _COARSE_COLUMNS else _FINE)
        columns.append(column.alias(name))
    return rows.select(*columns)


def _row_feature(name: str, column: Callable[[], Column]) -> Query:
    def query(spark, folder):
        return _sparse(spark, folder).select("event_id", column().alias(name))

    return query


def _rule(spark, folder, settings=SENSITIVE) -> DataFrame:
    return detectors.rule_detections(_dense(spark, folder), settings)


def _fallback(spark, folder, settings=SENSITIVE) -> DataFrame:
    return detectors.fallback_detections(_dense(spark, folder), settings)


_WINDOW = ("window_start", "client_ip")


def _rule_columns(*names: str, settings=SENSITIVE) -> Query:
    return lambda spark, folder: _even(_rule(spark, folder, settings), *_WINDOW, *names)


def _fallback_columns(*names: str, settings=SENSITIVE) -> Query:
    return lambda spark, folder: _even(_fallback(spark, folder, settings), *_WINDOW, *names)


# --- ingest -------------------------------------------------------------------

def _lines(spark, folder):
    return fixtures.raw_lines(_sparse(spark, folder))


def parse_access_log(spark, folder):
    return access_log.parse_access_log(_lines(spark, folder))


def parse_quarantine(spark, folder):
    return access_log.quarantined_lines(_lines(spark, folder))


def normalize_access_log(spark, folder):
    return access_log.normalize_access_log(parse_access_log(spark, folder))


def parse_clf_time(spark, folder):
    moment = access_log.log_time(F.col("time"))
    return parse_access_log(spark, folder).select(
        "event_id",
        F.unix_seconds(moment).alias("epoch"),
        access_log.event_time_text(moment).alias("iso"),
    )


def encode_json_events(spark, folder):
    logs = _sparse(spark, folder)
    text = logs.withColumn("timestamp", access_log.event_time_text(F.col("timestamp")))
    return topic.encode_json_events(text)


def decode_json_events(spark, folder):
    messages = fixtures.damaged_messages(encode_json_events(spark, folder))
    return _even(topic.decode_json_events(messages))


def null_timestamps(spark, folder):
    messages = fixtures.damaged_messages(encode_json_events(spark, folder))
    return topic.decode_json_events(messages).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("timestamp").isNull()).alias("without_time"),
    )


# --- windows ------------------------------------------------------------------

def traffic_windows(spark, folder):
    flagged = features.suspicion_flags(_dense(spark, folder), SENSITIVE)
    counted = windows.traffic_windows(flagged, "30 seconds", "10 seconds")
    return _even(windows.flatten_window(counted))


def _client_windows(spark, folder):
    rows = features.model_row_features(_dense(spark, folder))
    return windows.flatten_window(panes.feature_windows(rows, "60 seconds", "30 seconds"))


def ml_window_features(spark, folder):
    return _even(
        _client_windows(spark, folder), *_WINDOW, "requests_per_ip", "failure_rate_per_ip",
        "avg_payload_per_ip", "payload_std_per_ip", "protocol_error_rate",
    )


def first_values(spark, folder):
    return _even(_client_windows(spark, folder), *_WINDOW, *windows.FIRST_VALUES)


def stddev_fill(spark, folder):
    filled = windows.fill_deviation(_client_windows(spark, folder))
    return _even(filled, *_WINDOW, "payload_std_per_ip")


def ua_diversity_sketched(spark, folder):
    """Few agents a client, where a sketch counts exactly."""
    held = panes.agent_panes(_dense(spark, folder), "30 seconds")
    counted = windows.flatten_window(panes.diversity_windows(held, "60 seconds", "30 seconds"))
    return _even(counted, "window_start", "window_end", "client_ip", "request_count", "distinct_agents")


def protocol_error_rate(spark, folder):
    rows = features.model_row_features(_dense(spark, folder))
    rates = windows.protocol_error_rate(rows, "60 seconds", "30 seconds")
    return _even(windows.flatten_window(rates))


def request_gaps(spark, folder):
    return _even(arrivals.request_gaps(_sparse(spark, folder)), "event_id", "gap_seconds")


#: Two failures, then a success: guessing that works.
GUESSING, GUESSING_SECONDS = ("status >= 400", "status >= 400", "status < 400"), 30


def request_sequences(spark, folder):
    found = sequences.sequence_matches(_dense(spark, folder), [F.expr(s) for s in GUESSING], GUESSING_SECONDS)
    return found.select("event_id", "client_ip", "path")


def sequence_clients(spark, folder):
    return _even(sequences.sequence_clients(_dense(spark, folder), [F.expr(s) for s in GUESSING], GUESSING_SECONDS))


def inter_arrival(spark, folder):
    gaps = arrivals.request_gaps(_dense(spark, folder))
    return _even(windows.flatten_window(arrivals.arrival_windows(gaps, "60 seconds", "30 seconds")))


def exact_temporal_features(spark, folder):
    found = detectors.fallback_detections(_dense(spark, folder), SENSITIVE, temporal="exact")
    return _even(
        found, *_WINDOW, "requests_per_ip", "time_since_last_request", "inter_arrival_std"
    )


def ua_diversity(spark, folder):
    counted = windows.agent_diversity(_dense(spark, folder), "60 seconds", "30 seconds")
    return _even(windows.flatten_window(counted))


def burst_window(spark, folder):
    return _even(windows.flatten_window(
        detectors.burst_windows(_dense(spark, folder), SENSITIVE)))


def error_window(spark, folder):
    return _even(windows.flatten_window(
        detectors.error_windows(_dense(spark, folder), SENSITIVE)))


# --- detections ---------------------------------------------------------------

_RULE_COLUMNS = tuple(
    f.name for f in schema.RULE_DETECTION.fields if f.name != "detection_timestamp"
)


def rule_detections(spark, folder):
    return _even(_rule(spark, folder), *_RULE_COLUMNS)


def rule_detections_sparse(spark, folder):
    found = detectors.rule_detections(_sparse(spark, folder), SPARSE)
    return _even(found, *_RULE_COLUMNS)


def rule_detections_standard(spark, folder):
    return _even(_rule(spark, folder, STANDARD), *_RULE_COLUMNS)


def typed_store_schema(spark, folder):
    stored = tables.conform(scoring.stamp(_rule(spark, folder)), schema.RULE_DETECTION)
    return _even(stored, *_RULE_COLUMNS)


def typed_model_schema(spark, folder):
    stored = tables.conform(scoring.stamp(_fallback(spark, folder)), schema.MODEL_DETECTION)
    names = [f.name for f in schema.MODEL_DETECTION.fields if f.name != "detection_timestamp"]
    return _even(stored, *names)


def typed_log_schema(spark, folder):
    events = access_log.events_from_lines(_lines(spark, folder))
    return _even(tables.conform(events, schema.STORED_EVENT))


def flatten_window(spark, folder):
    scored = detectors.rule_windows(_dense(spark, folder), SENSITIVE)
    return _even(windows.flatten_window(scored), "window_start", "window_end", "client_ip", "bot_score")


def latest_detection_per_ip(spark, folder):
    return _even(detections.latest_per_client(_rule(spark, folder)), *_RULE_COLUMNS)


def bot_alerts(spark, folder):
    return _even(scoring.bot_alerts(_rule(spark, folder)), *_WINDOW, "bot_score", "is_bot")


def display_detections(spark, folder):
    return _even(detections.display_rows(_fallback(spark, folder)))


def detection_reason_count(spark, folder):
    counted = _rule(spark, folder).withColumn("reason_count", F.size("reasons"))
    return _even(counted, *_WINDOW, "reason_count")


def fallback_score(spark, folder):
    scored = scoring.fallback_scores(
        detectors.model_windows(_dense(spark, folder), SENSITIVE), SENSITIVE.detection
    )
    flat = windows.flatten_window(scored)
    return _even(flat, *_WINDOW, "bot_probability", "is_bot", "prediction_method")


def fallback_detections(spark, folder):
    found = _fallback(spark, folder)
    return _even(found, *[c for c in found.columns if c != "reasons"])


# --- addresses ----------------------------------------------------------------

#: Requests with addresses of both families, and some that are none. Runs in Spark and DuckDB.
MIXED_ADDRESS = """case event_id % 7 when 0 then '::ffff:' || client_ip when 1 then '2001:DB8::' || cast(event_id % 1000 as string)
    when 2 then 'host-' || client_ip else client_ip end"""
FIXED_NETWORKS = ("10.0.0.0/8", "10.0.0.2/32", "2001:db8::/32", "2001:db8::100/120", "0.0.0.0/0", "no network")


def _mixed(spark, folder):
    return _dense(spark, folder).select("event_id", F.expr(MIXED_ADDRESS).alias("client_ip"))


def typed_addresses(spark, folder):
    key = addresses.address_key(F.col("client_ip"))
    rows = _mixed(spark, folder).withColumn("address_key", key)
    return rows.withColumn("family", addresses.address_family(F.col("address_key")))


def network_requests(spark, folder):
    """Requests by the narrowest listed network: each third octet that occurs, and fixed ones inside and around."""
    rows = _mixed(spark, folder)
    seen = _dense(spark, folder).where("client_ip like '203.%'")
    listed = seen.select(F.concat(F.substring_index("client_ip", ".", 3), F.lit(".0/24")).alias("network")).distinct()
    fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, FIXED_NETWORKS))).alias("network"))
    matched = addresses.matched_networks(rows, listed.union(fixed))
    return matched.groupBy("network").agg(F.count(F.lit(1)).alias("requests"), F.count_distinct("client_ip").alias("clients"))


def kql_network(spark, folder):
    return _even(_fallback(spark, folder).where(addresses.in_network(F.col("client_ip"), "203.0.0.64/26")), *_WINDOW, "bot_probability")


# --- learning -----------------------------------------------------------------

def assemble_features(spark, folder):
    assembled = learning.assemble_features(_fallback(spark, folder))
    return _even(assembled, *_WINDOW, *values.FEATURE_NAMES)


def scale_features(spark, folder):
    # Fitting and scaling read the rows once each; the windows are computed once.
    assembled = checkpointed(learning.assemble_features(_fallback(spark, folder)))
    scaled = learning.scale_features(assembled)
    return _even(scaled, *_WINDOW, *values.SCALED_FEATURES)


def _labeled(spark, folder):
    # The steps on labels read the rows twice; the windows are computed once.
    found = _fallback(spark, folder).withColumn("label", F.col("is_bot"))
    return checkpointed(detections.with_detection_id(found))


def balance_classes(spark, folder):
    return _even(learning.class_weights(_labeled(spark, folder)), *_WINDOW, "label", "weight")


def oversample_classes(spark, folder):
    repeated = learning.oversample(_labeled(spark, folder), F.col("detection_id"))
    return _even(repeated, *_WINDOW, "label", "copy")


def interpolate_minority(spark, folder):
    made = learning.interpolate_minority(_labeled(spark, folder), "detection_id", copies=2)
    return _even(made)


def interpolate_nearest(spark, folder):
    found = detections.with_detection_id(_fallback(spark, folder)).withColumn("label", F.col("is_bot"))
    needed = stored(found.select("detection_id", "label", *values.FEATURE_NAMES))
    made = learning.interpolate_nearest(needed, "detection_id", copies=2)
    return _even(made)


def _training(found: DataFrame, *keys: str) -> DataFrame:
    """Training rows of detections: their windows are computed once, and only what a forest reads is kept."""
    return detectors.training_rows(stored(found.select(*keys, "is_bot", *values.FEATURE_NAMES))).drop("is_bot")


def _trained(found: DataFrame):
    rows = _training(found)
    return rows, learning.train_forest(rows)


def train_forest(spark, folder):
    """A forest on all windows: rows by label, and whether it has learned nine of ten of them at least."""
    rows, model = _trained(_fallback(spark, folder))
    judged = learning.predict_threshold(learning.predict_probability(rows, model), 0.5)
    right = F.sum((F.col("is_bot") == F.col("label")).cast("int"))
    whole = judged.agg((right / F.count(F.lit(1)) >= 0.9).alias("x")).scalar()
    return judged.groupBy("label").agg(F.count(F.lit(1)).alias("row_count")).withColumn("learned", whole)


def forest_holdout(spark, folder):
    """A forest fitted on seven tenths of the windows, judged on the others: right in 80 % at least."""
    rows = _training(detections.with_detection_id(_fallback(spark, folder)), "detection_id")
    held = learning.unit_hash(F.col("detection_id")) >= 0.7
    model = learning.train_forest(rows.where(~held))
    judged = learning.predict_threshold(learning.predict_probability(rows.where(held), model), 0.5)
    right = (F.col("is_bot") == F.col("label")).cast("int")
    by_label = judged.groupBy("label").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.col("bot_probability").between(0, 1)).alias("probabilities_valid"),
        F.sum(right).alias("right"),
    )
    whole = by_label.agg((F.sum("right") / F.sum("row_count") >= 0.8).alias("x")).scalar()
    return by_label.withColumn("accurate", whole).drop("right")


def predict_proba(spark, folder):
    # Labels and scores are made from the same windows.
    windows = stored(detectors.model_windows(_dense(spark, folder), SENSITIVE))
    _, model = _trained(detectors.judged_windows(windows, SENSITIVE, None))
    found = detectors.judged_windows(windows, SENSITIVE, model)
    above = F.col("bot_probability") >= SENSITIVE.ml.prediction_threshold
    facts = {"probability_valid": F.col("bot_probability").between(0, 1), "verdict_fits": (F.col("is_bot") == 1) == above}
    return _even(found.withColumns(facts), *_WINDOW, *facts, "prediction_method")


def calibrated_forest(spark, folder):
    """Scores out of fold, calibrated on two thirds of the windows and judged on the others: off by 0.05 at most, and precise."""
    found = detections.with_detection_id(_fallback(spark, folder))
    scored = judging.out_of_fold(_training(found, "detection_id"), F.col("detection_id"))
    scored = stored(scored.select("label", "fold", "bot_probability"))
    held = F.col("fold") == 0
    model = judging.fit_calibration(scored.where(~held))
    made = stored(judging.calibrate(scored.where(held), model))
    threshold = judging.threshold_for(judging.calibrate(scored.where(~held), model), 0.95)
    # A few rows lie off by chance alone.
    off = 0.05 + 1 / max(made.count(), 1) ** 0.5
    error = judging.calibration_error(made).select((F.col("calibration_error") <= off).alias("x")).scalar()
    chosen = made.where(F.col("bot_probability") >= F.lit(threshold))
    precise = chosen.agg((F.avg("label") >= 0.85).alias("x")).scalar()
    by_label = made.groupBy("label").agg(
        F.count(F.lit(1)).alias("row_count"), F.min(F.col("bot_probability").between(0, 1)).alias("probabilities_valid")
    )
    return by_label.withColumns({"calibrated": error, "precise": precise})


def predict_threshold(spark, folder):
    judged = learning.predict_threshold(_fallback(spark, folder), 0.6)
    return _even(judged, *_WINDOW, "bot_probability", "is_bot", "prediction_method")


def sigmoid_normalize(spark, folder):
    raw = _fallback(spark, folder).withColumn(
        "bot_probability", (F.col("requests_per_ip") - 5) / F.lit(4.0)
    )
    return _even(learning.sigmoid_normalize(raw), *_WINDOW, "bot_probability")


def prediction_stats(spark, folder):
    return _even(learning.prediction_stats(_fallback(spark, folder)))


def detection_id(spark, folder):
    return _even(detections.with_detection_id(_fallback(spark, folder)), *_WINDOW, "detection_id")


def foreign_model_udf(spark, folder):
    model = learning.logistic_model(FOREIGN_WEIGHTS, FOREIGN_INTERCEPT)
    found = detectors.model_detections(_dense(spark, folder), SENSITIVE, model)
    return _even(found, *_WINDOW, "bot_probability", "is_bot", "prediction_method")


# --- reports ------------------------------------------------------------------

def _terms(field: str, size: int = 10) -> Query:
    return lambda spark, folder: report.top_terms(_fallback(spark, folder), field, size)


def _timeline(seconds: int) -> Query:
    return lambda spark, folder: report.timeline(_fallback(spark, folder), "window_start", seconds)


def sparse_timeline(spark, folder):
    bots = scoring.bot_alerts(detectors.rule_detections(_sparse(spark, folder), SPARSE))
    return report.timeline(bots, "window_start", 3600)


def total_detections(spark, folder):
    return report.total_rows(_fallback(spark, folder))


def top_source_ips_by_requests(spark, folder):
    return report.top_terms(_dense(spark, folder), "client_ip")


def avg_payload_top_ips(spark, folder):
    found = _fallback(spark, folder)
    return _even(report.top_terms(found, "client_ip", avg_payload=F.avg("avg_payload_per_ip")))


def request_frequency(spark, folder):
    return _even(windows.flatten_window(report.request_frequency(_dense(spark, folder))))


def avg_gauge(spark, folder):
    return _even(report.average(_fallback(spark, folder), "bot_probability"))


def recent_range(spark, folder):
    return _even(report.recent(_sparse(spark, folder), "timestamp"), "event_id", "timestamp")


def status_distribution(spark, folder):
    return report.top_terms(_sparse(spark, folder), "status", None)


def error_rate_over_time(spark, folder):
    return _even(windows.flatten_window(report.error_rate_over_time(_dense(spark, folder))))


def top_bot_paths(spark, folder):
    logs = _dense(spark, folder)
    bots = scoring.bot_alerts(detectors.rule_detections(logs, SENSITIVE))
    detection = SENSITIVE.detection
    return report.top_bot_paths(logs, bots, detection.slide_duration, duration=detection.window_duration)


def ip_profile(spark, folder):
    return _even(report.client_profile(_fallback(spark, folder), CLIENT))


_HIT = ("bot_probability", "requests_per_ip", "is_bot")


def data_table(spark, folder):
    order = (F.desc("requests_per_ip"), F.asc("window_start"), F.asc("client_ip"))
    return _even(report.page(_fallback(spark, folder), 2, by=order), *_WINDOW, *_HIT)


def _search(find: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _even(find(_fallback(spark, folder)), *_WINDOW, *_HIT)


def _log_search(find: Callable[[DataFrame], DataFrame], shown: str) -> Query:
    return lambda spark, folder: find(_sparse(spark, folder)).select("event_id", shown)


def rule_registry(spark, folder):
    rules = features.Rules(features.admin_path_rule, features.probe_path_rule)
    logs = _sparse(spark, folder).transform(rules)
    return logs.select("event_id", "suspicious_pattern", "probe_path")


def status_classes(spark, folder):
    flagged = features.suspicion_flags(_sparse(spark, folder), SENSITIVE)
    return flagged.select("event_id", "is_error_4xx", "is_error_5xx", "is_error", "is_success")


def base_features(spark, folder):
    return _even(features.model_row_features(_sparse(spark, folder)))


_AGENT = lambda: F.col("user_agent")
_PORT = lambda: requests.port_or_default(F.col("port"), F.col("path"))
_TYPE = lambda: requests.request_type_code(F.col("request_type"), _PORT())

QUERIES: dict[str, Query] = {
    "parse_access_log": parse_access_log,
    "parse_quarantine": parse_quarantine,
    "normalize_access_log": normalize_access_log,
    "parse_clf_time": parse_clf_time,
    "encode_json_events": encode_json_events,
    "decode_json_events": decode_json_events,
    "null_timestamps": null_timestamps,
    "display_detections": display_detections,
    "latest_detection_per_ip": latest_detection_per_ip,
    "flatten_window": flatten_window,
    "typed_store_schema": typed_store_schema,
    "typed_model_schema": typed_model_schema,
    "typed_log_schema": typed_log_schema,
    "ua_suspicious": _row_feature("ua_suspicious", lambda: agents.is_suspicious(_AGENT())),
    "ua_suspicious_extended": _row_feature(
        "ua_suspicious", lambda: agents.is_suspicious(_AGENT(), values.SUSPICIOUS_AGENTS_EXTENDED)
    ),
    "ua_whitelist": _row_feature(
        "ua_suspicious",
        lambda: agents.is_suspicious(_AGENT(), whitelist=values.WELCOME_AGENTS),
    ),
    "status_classes": status_classes,
    "port_default": _row_feature("Port", _PORT),
    "protocol_encode": _row_feature("Protocol", lambda: requests.protocol_code(F.col("protocol"))),
    "request_type_encode": _row_feature("Request_Type", _TYPE),
    "payload_size": _row_feature("Payload_Size", lambda: requests.payload(F.col("bytes_sent"))),
    "is_encrypted": _row_feature("is_encrypted", lambda: requests.is_encrypted(_PORT(), _TYPE())),
    "is_failure": _row_feature("is_failure", lambda: requests.is_failure(F.col("status"))),
    "ua_is_empty": _row_feature("ua_is_empty", lambda: agents.flag(agents.is_missing(_AGENT()))),
    "ua_is_tool": _row_feature("ua_is_tool", lambda: agents.is_tool(_AGENT())),
    "ua_is_browser": _row_feature("ua_is_browser", lambda: agents.is_browser(_AGENT())),
    "base_features": base_features,
    "suspicious_path": _row_feature(
        "suspicious_pattern", lambda: requests.is_admin_path(F.col("path"))
    ),
    "bot_alerts": bot_alerts,
    "rule_registry": rule_registry,
    "traffic_windows": traffic_windows,
    "traffic_ratios": _rule_columns("request_count", "error_ratio", "ua_suspicious_ratio"),
    "ml_window_features": ml_window_features,
    "first_values": first_values,
    "stddev_fill": stddev_fill,
    "ua_diversity_sketched": ua_diversity_sketched,
    "protocol_error_rate": protocol_error_rate,
    "request_gaps": request_gaps,
    "request_sequences": request_sequences,
    "sequence_clients": sequence_clients,
    "inter_arrival": inter_arrival,
    "exact_temporal_features": exact_temporal_features,
    "ua_diversity": ua_diversity,
    "burst_window": burst_window,
    "error_window": error_window,
    "burst_score": _rule_columns("burst_score"),
    "error_score": _rule_columns("error_score"),
    "ua_score": _rule_columns("ua_score"),
    "bot_score": _rule_columns("bot_score"),
    "is_bot": _rule_columns("is_bot"),
    "detection_reasons": _rule_columns("detection_reasons"),
    "detection_reasons_legacy": _rule_columns("detection_reasons", settings=LEGACY),
    "detection_reason_count": detection_reason_count,
    "rule_detections": rule_detections,
    "rule_detections_sparse": rule_detections_sparse,
    "rule_detections_standard": rule_detections_standard,
    "fallback_score": fallback_score,
    "ml_reasons": _fallback_columns("detection_reasons"),
    "ml_reasons_legacy": _fallback_columns("detection_reasons", settings=LEGACY),
    "classification": _fallback_columns("is_bot", "classification"),
    "fallback_detections": fallback_detections,
    "assemble_features": assemble_features,
    "scale_features": scale_features,
    "train_forest": train_forest,
    "balance_classes": balance_classes,
    "oversample_classes": oversample_classes,
    "interpolate_minority": interpolate_minority,
    "interpolate_nearest": interpolate_nearest,
    "forest_holdout": forest_holdout,
    "predict_proba": predict_proba,
    "calibrated_forest": calibrated_forest,
    "predict_threshold": predict_threshold,
    "sigmoid_normalize": sigmoid_normalize,
    "prediction_stats": prediction_stats,
    "detection_id": detection_id,
    "foreign_model_udf": foreign_model_udf,
    "detection_timeline": _timeline(30),
    "detection_timeline_60s": _timeline(60),
    "sparse_timeline": sparse_timeline,
    "total_detections": total_detections,
    "bot_vs_normal": _terms("is_bot", 5),
    "top_source_ips": _terms("client_ip"),
    "top_source_ips_by_requests": top_source_ips_by_requests,
    "tool_split": _terms("ua_is_tool"),
    "encrypted_split": _terms("is_encrypted", 5),
    "failure_split": _terms("is_failure", 5),
    "browser_split": _terms("ua_is_browser"),
    "avg_payload_top_ips": avg_payload_top_ips,
    "traffic_by_port": _terms("Port", 5),
    "request_frequency": request_frequency,
    "avg_gauge": avg_gauge,
    "recent_range": recent_range,
    "status_distribution": status_distribution,
    "error_rate_over_time": error_rate_over_time,
    "top_bot_paths": top_bot_paths,
    "ip_profile": ip_profile,
    "alert_threshold": _search(searches.alerts),
    "data_table": data_table,
    "kql_bots": _search(searches.bots),
    "kql_high_conf": _search(searches.confident),
    "kql_high_conf_070": _search(lambda rows: searches.confident(rows, 0.7)),
    "kql_ip": _search(lambda rows: searches.of_client(rows, CLIENT)),
    "kql_ip_prefix": _search(lambda rows: searches.of_network(rows, NETWORK)),
    "kql_network": kql_network,
    "typed_addresses": typed_addresses,
    "network_requests": network_requests,
    "kql_tool_bots": _search(searches.tool_bots),
    "kql_scanning": _search(searches.scanning),
    "kql_encrypted": _search(searches.encrypted),
    "kql_high_rate": _search(searches.high_rate),
    "kql_combined": _search(searches.failing_suspects),
    "log_failed": _log_search(searches.failed_requests, "status"),
    "log_path": _log_search(lambda rows: searches.requests_of_path(rows, "/.env"), "path"),
    "log_ua_wildcard": _log_search(searches.agents_with, "user_agent"),
}
