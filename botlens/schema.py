"""Declared table schemas: log events and the two kinds of detections."""

from pyspark.sql import types as T

LOG_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("bytes_sent", T.LongType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("referer", T.StringType()),
    T.StructField("log_type", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("request_type", T.StringType()),
])

# The log table of the store: messages carry the time as text, the table as a timestamp.
STORED_EVENT = T.StructType([
    T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType) for f in LOG_EVENT.fields
])

RULE_DETECTION = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("request_count", T.LongType()),
    T.StructField("error_4xx_count", T.LongType()),
    T.StructField("error_5xx_count", T.LongType()),
    T.StructField("total_errors", T.LongType()),
    T.StructField("total_success", T.LongType()),
    T.StructField("suspicious_ua_count", T.LongType()),
    T.StructField("avg_bytes_sent", T.DoubleType()),
    T.StructField("error_ratio", T.DoubleType()),
    T.StructField("ua_suspicious_ratio", T.DoubleType()),
    T.StructField("burst_score", T.DoubleType()),
    T.StructField("error_score", T.DoubleType()),
    T.StructField("ua_score", T.DoubleType()),
    T.StructField("bot_score", T.DoubleType()),
    T.StructField("is_bot", T.BooleanType()),
    T.StructField("detection_reasons", T.StringType()),
    T.StructField("detection_timestamp", T.TimestampType()),
])

MODEL_DETECTION = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("requests_per_ip", T.LongType()),
    T.StructField("failure_rate_per_ip", T.DoubleType()),
    T.StructField("avg_payload_per_ip", T.DoubleType()),
    T.StructField("bot_probability", T.DoubleType()),
    T.StructField("is_bot", T.IntegerType()),
    T.StructField("classification", T.StringType()),
    T.StructField("prediction_method", T.StringType()),
    T.StructField("detection_reasons", T.StringType()),
    T.StructField("detection_timestamp", T.TimestampType()),
    T.StructField("user_agent", T.StringType()),
])
