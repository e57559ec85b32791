"""Raw access-log lines: read, parse, set aside what does not parse, normalize."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botlens import values
from botlens.schema import LOG_EVENT
from botlens.sources import log_tail

_ONE_GROUP_PER_LINE = "\n".join(f"${i + 1}" for i in range(len(values.ACCESS_LOG_GROUPS)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines of a file or folder, ``.gz`` included, as column ``value``."""
    return spark.read.text(path)


def stream_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Read the files of a log folder, each once and as a whole, new ones as they come (``.gz`` too).

    Lines that are appended to a file later are not seen: use :func:`follow_lines` for those.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def follow_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Follow the growing and rotated files of a log folder, each line once, as column ``value``."""
    return log_tail.tail_lines(spark, path, pattern).select("value")


def _groups(line: Column) -> Column:
    # One regex pass per line: a matching line is rewritten to its groups, one
    # per row, and split there. A line holds no line break itself, so a line
    # that does not match stays in one piece.
    rewritten = F.regexp_replace(line, values.ACCESS_LOG_PATTERN_LINEAR, F.lit(_ONE_GROUP_PER_LINE))
    return F.when(~line.contains("\n"), F.split(rewritten, "\n", -1))


def parse_access_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text fields of every line that matches the format; other columns are kept.

    A missing agent tail gives NULL agent and referer, a present but empty one
    gives ``''``; the optional extension fields are ``''`` where absent.
    """
    keep = [F.col(name) for name in lines.columns if name != column]
    parts = F.col("_parts")
    group = {name: parts[i] for i, name in enumerate(values.ACCESS_LOG_GROUPS)}
    for name in ("referer", "agent"):
        group[name] = F.when(group["tail"] != "", group[name])
    fields = F.struct(*[group[n].alias(n) for n in values.ACCESS_LOG_GROUPS if n != "tail"])
    matched = F.size(parts) == len(values.ACCESS_LOG_GROUPS)
    # A filter would be pushed below the split and run the regex twice; as a list
    # of no or one row the groups are computed once.
    found = F.when(matched, F.array(fields)).otherwise(F.array())
    return lines.select(*keep, _groups(F.col(column)).alias("_parts")).select(*keep, F.inline(found))


def quarantined_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that do not match the format."""
    # A match needs no groups here, so a plain regex test is enough.
    line = F.col(column)
    matches = line.rlike(values.ACCESS_LOG_PATTERN_LINEAR) & ~line.contains("\n")
    return lines.where(~F.coalesce(matches, F.lit(False)))


def leading_int(text: Column, kind: str) -> Column:
    """Leading integer of a text, 0 when there is none."""
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)", 1)
    return F.coalesce(text.try_cast(kind), digits.try_cast(kind), F.lit(0).cast(kind))


def log_time(text: Column) -> Column:
    """``10/Oct/2024:13:55:36 +0000`` as a timestamp, NULL where it is no such time."""
    return F.try_to_timestamp(text, F.lit(values.ACCESS_LOG_TIME))


def event_time_text(moment: Column) -> Column:
    """ISO text with milliseconds and ``Z``, whatever the session time zone is."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, values.EVENT_TIME)


def normalize_access_log(parsed: DataFrame, time_as_text: bool = True) -> DataFrame:
    """Parsed lines as log events, with defaults for the optional fields.

    The time is ISO text, as in a message, or a timestamp.
    """
    moment = log_time(F.col("time"))
    keep = [F.col(c) for c in parsed.columns if c not in values.ACCESS_LOG_GROUPS]
    text_or = lambda name, default: F.coalesce(
        F.nullif(F.col(name), F.lit("")), F.lit(default)
    )
    event = {
        "timestamp": event_time_text(moment) if time_as_text else moment,
        "client_ip": F.col("remote"),
        "method": F.col("method"),
        "path": F.col("path"),
        "status": leading_int(F.col("code"), "int"),
        "bytes_sent": leading_int(F.col("size"), "bigint"),
        "user_agent": F.col("agent"),
        "referer": F.col("referer"),
        "log_type": F.lit(values.LOG_TYPE),
        "protocol": text_or("protocol", values.DEFAULT_PROTOCOL),
        "port": F.coalesce(F.col("port").try_cast("int"), F.lit(values.DEFAULT_PORT)),
        "request_type": text_or("request_type", values.DEFAULT_REQUEST_TYPE),
    }
    return parsed.select(*keep, *[event[f.name].alias(f.name) for f in LOG_EVENT.fields])


def events_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines straight to log events with a real timestamp."""
    return normalize_access_log(parse_access_log(lines, column), time_as_text=False)
