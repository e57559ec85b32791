"""JSON messages: topic source and sink, encoding and decoding of log events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botlens.config import Settings
from botlens.schema import LOG_EVENT


def topic_options(settings: Settings) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.kafka.bootstrap_servers,
        "subscribe": settings.kafka.topic,
        "startingOffsets": settings.kafka.starting_offsets,
        "failOnDataLoss": str(settings.kafka.fail_on_data_loss).lower(),
    }
    if settings.streaming.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(settings.streaming.max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, settings: Settings, source: str = "kafka") -> DataFrame:
    """Stream of messages with a ``value`` column; the connector must be on the classpath."""
    return spark.readStream.format(source).options(**topic_options(settings)).load()


def decode_json_events(messages: DataFrame, column: str = "value") -> DataFrame:
    """Messages as log events with a real timestamp.

    A message that is no JSON gives a row of NULLs, a field of the wrong type or
    a bad time gives NULL there; other columns of the messages are kept.
    """
    keep = [F.col(c) for c in messages.columns if c != column]
    event = F.from_json(F.col(column).cast("string"), LOG_EVENT)
    rows = messages.select(*keep, event.alias("_event")).select(*keep, "_event.*")
    return rows.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def encode_json_events(events: DataFrame) -> DataFrame:
    """Log events as JSON text in ``value``; NULL fields are written out.

    Columns outside the event schema are kept next to it.
    """
    names = [f.name for f in LOG_EVENT.fields]
    keep = [F.col(c) for c in events.columns if c not in names]
    body = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return events.select(*keep, body.alias("value"))


def write_topic(events: DataFrame, settings: Settings, sink: str = "kafka") -> None:
    """Append log events to the topic as compressed JSON messages, acknowledged by all replicas."""
    (
        encode_json_events(events)
        .select("value")
        .write.format(sink)
        .option("kafka.bootstrap.servers", settings.kafka.bootstrap_servers)
        .option("kafka.acks", "-1")
        .option("kafka.compression.type", "gzip")
        .option("topic", settings.kafka.topic)
        .save()
    )
