import os
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("client_ip", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("bytes_sent", T.LongType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("request_type", T.StringType()),
])


@pytest.fixture
def make_events(spark):
    """Log events from dicts; ``at`` is seconds after the start, None for no time."""

    def make(*rows):
        plain = []
        for number, row in enumerate(rows):
            at = row.get("at", 0)
            moment = None if at is None else START + timedelta(seconds=at)
            plain.append((
                row.get("id", number), moment, row.get("ip", "1.1.1.1"), "GET", row.get("path", "/"),
                row.get("status", 200), row.get("bytes", 100), row.get("agent", "Mozilla/5.0"),
                row.get("protocol", "TCP"), row.get("port", 80), row.get("type", "HTTP"),
            ))
        return spark.createDataFrame(plain, EVENT)

    return make


@pytest.fixture(scope="session")
def dense(spark):
    from botlens import fixtures

    return fixtures.access_logs(fixtures.events_table(spark, DATA), dense=True)
