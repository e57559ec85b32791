"""Access logs derived from an ``events`` table, for queries and tests.

The expressions are plain SQL that means the same in Spark and in other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botlens import values

# Declared, so that opening the table starts no job to look for a schema.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

EVENT_COLUMNS = {
    "client_ip": """case when event_id % 4 = 0 then '10.0.0.' || cast(user_id % 3 as string)
        else '203.0.' || cast(cast(floor(user_id / 250e0) as int) as string)
             || '.' || cast(user_id % 250 as string) end""",
    "method": "case event_type when 'purchase' then 'POST' when 'signup' then 'PUT' else 'GET' end",
    "path": """case when event_id % 11 = 0 then '/wp-admin' when event_id % 7 = 0 then '/.env'
        else '/' || event_type end""",
    "status": """cast(case when event_type = 'error' and user_id % 3 = 0 then 404
        when event_type = 'error' and user_id % 3 = 1 then 503
        when event_type = 'error' then 429
        when user_id % 6 = 5 and event_type <> 'view' then 403
        when event_type = 'view' then 304 else 200 end as int)""",
    "bytes_sent": "cast(round(value * 100) as bigint)",
    "user_agent": """case when event_id % 13 = 0 then cast(null as string)
        when event_id % 17 = 0 then ''
        when event_id % 4 = 0 or user_id % 10 = 3 then 'python-requests/2.31.0'
        when user_id % 10 = 4 then 'Mozilla/5.0 (compatible; Googlebot/2.1)'
        when user_id % 10 = 5 then 'Scrapy/2.11.0' when user_id % 10 = 6 then 'sqlmap/1.7'
        else 'Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0 Safari/537.36' end""",
    "referer": "'-'",
    "log_type": f"'{values.LOG_TYPE}'",
    "protocol": "case when event_id % 23 = 0 then 'UDP' else 'TCP' end",
    "port": """cast(case when event_id % 19 = 0 then null when user_id % 2 = 0 then 443
        else 80 end as int)""",
    "request_type": """case when event_id % 19 = 0 then cast(null as string)
        when user_id % 2 = 0 then 'HTTPS' else 'HTTP' end""",
}
DENSE_START_MS, DENSE_STEP_MS = 1704067200000, 250

# Raw lines: some lack the agent tail or the extension fields, some have an odd
# request, size or time, and some are cut off and do not parse.
RAW_LINE = """client_ip || ' - - [' || case when event_id % 53 = 0 then 'no time' else {clf} end || '] "'
    || case when event_id % 37 = 0 then '-'
            when event_id % 41 = 0 then method || ' ' || path || '/a b HTTP/1.1'
            else method || ' ' || path || ' HTTP/1.1' end || '" '
    || cast(status as string) || ' '
    || case when event_id % 43 = 0 then '-' when event_id % 59 = 0 then '12x'
            else cast(bytes_sent as string) end
    || case when event_id % 29 = 0 or user_agent is null then ''
            else ' "' || referer || '" "' || user_agent || '"' end
    || case when event_id % 31 = 0 or port is null then ''
            else ' protocol=' || protocol || ' port=' || cast(port as string)
                 || ' request_type=' || request_type end"""
LINE = "case when event_id % 47 = 0 then substr(whole, 1, 40) else whole end"

# Messages: some are cut off, some carry a status that is no number.
MESSAGE = """case when event_id % 47 = 0 then substr(body, 1, 60)
    when event_id % 59 = 0 then replace(body, '"status":', '"status":"x","was":')
    when event_id % 61 = 0 then replace(body, '"timestamp":"2', '"timestamp":"on 2')
    else body end"""


def events_table(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def access_logs(events: DataFrame, dense: bool = False) -> DataFrame:
    """Log events; ``dense`` spaces them a quarter of a second apart in id order."""
    time = F.col("ts").cast("timestamp")
    if dense:
        time = F.timestamp_millis(F.lit(DENSE_START_MS) + F.col("event_id") * DENSE_STEP_MS)
    columns = [F.expr(sql).alias(name) for name, sql in EVENT_COLUMNS.items()]
    return events.select("event_id", time.alias("timestamp"), *columns)


def raw_lines(logs: DataFrame) -> DataFrame:
    """Log events as raw lines, with ``event_id`` kept next to ``value``."""
    clf = "date_format(timestamp, 'dd/MMM/yyyy:HH:mm:ss') || ' +0000'"
    whole = F.expr(RAW_LINE.format(clf=clf)).alias("whole")
    return logs.select("event_id", whole).select("event_id", F.expr(LINE).alias("value"))


def damaged_messages(encoded: DataFrame) -> DataFrame:
    """JSON messages with some damaged ones."""
    body = encoded.withColumnRenamed("value", "body")
    return body.select("event_id", F.expr(MESSAGE).alias("value"))
