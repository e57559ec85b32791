"""Detection tables on disk: typed, partitioned by day, exportable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "detection_date"


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the columns of the schema, in its order and with its types."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_detections(detections: DataFrame, path: str, mode: str = "append") -> None:
    """Write detections as Parquet, one folder per day of the window start.

    The rebalance hint lets adaptive execution size the files and split a day
    that holds most of the rows.
    """
    (
        detections.withColumn(DAY, F.to_date("window_start"))
        .hint("rebalance", DAY)
        .write.mode(mode)
        .partitionBy(DAY)
        .parquet(path)
    )


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_rows(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """Export report rows as CSV (with header) or JSON lines."""
    if kind == "csv":
        rows.write.mode("overwrite").option("header", True).csv(path)
    elif kind == "json":
        rows.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"cannot export as {kind!r}")
