"""Stream sinks: console, external store, and detection tables written per batch."""

from __future__ import annotations

import logging
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from botlens.config import Settings
from botlens.operators.detections import latest_per_client
from botlens.operators.learning import stats_columns
from botlens.sources.tables import DAY

log = logging.getLogger(__name__)


def _writer(rows: DataFrame, mode: str, settings: Settings, name: str, once: bool):
    writer = rows.writeStream.outputMode(mode).queryName(name)
    if settings.checkpoint.location:
        writer = writer.option("checkpointLocation", f"{settings.checkpoint.location}/{name}")
    if once:
        return writer.trigger(availableNow=True)
    if settings.streaming.trigger_interval:
        return writer.trigger(processingTime=settings.streaming.trigger_interval)
    return writer


def start_console(
    rows: DataFrame, settings: Settings, name: str, shown: int = 20, once: bool = False
) -> StreamingQuery:
    """Print changed windows after every batch, untruncated."""
    writer = _writer(rows, "update", settings, name, once)
    return writer.format("console").option("truncate", False).option("numRows", shown).start()


def start_external(
    rows: DataFrame, settings: Settings, name: str, sink: str, options: dict[str, str],
    once: bool = False,
) -> StreamingQuery:
    """Send changed windows to a connector that must be on the classpath.

    For a keyed document store, map the document id to ``client_ip`` to keep the
    newest detection per client, or to ``detection_id`` to keep all of them.
    """
    return _writer(rows, "update", settings, name, once).format(sink).options(**options).start()


def start_lines(
    lines: DataFrame, settings: Settings, name: str, path: str, once: bool = False
) -> StreamingQuery:
    """Append text lines to a folder, each once; needs ``checkpoint.location``."""
    if not settings.checkpoint.location:
        raise ValueError("a folder of lines needs checkpoint.location")
    return _writer(lines, "append", settings, name, once).format("text").option("path", path).start()


class DetectionStore:
    """Detections of a stream as Parquet, in one folder per day, run and batch.

    A replayed batch replaces its own folders, so at-least-once delivery leaves
    each row once. A run is a name and, in a streaming query, the query id that
    Spark keeps in the checkpoint: a query with a new checkpoint counts its
    batches from 0 again and is another run. ``commit`` (microseconds at writing)
    grows over all runs and decides which of two states of a window is newer.

    :meth:`compact` puts the last state of every window into a new version below
    ``_compacted`` and notes the newest batch of each run that it covers; batches
    up to it are not read any more. Versions and batches that the version before
    already replaced are deleted, so a reader has one compaction's time to finish.
    """

    def __init__(self, path: str, run: str = "main", compact_every: int | None = None):
        self.path = path
        self.run = run
        self.compact_every = compact_every

    def _run_name(self, spark: SparkSession) -> str:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{self.run}-{query}" if query else self.run

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        stats = Observation()
        columns = [F.count(F.lit(1)).alias("row_count")]
        if "bot_probability" in batch.columns:
            columns = stats_columns()
        (
            batch.observe(stats, *columns)
            .withColumns({
                DAY: F.to_date("window_start"),
                "run": F.lit(self._run_name(batch.sparkSession)),
                "batch_id": F.lit(batch_id).cast("bigint"),
                "commit": F.lit(time.time_ns() // 1000).cast("bigint"),
            })
            .hint("rebalance", DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY, "run", "batch_id")
            .parquet(self.path)
        )
        # An empty batch writes no folder; adaptive execution drops it together with its numbers.
        try:
            seen = stats.get
        except Py4JJavaError:
            seen = {}
        if seen.get("row_count"):
            log.info("batch %s: %s", batch_id, seen)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact(batch.sparkSession)

    def start(
        self, rows: DataFrame, settings: Settings, mode: str = "append", once: bool = False
    ) -> StreamingQuery:
        if not settings.checkpoint.location:
            raise ValueError("a detection store needs checkpoint.location: batches are told apart by it")
        writer = _writer(rows, mode, settings, self.run, once)
        return writer.foreachBatch(self.write_batch).start()

    def _files(self, spark: SparkSession, pattern: str):
        """The file system and the paths that match a pattern below the store."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return files, [found.getPath() for found in files.globStatus(path) or ()]

    def _versions(self, spark: SparkSession) -> list[str]:
        """Finished versions, oldest first."""
        _, done = self._files(spark, "_compacted/*/_DONE")
        return sorted(mark.getParent().getName() for mark in done)

    def _covered(self, spark: SparkSession, version: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/_compacted/{version}/covers")

    def _batches(self, spark: SparkSession) -> DataFrame | None:
        """Rows of single batches; None where no batch has written any."""
        if not self._files(spark, f"{DAY}=*/run=*/batch_id=*/*.parquet")[1]:
            return None
        return spark.read.option("mergeSchema", True).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """All written rows; an update-mode stream writes a window once per change."""
        versions, batches = self._versions(spark), self._batches(spark)
        if not versions:
            return batches if batches is not None else spark.read.parquet(self.path)
        kept = spark.read.parquet(f"{self.path}/_compacted/{versions[-1]}/rows")
        if batches is None:
            return kept
        covers = self._covered(spark, versions[-1])
        new = batches.join(covers, "run", "left").where("newest is null or batch_id > newest").drop("newest")
        return kept.unionByName(new, allowMissingColumns=True)

    def windows(self, spark: SparkSession) -> DataFrame:
        """The last state of every window and client."""
        return latest_per_client(
            self.read(spark), newest=("commit",), keys=("window_start", "client_ip")
        )

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest detection of every client."""
        return latest_per_client(self.read(spark), newest=("window_end", "commit"))

    def compact(self, spark: SparkSession) -> None:
        """Replace the rows written so far by the last state of every window."""
        batches, before = self._batches(spark), self._versions(spark)
        if batches is None:
            return
        version = f"{time.time_ns() // 1000:020d}"
        folder = f"{self.path}/_compacted/{version}"
        # Noted first: a batch that another run adds from now on is not covered.
        covers = batches.groupBy("run").agg(F.max("batch_id").alias("newest"))
        if before:
            covers = covers.union(self._covered(spark, before[-1]))
        covers.groupBy("run").agg(F.max("newest").alias("newest")).write.parquet(f"{folder}/covers")
        limits = spark.read.parquet(f"{folder}/covers")
        state = self.windows(spark).join(limits, "run", "left").where("batch_id <= newest").drop("newest")
        state.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{folder}/rows")
        files, _ = self._files(spark, "_compacted")
        files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_DONE")).close()
        self._delete_replaced(spark, before)

    def _delete_replaced(self, spark: SparkSession, before: list[str]) -> None:
        """Delete what the newest of the versions before had replaced."""
        if not before:
            return
        # One row per run of the store.
        newest = {r["run"]: r["newest"] for r in self._covered(spark, before[-1]).collect()}
        files, folders = self._files(spark, f"{DAY}=*/run=*/batch_id=*")
        for path in folders:
            run = path.getParent().getName().removeprefix("run=")
            if int(path.getName().removeprefix("batch_id=")) <= newest.get(run, -1):
                files.delete(path, True)
        for version in before[:-1]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_compacted/{version}"), True)
