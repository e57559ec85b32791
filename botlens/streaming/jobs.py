"""Runnable streaming jobs: ``python -m botlens.streaming.jobs rule|model ...``."""

from __future__ import annotations

import argparse
import logging
import signal
import threading
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from botlens.config import PRESETS, Settings, load_settings
from botlens.operators.detections import display_rows, with_detection_id
from botlens.operators.scoring import stamp
from botlens.plans import detectors
from botlens.sources import access_log, topic
from botlens.streaming import open_windows, sinks

log = logging.getLogger(__name__)


def rule_stream(events: DataFrame, settings: Settings) -> DataFrame:
    """Rule detections of an event stream, for update mode."""
    return stamp(with_detection_id(detectors.rule_detections(events, settings)))


def model_stream(events: DataFrame, settings: Settings, spark: SparkSession) -> DataFrame:
    """Model (or fallback) detections of an event stream."""
    model = detectors.load_model(spark, settings.ml.model_path)
    return stamp(with_detection_id(detectors.model_detections(events, settings, model, settings.ml.temporal)))


def line_stream(spark: SparkSession, settings: Settings, folder: str) -> DataFrame:
    """Lines of a log folder: followed as files grow and rotate, or whole files where those are limited per batch."""
    limit = settings.streaming.max_files_per_trigger
    return access_log.stream_lines(spark, folder, limit) if limit else access_log.follow_lines(spark, folder)


def event_stream(spark: SparkSession, settings: Settings, folder: str | None) -> DataFrame:
    """Log events from a folder of access logs, or else from the topic.

    Counts what comes in and what is lost on the way as observed metrics: ``received`` (n) and
    ``decoded`` (n, without_time). Lines that do not parse are the difference of the two n.
    """
    received = F.count(F.lit(1)).alias("n")
    if folder:
        lines = line_stream(spark, settings, folder).observe("received", received)
        events = access_log.events_from_lines(lines)
    else:
        messages = topic.read_topic(spark, settings).select("value").observe("received", received)
        events = topic.decode_json_events(messages)
    return events.observe("decoded", received, F.count_if(F.col("timestamp").isNull()).alias("without_time"))


def losses(metrics: Mapping) -> dict[str, int]:
    """Lines that did not parse and events without time of one batch's observed metrics."""
    received, decoded = metrics.get("received"), metrics.get("decoded")
    if received is None or decoded is None:
        return {}
    return {"unparsed": received["n"] - decoded["n"], "without_time": decoded["without_time"]}


class LossLog(StreamingQueryListener):
    """Logs how many lines and events a batch could not use, and keeps the sums."""

    def __init__(self):
        self.total: Counter = Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        found = losses({name: row.asDict() for name, row in event.progress.observedMetrics.items()})
        self.total.update(found)
        if any(found.values()):
            log.warning("batch %s of %s: %s", event.progress.batchId, event.progress.name, found)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def await_end(query: StreamingQuery, stopping: threading.Event) -> None:
    """Wait for the query; once ``stopping`` is set, let the running batch end and stop it."""
    while not query.awaitTermination(1):
        if stopping.is_set():
            while query.isActive and query.status["isTriggerActive"]:
                query.awaitTermination(1)
            query.stop()
            return


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Detect bots in an access-log stream.")
    parser.add_argument("job", choices=["rule", "model"])
    parser.add_argument("--config", help="YAML or JSON settings over the preset")
    parser.add_argument("--preset", choices=sorted(PRESETS), default="sensitive")
    parser.add_argument("--model", help="folder of a saved model")
    parser.add_argument("--temporal", choices=["zero", "exact"], help="arrival-time features of the model")
    parser.add_argument("--logs", help="folder of access logs; default is the topic")
    parser.add_argument("--store", help="folder for detections; default is the console")
    parser.add_argument("--quarantine", help="folder for log lines that do not parse")
    parser.add_argument("--finish", action="store_true", help="model job: at its end, store open windows as provisional")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    args = parser.parse_args(arguments)

    settings = load_settings(args.config, PRESETS[args.preset])
    if args.model:
        settings = settings.override({"ml": {"model_path": args.model}})
    if args.temporal:
        settings = settings.override({"ml": {"temporal": args.temporal}})
    spark = SparkSession.builder.appName(f"botlens-{args.job}").getOrCreate()
    events = event_stream(spark, settings, args.logs)
    if args.job == "rule":
        rows, mode = rule_stream(events, settings), "update"
    else:
        rows, mode = model_stream(events, settings, spark), "append"
    stopping = threading.Event()
    handlers = {n: signal.signal(n, lambda *_: stopping.set()) for n in (signal.SIGTERM, signal.SIGINT)}
    seen = LossLog()
    spark.streams.addListener(seen)
    aside = None
    if args.quarantine and args.logs:
        bad = access_log.quarantined_lines(line_stream(spark, settings, args.logs))
        aside = sinks.start_lines(bad, settings, f"{args.job}-quarantine", args.quarantine, args.once)
    if args.store:
        store = sinks.DetectionStore(args.store, args.job, settings.streaming.compact_every)
        query = store.start(rows, settings, mode, args.once)
    else:
        shown = display_rows(rows) if args.job == "model" else rows
        query = sinks.start_console(shown, settings, args.job, shown=50, once=args.once)
    await_end(query, stopping)
    if aside is not None:
        await_end(aside, stopping)
    if args.finish and args.job == "model" and args.store:
        open_windows.write_open_windows(spark, settings, store)
    spark.streams.removeListener(seen)
    for number, handler in handlers.items():
        signal.signal(number, handler)


if __name__ == "__main__":
    main()
