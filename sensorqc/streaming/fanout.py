"""Per micro-batch fan-out of the stateful output to every sink.

``foreachBatch`` receives the window statistics of one micro-batch and, from
one persisted copy, writes raw readings, metrics, alerts and notification
payloads, and optionally hourly partial aggregates (``rollups``) and the published metric records. Rejected messages go to
their own table from a query of their own (:class:`Rejects`). Every table
write is the batch of that number of the running query, whose id its
checkpoint keeps, and replaces itself: a micro-batch replayed after a failure
leaves no duplicates, and a stream started on a new checkpoint leaves the rows
of earlier ones alone. Published files are replaced alike. (A Kafka publish is
at-least-once; consumers dedupe on ``(sensor_id, timestamp, metric_name)``.)
The number of files of a write follows from the micro-batch's row count, so a
backlog is written by as many tasks as it needs. At last the count of
processed readings is recorded (:mod:`sensorqc.streaming.progress`).

Small batches make small files: finished days are rewritten by
:func:`sensorqc.sinks.tables.compact_day`.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorqc.operators.alerts import build_alerts, quality_notifications_of
from sensorqc.operators.metrics import evaluate_all
from sensorqc.rules import DEFAULT_RULES, QualityRules
from sensorqc.sinks.tables import (append_alerts, append_metrics, append_readings, append_rejects, append_rollups, batch_name,
                                  publish_metrics, run_of, write_batch)
from sensorqc.sources.readings import accept_readings, parse_readings, reject_readings
from sensorqc.streaming.progress import record_processed
from sensorqc.streaming.stateful import stateful_quality

#: Rows of one written file, and the most metric rows that a reading gives.
ROWS_PER_FILE = 250_000
METRICS_PER_READING = 6


def _clock(spark: SparkSession) -> Column:
    """The present wall-clock time in the session's zone, as one literal per micro-batch."""
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    return F.lit(datetime.now(zone).replace(tzinfo=None)).cast("timestamp_ntz")


class FanOut:
    """Callable for ``writeStream.foreachBatch``."""

    def __init__(self, base_path: str, rules: QualityRules = DEFAULT_RULES, publish_fmt: str | None = None,
                 publish_options: dict | None = None, publish_path: str | None = None,
                 evaluated_at_reading_time: bool = False, run: str | None = None, rows_per_file: int = ROWS_PER_FILE,
                 rollups: bool = False):
        self.rollups = rollups
        self.base = base_path.rstrip("/")
        self.rules = rules
        self.publish = (publish_fmt, publish_options, publish_path)
        self.at_reading = evaluated_at_reading_time
        self.run, self.rows_per_file = run, rows_per_file

    def _files(self, rows: int) -> int:
        return max(1, -(-rows // self.rows_per_file))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stats = batch.persist()
        run = self.run or run_of(batch.sparkSession)
        try:
            rows = stats.count()
            now = _clock(batch.sparkSession)
            at = F.col("timestamp") if self.at_reading else now
            few, more = self._files(rows), self._files(METRICS_PER_READING * rows)
            one = {"batch_id": batch_id, "run": run}
            append_readings(stats, f"{self.base}/sensor_data", received_at=now, files=few, **one)
            metrics = evaluate_all(stats, self.rules, evaluated_at=at)
            append_metrics(metrics, f"{self.base}/quality_metrics", created_at=now, files=more, **one)
            append_alerts(build_alerts(metrics), f"{self.base}/alerts", created_at=now, files=more, **one)
            messages = quality_notifications_of(stats.withColumn("timestamp", at), self.rules)
            write_batch(messages.withColumn("dt", F.to_date("timestamp")).coalesce(few), f"{self.base}/notifications",
                        "notifications", cluster=False, **one)
            if self.rollups:
                append_rollups(stats, metrics, self.base, files=more, **one)
            fmt, options, path = self.publish
            if fmt:
                publish_metrics(metrics, fmt, options, path, batch_name(batch_id, run))
            record_processed(batch.sparkSession, self.base, run, batch_id, rows)
        finally:
            stats.unpersist()


class Rejects:
    """Callable for ``foreachBatch`` on rejected messages: the table ``rejects``."""

    def __init__(self, base_path: str, run: str | None = None):
        self.path, self.run = f"{base_path.rstrip('/')}/rejects", run

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        append_rejects(batch, self.path, batch_id, rejected_at=_clock(batch.sparkSession), run=self.run)


def start_pipeline(messages: DataFrame, base_path: str, checkpoint: str, rules: QualityRules = DEFAULT_RULES,
                   trigger: dict | None = None, evaluated_at_reading_time: bool = False, rollups: bool = False,
                   **stateful) -> list[StreamingQuery]:
    """Messages -> all tables: one query for readings and what follows, one for rejects.

    ``trigger`` as for ``writeStream.trigger`` (default: every 30 seconds).
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    parsed = parse_readings(messages)
    fan_out = FanOut(base_path, rules, evaluated_at_reading_time=evaluated_at_reading_time, rollups=rollups)
    sinks = (("readings", stateful_quality(accept_readings(parsed), rules, **stateful), fan_out),
             ("rejects", reject_readings(parsed), Rejects(base_path)))
    return [df.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
            .trigger(**trigger).start() for name, df, sink in sinks]
