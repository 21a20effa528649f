"""The sliding aggregate as a streaming query.

Watermark (2 minutes by default) on the event time, five-minute windows
sliding by one minute per sensor, ``update`` output mode and a processing-time
trigger (30 s by default). Each query gets its own checkpoint location; tests
use ``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

from sensorqc.functions.timeutil import to_micros
from sensorqc.operators.sliding import pane_aggregate_stream, sliding_aggregate


def sliding_aggregate_stream(readings: DataFrame, watermark: str = "2 minutes", window: str = "5 minutes",
                             slide: str = "1 minute", ts_col: str = "timestamp", panes: bool = False) -> DataFrame:
    """R1 + R2: windowed aggregate; rows later than the watermark are dropped.

    ``panes`` aggregates panes first and combines them, for queries in append
    mode (:func:`sensorqc.operators.sliding.pane_aggregate_stream`).

    Watermarks need an instant (``TIMESTAMP``); NTZ reading times are turned
    into one through their microseconds, independent of the session zone.
    """
    if isinstance(readings.schema[ts_col].dataType, TimestampNTZType):
        readings = readings.withColumn("_event_time", F.timestamp_micros(to_micros(ts_col)))
        ts_col = "_event_time"
    readings = readings.withWatermark(ts_col, watermark)
    if panes:
        return pane_aggregate_stream(readings, window, slide, ts_col)
    return sliding_aggregate(readings, window, slide, panes=False, ts_col=ts_col)


def start_stream(df: DataFrame, checkpoint: str, fmt: str = "console", output_mode: str = "update",
                 trigger_seconds: int | None = 30, available_now: bool = False, query_name: str | None = None,
                 options: dict | None = None, path: str | None = None) -> StreamingQuery:
    """R3 + R4: start a query with its own checkpoint location.

    ``fmt='console'`` prints untruncated rows (S8); ``memory`` needs a
    ``query_name``; file formats need ``path``.
    """
    w = df.writeStream.outputMode(output_mode).format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.option("truncate", False)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(path) if path else w.start()
