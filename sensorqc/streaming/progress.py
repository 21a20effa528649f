"""R7 and G16 (progress part): processed-reading counts of running queries."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


def observe_processed(stream: DataFrame, name: str = "sensorqc_progress") -> DataFrame:
    """Attach a per-batch count of processed readings to the query progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("processed"))


PROGRESS = "progress"
_PROGRESS_SCHEMA = "batch bigint, rows bigint, total bigint"


def record_processed(spark: SparkSession, base: str, run: str | None, batch_id: int, rows: int) -> None:
    """Records a micro-batch's readings and the run's total with it, in ``<base>/progress/run=<run>``.

    One small file per micro-batch, of which the last two are kept: a replayed
    batch adds to the total before it, not to its own.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{base.rstrip('/')}/{PROGRESS}/run={run or 'none'}"
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    kept = sorted(f.getPath().getName() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("batch-"))
    name = f"batch-{batch_id:010d}.json"
    total, before = rows, [f for f in kept if f < name]
    if before:
        stream = fs.open(path(folder, before[-1]))
        try:
            total += json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["total"]
        finally:
            stream.close()
    draft = path(folder, f"_{name}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"batch": batch_id, "rows": rows, "total": total}).encode()))
    finally:
        out.close()
    fs.delete(path(folder, name), False)
    fs.rename(draft, path(folder, name))
    for old in before[:-1]:
        fs.delete(path(folder, old), False)


def processed_count(spark: SparkSession, base: str) -> DataFrame:
    """Readings processed by all streams into ``base`` so far, one row (``processed_count``).

    Read from the progress records (two small files a run), which neither
    compaction nor retention touches.
    """
    records = spark.read.schema(f"{_PROGRESS_SCHEMA}, run string").json(f"{base.rstrip('/')}/{PROGRESS}")
    return (records.groupBy("run").agg(F.max_by("total", "batch").alias("total"))
            .agg(F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("processed_count")))


class ProcessedCounter(StreamingQueryListener):
    """Cumulative input rows per query; logs every ``log_every`` rows."""

    def __init__(self, log_every: int = 100):
        self.log_every = log_every
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        qid = str(event.progress.id)
        before = self.counts.get(qid, 0)
        after = before + int(event.progress.numInputRows)
        self.counts[qid] = after
        if after // self.log_every > before // self.log_every:
            log.info("Processed %d data points", after)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def processed(self, query: StreamingQuery) -> int:
        return self.counts.get(str(query.id), 0)
