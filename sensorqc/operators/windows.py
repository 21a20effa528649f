"""The trailing five-minute window of every reading, in event time.

For each reading of a sensor the window holds the sensor's readings up to it,
in the order of (time, arrival number), with ``ts > t - 5 min``. Readings with
equal times are thus ordered by arrival, and in-order input gives the same
windows as W2. One ``Window`` pass computes everything the metrics need: size,
null counts, in-range counts, the first timestamp, and the number of adjacent
temperature pairs and of jumps among them. Each count is a difference of two
running sums (up to the row minus up to ``t - 5 min``), which Spark computes
incrementally, so the cost per row does not grow with the window (a bounded
sliding frame would be aggregated again for every row).

Scale: partitioning only by ``sensor_id`` would put a sensor's whole history
into one task, and one sensor may hold a third of all rows. Rows are therefore
partitioned by ``(sensor_id, time bucket)``; readings in the last window-length
of a bucket are copied into the next bucket as *context rows* that feed frames
but emit nothing. Buckets must be at least one window long, so a frame never
reaches back further than the previous bucket. Copies cost ``window/bucket``
extra rows (8 % with hourly buckets), and no task ever holds more than one
bucket of one sensor. A sensor with rate r keeps ``r * bucket`` rows in a task:
lower ``bucket_us`` (down to one window) where an hour of one sensor is more
than a task should sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import from_micros
from sensorqc.rules import DEFAULT_RULES, QualityRules, READING_FIELDS

DEFAULT_BUCKET_US = 3_600_000_000  # one hour


def reading_flags(rules: QualityRules) -> list[Column]:
    """Per-reading 0/1 flags: field null, field present, field in range."""
    cols = []
    for f in READING_FIELDS:
        lo, hi = rules.range_of(f)
        v = F.col(f)
        cols += [
            v.isNull().cast("int").alias(f"_{f}_null"),
            v.isNotNull().cast("int").alias(f"_{f}_nn"),
            # NaN is present but never inside a range (Spark orders NaN last).
            F.when(v.between(F.lit(lo), F.lit(hi)), 1).otherwise(0).alias(f"_{f}_ok"),
        ]
    return cols


def _next_pair_flags(rules: QualityRules) -> list[Column]:
    """Pair and jump flags of (this row, next row), from ``_next_t``."""
    t, nt = F.col("temperature"), F.col("_next_t")
    pair = t.isNotNull() & nt.isNotNull()
    diff = nt - t
    jump = pair & (F.abs(diff) > F.lit(rules.jump_limit)) & ~F.isnan(diff)
    return [F.coalesce(pair.cast("int"), F.lit(0)).alias("_pair_next"),
            F.coalesce(jump.cast("int"), F.lit(0)).alias("_jump_next")]


def prefix_stats(key, window_us: int) -> list[Column]:
    """Window statistics as differences of running sums, O(1) per row.

    The window of a row holds the rows up to it (by time, then arrival) minus
    those with ``ts <= t - W``. Pairs are attached to their earlier element
    (``_pair_next``), so the pairs inside the window are the running sum minus
    the current row's own flag, and the first timestamp of the window is the
    successor of the last timestamp before it.
    """
    upto = key.orderBy("us", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = key.orderBy("us").rangeBetween(Window.unboundedPreceding, -window_us)

    def diff(col: str) -> Column:
        return F.sum(col).over(upto) - F.coalesce(F.sum(col).over(before), F.lit(0))

    out = [(F.count(F.lit(1)).over(upto) - F.count(F.lit(1)).over(before)).alias("n")]
    for f in READING_FIELDS:
        out.append(diff(f"_{f}_null").alias(f"{f}_nulls"))
    for f in READING_FIELDS:
        out.append(diff(f"_{f}_nn").alias(f"{f}_n"))
        out.append(diff(f"_{f}_ok").alias(f"{f}_valid"))
    out.append((diff("_pair_next") - F.col("_pair_next")).alias("pairs"))
    out.append((diff("_jump_next") - F.col("_jump_next")).alias("jumps"))
    out.append(F.coalesce(F.max("_next_us").over(before), F.first("us").over(upto)).alias("_start_us"))
    return out


def _stats_projection(extra: list[str]) -> list[str]:
    cols = ["seq", "sensor_id"] + extra + ["us", "timestamp", "n"]
    cols += [f"{f}_nulls" for f in READING_FIELDS]
    for f in READING_FIELDS:
        cols += [f"{f}_n", f"{f}_valid"]
    return cols + ["pairs", "jumps", "window_start", "window_end"]


def trailing_window(readings: DataFrame, rules: QualityRules = DEFAULT_RULES,
                    bucket_us: int = DEFAULT_BUCKET_US) -> DataFrame:
    """Window statistics per reading (event-time form).

    ``readings`` needs ``seq, sensor_id, us, timestamp`` and the three fields;
    other columns (``area``) pass through. Output: one row per reading with
    ``n``, ``<field>_nulls``, ``<field>_n``, ``<field>_valid``, ``pairs``,
    ``jumps``, ``window_start`` (first in the window) and ``window_end``
    (the reading itself). Readings of one sensor with the same microsecond are
    ordered by ``seq``.
    """
    window_us = rules.window_us
    if bucket_us < window_us:
        raise ValueError("bucket_us must be at least one window long")
    passthrough = [c for c in readings.columns if c in ("area",)]
    us = F.col("us")
    bucket = F.expr(f"(us - pmod(us, {bucket_us})) div {bucket_us}")  # exact floor
    # A reading also serves as context of the next bucket when it lies in the
    # last window-length of its own bucket.
    into_next = F.pmod(us, F.lit(bucket_us)) > F.lit(bucket_us - window_us)
    spread = readings.select(
        "*",
        F.explode(F.when(into_next, F.array(bucket, bucket + 1)).otherwise(F.array(bucket))).alias("_bucket"),
        bucket.alias("_own"),
    )
    key = Window.partitionBy("sensor_id", "_bucket")
    order = key.orderBy("us", "seq")
    # flags of the pair (row, next row), attached to the earlier row
    nxt = (spread.select("*", *reading_flags(rules),
                         F.lead("temperature").over(order).alias("_next_t"),
                         F.lead("us").over(order).alias("_next_us")))
    stats = nxt.select("*", *_next_pair_flags(rules)).select(
        "seq", "sensor_id", *passthrough, "us", "timestamp", "_bucket", "_own",
        *prefix_stats(key, window_us),
    )
    return (
        stats.where(F.col("_bucket") == F.col("_own"))
        .withColumn("window_start", from_micros("_start_us"))
        .withColumn("window_end", F.col("timestamp"))
        .select(*_stats_projection(passthrough))
    )
