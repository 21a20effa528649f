"""Five-minute windows sliding by one minute, per sensor.

Two plans with the same result:

* ``panes=False`` — Spark's ``window()``: each reading is expanded into the
  five windows that contain it, then aggregated (partial + final).
* ``panes=True`` — first aggregate one-minute panes per sensor (count, sums,
  and the centred second moment of temperature), then combine the five panes
  of each window. Readings are touched once and only pane rows (far fewer)
  are expanded and shuffled again; the sample standard deviation is combined
  exactly from per-pane moments (Chan et al.).

Streams have both forms: the pane form chains two stateful aggregations, see
:func:`pane_aggregate_stream`. Windows start at multiples of the slide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from sensorqc.functions.timeutil import from_micros, to_micros

FIELDS = ("temperature", "humidity", "wind_speed")
AGG_COLUMNS = ("window_start", "window_end", "sensor_id", "record_count",
               "avg_temperature", "avg_humidity", "avg_wind_speed", "temp_stddev")


def _duration_us(text: str) -> int:
    value, unit = text.split()
    scale = {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]
    return int(float(value) * scale * 1_000_000)


def sliding_aggregate(readings: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                      panes: bool = False, ts_col: str = "timestamp", field_type: str = "float") -> DataFrame:
    """Count, three averages and the sample stddev of temperature per window.

    The aggregated readings are typed ``field_type`` first: the sliding
    aggregate's message schema declares the three fields as 32-bit floats, so
    averages are taken over float-rounded values (``"double"`` keeps them).
    """
    readings = _float_fields(readings, field_type)
    if panes:
        return _pane_aggregate(readings, _duration_us(window), _duration_us(slide), ts_col)
    w = F.window(ts_col, window, slide)
    # window bounds back to NTZ through microseconds (no session time zone)
    us = to_micros if isinstance(readings.schema[ts_col].dataType, TimestampNTZType) else F.unix_micros
    return (
        readings.groupBy(w.alias("w"), "sensor_id")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.avg("temperature").alias("avg_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("wind_speed").alias("avg_wind_speed"),
            F.stddev_samp("temperature").alias("temp_stddev"),
        )
        .select(from_micros(us(F.col("w.start"))).alias("window_start"),
                from_micros(us(F.col("w.end"))).alias("window_end"),
                *AGG_COLUMNS[2:])
    )


def _moments() -> list[Column]:
    """A pane's counts and sums, and the centred second moment of temperature."""
    t = F.col("temperature")
    return [F.count(F.lit(1)).alias("n"),
            F.count("temperature").alias("t_n"), F.sum("temperature").alias("t_sum"),
            (F.var_pop(t) * F.count(t)).alias("t_m2"),
            F.count("humidity").alias("h_n"), F.sum("humidity").alias("h_sum"),
            F.count("wind_speed").alias("w_n"), F.sum("wind_speed").alias("w_sum")]


def _combined() -> list[Column]:
    """A window's figures from its panes' :func:`_moments`."""
    t_n = F.sum("t_n")
    t_sum = F.sum("t_sum")
    # Combined M2 = sum(M2_i) + sum(S_i^2 / n_i) - S^2 / n
    m2 = (F.sum(F.coalesce("t_m2", F.lit(0.0)))
          + F.sum(F.when(F.col("t_n") > 0, F.col("t_sum") * F.col("t_sum") / F.col("t_n")))
          - t_sum * t_sum / t_n)
    return [F.sum("n").alias("record_count"),
            F.try_divide(t_sum, t_n).alias("avg_temperature"),
            F.try_divide(F.sum("h_sum"), F.sum("h_n")).alias("avg_humidity"),
            F.try_divide(F.sum("w_sum"), F.sum("w_n")).alias("avg_wind_speed"),
            F.when(t_n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (t_n - 1))).alias("temp_stddev")]


def _float_fields(readings: DataFrame, field_type: str) -> DataFrame:
    return readings.select(*[F.col(c).cast(field_type).alias(c) if c in FIELDS else F.col(c)
                             for c in readings.columns])


def pane_aggregate_stream(readings: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                          ts_col: str = "timestamp", field_type: str = "float") -> DataFrame:
    """The pane form of a stream: one stateful aggregation into panes, a second one into windows.

    ``readings`` carry a watermark on ``ts_col``. In a micro-batch a sensor's readings of
    one minute change one pane's state, and a pane, when the watermark has
    closed it, its ``window / slide`` windows once; the direct form copies every reading into those
    windows and changes all their states in every micro-batch.
    Spark chains stateful operators in append mode only, so a window comes once,
    when it is closed. A late reading counts in all its windows, or in none if its pane
    is closed already.
    """
    if _duration_us(window) % _duration_us(slide):
        raise ValueError("window must be a multiple of the slide for the pane form")
    per_pane = _float_fields(readings, field_type).groupBy(F.window(ts_col, slide).alias("pane"), "sensor_id").agg(*_moments())
    windows = F.window(F.window_time("pane"), window, slide)
    return (per_pane.groupBy(windows.alias("w"), "sensor_id").agg(*_combined())
            .select(from_micros(F.unix_micros("w.start")).alias("window_start"),
                    from_micros(F.unix_micros("w.end")).alias("window_end"), *AGG_COLUMNS[2:]))


def _pane_aggregate(readings: DataFrame, window_us: int, slide_us: int, ts_col: str) -> DataFrame:
    if window_us % slide_us:
        raise ValueError("window must be a multiple of the slide for the pane form")
    k = window_us // slide_us
    us = to_micros(F.col(ts_col))
    pane = (us - F.pmod(us, F.lit(slide_us))).alias("pane")
    per_pane = readings.groupBy("sensor_id", pane).agg(*_moments())
    # A pane belongs to the k windows starting at pane, pane - slide, ...
    starts = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                         lambda i: F.col("pane") - i.cast("long") * F.lit(slide_us))
    return (
        per_pane.select("*", F.explode(starts).alias("ws"))
        .groupBy("sensor_id", "ws")
        .agg(*_combined())
        .select(from_micros("ws").alias("window_start"),
                from_micros(F.col("ws") + F.lit(window_us)).alias("window_end"),
                *AGG_COLUMNS[2:])
    )
