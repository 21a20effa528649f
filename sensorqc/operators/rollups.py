"""G2, G11–G14 on hourly partial aggregates instead of all metric rows.

Two rollup tables, written by the fan-out next to the tables they sum up:

* ``metric_rollups`` — per hour, sensor and metric: count, sum, least and
  largest value, failed and passed checks.
* ``reading_rollups`` — per hour: readings, and a HyperLogLog sketch of their sensors.

Every column can be merged (sums, extremes, sketch union), so the partial rows
of any number of micro-batches give what one pass over the hour gives, and
compaction merges them (:func:`merge_metric_rollups`,
:func:`merge_reading_rollups`). A lookback that begins inside an hour takes
that one hour's rest from the detailed table (:func:`covering`), so the reports
equal those of :mod:`sensorqc.operators.reports` for any lookback. A float sum depends
on the order of its summands in its last digits, as anywhere in Spark.

Distinct sensors of a time span come from the sketches: exact while they are
few, then with a relative standard error of about 1.04 / sqrt(2 ** SKETCH_LG_K) (1.6 %).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import from_micros, lower_bound, ntz_literal, to_micros
from sensorqc.operators.reports import AS_OF_DEFAULT, active_alert_count, statistics_row

HOUR = timedelta(hours=1)
HOUR_US = HOUR // timedelta(microseconds=1)
SKETCH_LG_K = 12

Rollup = Callable[[DataFrame], DataFrame]


def _hour(ts_col: str = "timestamp") -> Column:
    us = to_micros(ts_col)
    return from_micros(us - F.pmod(us, F.lit(HOUR_US)))


def _with_day(rollups: DataFrame) -> DataFrame:
    return rollups.withColumn("dt", F.to_date("hour"))


def metric_rollup(metrics: DataFrame) -> DataFrame:
    """One row per hour, sensor and metric of ``metrics`` (null values count as checks only)."""
    value = F.col("metric_value").cast("double")
    return _with_day(metrics.groupBy(_hour().alias("hour"), "sensor_id", "metric_name").agg(
        F.count("metric_value").alias("value_count"), F.sum(value).alias("value_sum"),
        F.min(value).alias("value_min"), F.max(value).alias("value_max"),
        F.count_if(F.col("status") == "FAIL").alias("fail_count"),
        F.count_if(F.col("status") == "PASS").alias("pass_count")))


def _merged_metrics() -> list[Column]:
    return [*[F.sum(c).cast(t).alias(c) for c, t in (("value_count", "long"), ("value_sum", "double"))],
            F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"),
            *[F.sum(c).cast("long").alias(c) for c in ("fail_count", "pass_count")]]


def merge_metric_rollups(rollups: DataFrame) -> DataFrame:
    """Partial rows of the same hour, sensor and metric as one."""
    return _with_day(rollups.groupBy("hour", "sensor_id", "metric_name").agg(*_merged_metrics()))


def reading_rollup(readings: DataFrame) -> DataFrame:
    """One row per hour of ``readings``: their number and a sketch of their sensors."""
    return _with_day(readings.groupBy(_hour().alias("hour")).agg(
        F.count(F.lit(1)).alias("readings"), F.hll_sketch_agg("sensor_id", F.lit(SKETCH_LG_K)).alias("sensors")))


def merge_reading_rollups(rollups: DataFrame) -> DataFrame:
    """Partial rows of the same hour as one."""
    return _with_day(rollups.groupBy("hour").agg(
        F.sum("readings").cast("long").alias("readings"), F.hll_union_agg("sensors").alias("sensors")))


def covering(rollups: DataFrame, detail: DataFrame, rollup: Rollup, as_of: datetime | None, hours: float) -> DataFrame:
    """Rollup rows of exactly the detail rows with ``timestamp >= as_of - hours``.

    Whole hours come from ``rollups``; the rest of the hour in which the bound
    lies is rolled up from ``detail``, which a bound on the hour leaves unread.
    """
    bound = lower_bound(as_of, hours)
    if as_of is None:
        us = to_micros(bound)
        first = from_micros(us + F.pmod(-us, F.lit(HOUR_US)))
    else:
        start = as_of - timedelta(hours=hours)
        whole = start.replace(minute=0, second=0, microsecond=0)
        first = ntz_literal(whole if whole == start else whole + HOUR)
        if whole == start:
            return _since(rollups, first)
    edge = rollup(detail.where((F.col("timestamp") >= bound) & (F.col("timestamp") < first)))
    return _since(rollups, first).unionByName(edge.select(*[c for c in edge.columns if c in rollups.columns]),
                                              allowMissingColumns=True)


def _since(rollups: DataFrame, first: Column) -> DataFrame:
    df = rollups.where(F.col("hour") >= first)
    return df.where(F.col("dt") >= F.to_date(first)) if "dt" in rollups.columns else df


def quality_metrics_summary(rollups: DataFrame, metrics: DataFrame, hours: float = 24,
                            as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """G2 from the metric rollups, all values as doubles; G11 and G12 take the result as they take G2's."""
    return (covering(rollups, metrics, metric_rollup, as_of, hours)
            .groupBy("sensor_id", "metric_name").agg(*_merged_metrics())
            .select("sensor_id", "metric_name", F.try_divide("value_sum", "value_count").alias("avg_value"),
                    F.col("value_min").alias("min_value"), F.col("value_max").alias("max_value"),
                    "fail_count", "pass_count")
            .orderBy("sensor_id", "metric_name"))


def active_sensor_count(rollups: DataFrame, readings: DataFrame, hours: float = 24,
                        as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """G13 from the sketches: about how many sensors sent readings in the lookback.

    Every reading has metrics, so these are the sensors with metrics.
    """
    recent = covering(rollups, readings, reading_rollup, as_of, hours)
    return recent.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sensors")), F.lit(0))
                      .cast("long").alias("active_sensors_count"))


def system_statistics(reading_rollups: DataFrame, metric_rollups: DataFrame, readings: DataFrame, metrics: DataFrame,
                      alerts: DataFrame, as_of: datetime | None = AS_OF_DEFAULT, k: int = 5) -> DataFrame:
    """G14 from both rollups; only the alerts of the lookback, which can change later, are read themselves."""

    def total(hours: float, name: str) -> DataFrame:
        return covering(reading_rollups, readings, reading_rollup, as_of, hours).agg(
            F.coalesce(F.sum("readings"), F.lit(0)).cast("long").alias(name))

    checks = F.col("fail_count") + F.col("pass_count")
    per_sensor = covering(metric_rollups, metrics, metric_rollup, as_of, 24).groupBy("sensor_id").agg(
        F.countDistinct("metric_name").cast("long").alias("n_metrics"),
        F.sum(checks).cast("long").alias("total_checks"), F.sum("fail_count").cast("long").alias("failed_checks"))
    counts = total(24 * 30, "total_data_points").crossJoin(total(1, "recent_data_points"))
    return statistics_row(counts, per_sensor, active_alert_count(alerts, as_of), k)
