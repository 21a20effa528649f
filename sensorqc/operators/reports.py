"""Report and dashboard queries over readings, metrics and alerts.

Every report takes an ``as_of`` time (``None`` = now) and a lookback, and
filters ``timestamp >= as_of - lookback`` (lower bound only, as the dashboards
do). Aggregations are hash aggregates with map-side partial aggregation; top-k
lists are ``orderBy().limit()`` (``TakeOrderedAndProject``: a per-partition
top-k, never a full sort). Ties are broken by stable keys so results are
deterministic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorqc.functions.expressions import metric_order, score_band, severity_rank
from sensorqc.functions.timeutil import iso_format, lower_bound

AS_OF_DEFAULT = None  # now


def within_lookback(df: DataFrame, as_of: datetime | None = AS_OF_DEFAULT, hours: float | None = None,
                    minutes: float | None = None, ts_col: str = "timestamp") -> DataFrame:
    """``ts >= as_of - lookback`` (inclusive, no upper bound)."""
    if hours is None and minutes is None:
        raise ValueError("a lookback needs hours or minutes")
    return df.where(F.col(ts_col) >= lower_bound(as_of, hours, minutes))


def for_sensor(df: DataFrame, sensor_id: str | None) -> DataFrame:
    """P5: optional sensor equality; the id is a literal, never SQL text.

    An empty id means no filter, like a missing one.
    """
    return df if not sensor_id else df.where(F.col("sensor_id") == F.lit(sensor_id))


def sensor_data_count(readings: DataFrame, sensor_id: str | None = None, hours: float = 24,
                      as_of: datetime | None = AS_OF_DEFAULT, minutes: float | None = None) -> DataFrame:
    """G1: number of readings in the lookback (optionally of one sensor)."""
    df = for_sensor(within_lookback(readings, as_of, hours, minutes), sensor_id)
    return df.agg(F.count(F.lit(1)).cast("long").alias("count"))


def quality_metrics_summary(metrics: DataFrame, hours: float = 24,
                            as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Per (sensor, metric): avg, min, max, fail and pass counts."""
    return (
        within_lookback(metrics, as_of, hours)
        .groupBy("sensor_id", "metric_name")
        .agg(
            F.avg("metric_value").alias("avg_value"),
            F.min("metric_value").alias("min_value"),
            F.max("metric_value").alias("max_value"),
            F.count_if(F.col("status") == "FAIL").cast("long").alias("fail_count"),
            F.count_if(F.col("status") == "PASS").cast("long").alias("pass_count"),
        )
        .orderBy("sensor_id", "metric_name")
    )


def _active(alerts: DataFrame, hours: float, as_of: datetime | None) -> DataFrame:
    """Unresolved alerts of the lookback; G3's own rows (no ``resolved``) are unresolved already."""
    recent = within_lookback(alerts, as_of, hours)
    return recent.where(~F.col("resolved")) if "resolved" in alerts.columns else recent


def _newest_first() -> list[Column]:
    """Alert order from stored columns alone: time, sensor, place of the metric."""
    return [F.desc("timestamp"), F.asc("sensor_id"), metric_order().asc()]


def active_alerts(alerts: DataFrame, hours: float = 24, as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Unresolved alerts in the lookback, newest first (P8 columns)."""
    return (
        _active(alerts, hours, as_of)
        .orderBy(*_newest_first())
        .select("timestamp", "sensor_id", "alert_type", "severity", "message",
                "metric_name", "metric_value", "threshold")
    )


def average_temperature_series(readings: DataFrame, hours: float = 1,
                               as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Mean temperature per exact timestamp, ascending."""
    return (
        within_lookback(readings, as_of, hours)
        .groupBy("timestamp").agg(F.avg("temperature").alias("avg_temp"))
        .orderBy("timestamp")
    )


def completeness_score(metrics: DataFrame, hours: float = 1,
                       as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Mean completeness over the lookback (one row; NULL when empty)."""
    return (
        within_lookback(metrics, as_of, hours)
        .where(F.col("metric_name") == "completeness")
        .agg(F.avg("metric_value").alias("quality_score"))
    )


def with_score_band(df: DataFrame, value_col: str = "quality_score") -> DataFrame:
    """Adds the dashboard colour band of a score."""
    return df.withColumn("band", score_band(value_col))


def status_distribution(metrics: DataFrame, hours: float = 1,
                        as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Metric rows per status."""
    return (within_lookback(metrics, as_of, hours)
            .groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("count")))


def recent_alerts(alerts: DataFrame, hours: float = 1, k: int = 10,
                  as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """The k newest unresolved alerts (dashboard table)."""
    return (
        _active(alerts, hours, as_of)
        .orderBy(*_newest_first())
        .limit(k)
        .select("sensor_id", "alert_type", "severity", "message", "timestamp")
    )


def severity_counts(alerts: DataFrame, hours: float = 24, as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Active alerts per severity, with the severity rank for ordering.

    Takes the stored alerts or the rows of :func:`active_alerts`.
    """
    return (_active(alerts, hours, as_of).groupBy("severity")
            .agg(F.count(F.lit(1)).cast("long").alias("count"))
            .select("severity", severity_rank().alias("severity_rank"), "count"))


def recent_critical_alerts(alerts: DataFrame, k: int = 5, hours: float = 24,
                           as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """The k newest active CRITICAL alerts, of stored alerts or of G3's rows."""
    return (
        _active(alerts, hours, as_of).where(F.col("severity") == "CRITICAL")
        .orderBy(*_newest_first())
        .limit(k)
        .select("timestamp", "sensor_id", "message")
    )


def sensor_failure_rates(summary: DataFrame) -> DataFrame:
    """Per sensor: checks, failed checks, failure rate in percent.

    Sensors without a check are left out. Runs on the G2 summary (one row per
    sensor and metric), so its shuffle is tiny.
    """
    return (
        summary.groupBy("sensor_id")
        .agg((F.sum("pass_count") + F.sum("fail_count")).cast("long").alias("total_checks"),
             F.sum("fail_count").cast("long").alias("failed_checks"))
        .where(F.col("total_checks") > 0)
        .withColumn("failure_rate", (F.col("failed_checks") / F.col("total_checks")) * 100)
    )


def top_problem_sensors(rates: DataFrame, k: int = 5) -> DataFrame:
    """The k highest failure rates; ties by sensor id."""
    return rates.orderBy(F.desc("failure_rate"), F.asc("sensor_id")).limit(k)


def active_sensor_count(summary: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct sensors with metrics (optionally HyperLogLog++)."""
    agg = F.approx_count_distinct("sensor_id") if approximate else F.countDistinct("sensor_id")
    return summary.agg(agg.cast("long").alias("active_sensors_count"))


def system_statistics(readings: DataFrame, metrics: DataFrame, alerts: DataFrame,
                      as_of: datetime | None = AS_OF_DEFAULT, k: int = 5) -> DataFrame:
    """One row of system figures plus the top problem sensors.

    Each figure is a one-row aggregate; the cross joins only combine those
    single rows (never a data-sized side).
    """
    counts = within_lookback(readings, as_of, 24 * 30).agg(
        F.count(F.lit(1)).cast("long").alias("total_data_points"),
        F.count_if(F.col("timestamp") >= lower_bound(as_of, 1)).cast("long").alias("recent_data_points"))
    # One aggregate per sensor. Both uses keep all its columns, so that their
    # plans are equal and Spark runs the metrics (and their windows) once.
    per_sensor = within_lookback(metrics, as_of, 24).groupBy("sensor_id").agg(
        F.countDistinct("metric_name").cast("long").alias("n_metrics"),
        F.count_if(F.col("status").isin("PASS", "FAIL")).cast("long").alias("total_checks"),
        F.count_if(F.col("status") == "FAIL").cast("long").alias("failed_checks"))
    return statistics_row(counts, per_sensor, active_alert_count(alerts, as_of), k)


def active_alert_count(alerts: DataFrame, as_of: datetime | None = AS_OF_DEFAULT) -> DataFrame:
    """Active alerts of the last day (one row)."""
    return _active(alerts, 24, as_of).agg(F.count(F.lit(1)).cast("long").alias("active_alerts_count"))


def statistics_row(counts: DataFrame, per_sensor: DataFrame, active: DataFrame, k: int) -> DataFrame:
    """G14's row from its parts: one row of counts, checks per sensor, one row of active alerts."""
    used = per_sensor.where((F.col("n_metrics") >= 0) & (F.col("total_checks") >= F.col("failed_checks")))
    groups = used.agg(F.coalesce(F.sum("n_metrics"), F.lit(0)).cast("long").alias("quality_metrics_count"),
                      F.count("sensor_id").cast("long").alias("active_sensors_count"))
    rates = (used.where(F.col("total_checks") > 0)
             .withColumn("failure_rate", (F.col("failed_checks") / F.col("total_checks")) * 100))
    top = (top_problem_sensors(rates, k)
           .agg(F.sort_array(F.collect_list(F.struct(
               (-F.col("failure_rate")).alias("_k"), F.col("sensor_id"), F.col("failure_rate"),
               F.col("total_checks"), F.col("failed_checks")))).alias("_top")))
    return counts.crossJoin(groups).crossJoin(active).crossJoin(top).select(
        "total_data_points", "recent_data_points", "quality_metrics_count",
        "active_alerts_count", "active_sensors_count",
        F.transform("_top", lambda s: s.dropFields("_k")).alias("top_problematic_sensors"),
        F.concat_ws(",", F.transform("_top", lambda s: s["sensor_id"])).alias("top_sensor_ids"),
    )


def summary_head(summary: DataFrame, k: int = 10) -> DataFrame:
    """The first k summary rows by (sensor, metric)."""
    return summary.orderBy("sensor_id", "metric_name").limit(k)


def monitor_health(readings: DataFrame, as_of: datetime | None = AS_OF_DEFAULT,
                   processed: Column | None = None, running: bool = True, error: str | None = None,
                   progress: DataFrame | None = None) -> DataFrame:
    """Status, time, readings processed, sensors seen, recent readings, processor state.

    ``running`` is the stream's state (``query.isActive``) and ``error`` its
    failure, if any: 'healthy' while it runs, 'stopped' after, 'unhealthy' with
    an error. ``processed`` may carry a count taken from the stream's tables
    or progress; by default it is the number of readings. With ``progress``
    (one row, :func:`sensorqc.streaming.progress.processed_count`) nothing but
    the last hour of readings is scanned: active sensors are then those of that hour.
    """
    recent = within_lookback(readings, as_of, 1)
    if progress is not None:
        out = recent.agg(F.count(F.lit(1)).cast("long").alias("recent_data_count"),
                         F.countDistinct("sensor_id").cast("long").alias("active_sensors")).crossJoin(progress)
        return _health(out, as_of, running, error)
    recent = recent.agg(F.count(F.lit(1)).cast("long").alias("recent_data_count"))
    seen = readings.agg(F.countDistinct("sensor_id").cast("long").alias("active_sensors"),
                        F.count(F.lit(1)).cast("long").alias("processed_count"))
    out = recent.crossJoin(seen)
    if processed is not None:
        out = out.withColumn("processed_count", processed.cast("long"))
    return _health(out, as_of, running, error)


def _health(figures: DataFrame, as_of: datetime | None, running: bool, error: str | None) -> DataFrame:
    status = "unhealthy" if error is not None else "healthy" if running else "stopped"
    at = lower_bound(as_of, 0)
    return figures.select("*", F.lit(status).alias("status"), iso_format(at).alias("timestamp"),
                      F.lit(running and error is None).alias("processor_running"),
                      F.lit(error).cast("string").alias("error"))
