"""Registered queries: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame computed
from ``events`` (through the readings projection) at full size. Float
averages, whose summation order differs between engines, are rounded to six
decimals here (never inside the operators).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.operators import alerts as A
from sensorqc.operators import extensions as X
from sensorqc.operators import reports as G
from sensorqc.operators import rollups
from sensorqc.operators.metrics import evaluate_metrics
from sensorqc.operators.windows import trailing_window
from sensorqc.plans.pipeline import quality_metrics, window_stats
from sensorqc.rules import DEFAULT_RULES, QualityRules
from sensorqc.sources import fixtures
from sensorqc.sources.readings import accept_readings, parse_readings, reject_readings

# --- Fixed parameters of the registered queries ----------------------------
AS_OF = datetime(2024, 1, 1, 0, 30)
DAY = "2024-01-01"
SENSOR = "SNS-00012"
# 30 s expected interval: 10 readings per window, so timeliness both passes
# and fails on the fixture (the default 5 s never passes there).
FIXTURE_RULES = QualityRules(expected_interval_seconds=30.0)
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def readings(spark, d):
    return fixtures.readings(spark, d)


def metrics(spark, d, rules: QualityRules = FIXTURE_RULES):
    return quality_metrics(readings(spark, d), rules)


def alerts(spark, d):
    return A.build_alerts(metrics(spark, d))


def summary(spark, d):
    return G.quality_metrics_summary(metrics(spark, d), 24, AS_OF)


def _metric(name: str, rules: QualityRules = FIXTURE_RULES) -> Query:
    return lambda spark, d: evaluate_metrics(trailing_window(readings(spark, d), rules), [name], rules)


def _parsed(spark, d):
    return parse_readings(fixtures.readings_json(spark, d))


def _sliding(panes: bool) -> Query:
    from sensorqc.operators.sliding import sliding_aggregate

    def q(spark, d):
        out = sliding_aggregate(readings(spark, d), panes=panes)
        return _r6(out, "avg_temperature", "avg_humidity", "avg_wind_speed", "temp_stddev")
    return q


def _arrival(spark, d):
    return window_stats(fixtures.readings_late(spark, d), FIXTURE_RULES, form="arrival")


def _arrival_metrics(spark, d):
    return quality_metrics(fixtures.readings_late(spark, d), FIXTURE_RULES, form="arrival")


def stats(spark, d):
    return trailing_window(readings(spark, d), FIXTURE_RULES)


def _arrival_chunks(spark, d):
    """W2 in chunks of ten minutes of arrival time: several at every scale."""
    return window_stats(fixtures.readings_received(spark, d), FIXTURE_RULES, form="arrival", chunk_span_us=600_000_000)


def _buckets(spark, d):
    """W1 in the shortest buckets, five minutes: several at every scale."""
    return trailing_window(readings(spark, d), FIXTURE_RULES, bucket_us=FIXTURE_RULES.window_us)


def _publish_json(spark, d):
    from sensorqc.sinks.tables import metric_records
    return metric_records(metrics(spark, d)).select("sensor_id", "metric_name", "timestamp", "value_json")


def _publish(spark, d):
    from sensorqc.sinks.tables import metric_records
    return metric_records(metrics(spark, d)).drop("value_json")


def _read_table(spark, d):
    from sensorqc.sources.tables import read_table
    return read_table(spark, f"{d}/events.parquet", as_of=datetime(2024, 1, 15), hours=72, ts_col="ts")


def _retention(spark, d):
    from sensorqc.sinks.tables import apply_retention
    return apply_retention(fixtures.events(spark, d), "ts", days=10, as_of=datetime(2024, 1, 25))


def _summary_rollups(spark, d):
    """Fifteen minutes: whole hours from the rollups, the hour cut by the bound from the metrics."""
    m = metrics(spark, d)
    return _r6(rollups.quality_metrics_summary(rollups.metric_rollup(m), m, 0.25, AS_OF), "avg_value")


def _statistics_rollups(spark, d):
    r, m = readings(spark, d), metrics(spark, d)
    return rollups.system_statistics(rollups.reading_rollup(r), rollups.metric_rollup(m), r, m, alerts(spark, d),
                                     AS_OF).drop("top_problematic_sensors")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / projections / predicates
        "read_table": _read_table,
        "apply_retention": _retention,
        "parse_readings": _parsed,
        "accept_readings": lambda s, d: accept_readings(parse_readings(fixtures.readings_json(s, d))),
        "reject_readings": lambda s, d: reject_readings(parse_readings(fixtures.readings_json(s, d))),
        "within_lookback": lambda s, d: G.within_lookback(readings(s, d), AS_OF, minutes=10),
        "sensor_readings": lambda s, d: G.for_sensor(readings(s, d), SENSOR),
        "failed_metrics": lambda s, d: A.failed_metrics(metrics(s, d)),
        "publish_metrics": _publish,
        "publish_metrics_json": _publish_json,
        # windows and metrics
        "trailing_window": lambda s, d: trailing_window(readings(s, d), FIXTURE_RULES),
        "trailing_window_buckets": _buckets,
        "trailing_window_ties": lambda s, d: trailing_window(fixtures.readings_coarse(s, d), FIXTURE_RULES),
        "arrival_window": _arrival,
        "arrival_window_chunks": _arrival_chunks,
        "completeness": _metric("completeness"),
        "temperature_validity": _metric("temperature_validity"),
        "humidity_validity": _metric("humidity_validity"),
        "wind_speed_validity": _metric("wind_speed_validity"),
        "timeliness": _metric("timeliness"),
        "timeliness_5s": _metric("timeliness", DEFAULT_RULES),
        "consistency": _metric("consistency"),
        "quality_metrics": lambda s, d: metrics(s, d),
        "arrival_quality_metrics": _arrival_metrics,
        # alerts and notifications
        "alert_severity": lambda s, d: A.with_severity(A.failed_metrics(metrics(s, d))).select(
            "seq", "sensor_id", "metric_name", "metric_value", "severity", "severity_rank"),
        "alert_messages": lambda s, d: A.with_message(A.failed_metrics(metrics(s, d))).select(
            "seq", "sensor_id", "metric_name", "message"),
        "alerts": alerts,
        "notify_candidates": lambda s, d: A.notify_candidates(alerts(s, d)),
        "notification_severity": lambda s, d: A.notification_severity_of(stats(s, d), FIXTURE_RULES),
        "notification_severity_from_alerts": lambda s, d: A.notification_severity(A.notify_candidates(alerts(s, d))),
        "severity_colors": lambda s, d: A.with_severity_color(
            A.notification_severity_of(stats(s, d), FIXTURE_RULES)),
        "alert_emojis": lambda s, d: A.with_alert_emoji(fixtures.system_events(s, d)).select(
            "seq", "alert_type", "emoji"),
        "quality_notifications": lambda s, d: A.quality_notifications_of(stats(s, d), FIXTURE_RULES).drop("payload"),
        "quality_notifications_from_alerts": lambda s, d: A.quality_notifications(alerts(s, d)).drop("payload"),
        "quality_notification_payloads": lambda s, d: A.quality_notifications_of(stats(s, d), FIXTURE_RULES).select(
            "sensor_id", "seq", "payload"),
        "system_notification_payloads": lambda s, d: A.system_notifications(fixtures.system_events(s, d)).select(
            "seq", "payload"),
        "daily_summary_payload": lambda s, d: A.daily_summary(readings(s, d), metrics(s, d), DAY).select("day", "payload"),
        "system_notifications": lambda s, d: A.system_notifications(fixtures.system_events(s, d)).drop("payload"),
        "daily_summary": lambda s, d: A.daily_summary(readings(s, d), metrics(s, d), DAY).drop("payload"),
        # reports
        "sensor_data_count": lambda s, d: G.sensor_data_count(readings(s, d), None, 24, AS_OF),
        "sensor_data_count_sensor": lambda s, d: G.sensor_data_count(readings(s, d), SENSOR, 24, AS_OF),
        "sensor_data_count_10m": lambda s, d: G.sensor_data_count(readings(s, d), None, None, AS_OF, minutes=10),
        "quality_metrics_summary": lambda s, d: _r6(summary(s, d), "avg_value"),
        "active_alerts": lambda s, d: G.active_alerts(alerts(s, d), 24, AS_OF),
        "average_temperature_series": lambda s, d: _r6(
            G.average_temperature_series(readings(s, d), 1, AS_OF), "avg_temp"),
        "completeness_score": lambda s, d: _r6(G.completeness_score(metrics(s, d), 1, AS_OF), "quality_score"),
        "completeness_band": lambda s, d: _r6(
            G.with_score_band(G.completeness_score(metrics(s, d), 1, AS_OF)), "quality_score"),
        "status_distribution": lambda s, d: G.status_distribution(metrics(s, d), 1, AS_OF),
        "recent_alerts": lambda s, d: G.recent_alerts(alerts(s, d), 1, 10, AS_OF),
        "severity_counts": lambda s, d: G.severity_counts(alerts(s, d), 24, AS_OF),
        "recent_critical_alerts": lambda s, d: G.recent_critical_alerts(alerts(s, d), 5, 24, AS_OF),
        "sensor_failure_rates": lambda s, d: G.sensor_failure_rates(summary(s, d)),
        "top_problem_sensors": lambda s, d: G.top_problem_sensors(G.sensor_failure_rates(summary(s, d)), 5),
        "active_sensor_count": lambda s, d: G.active_sensor_count(summary(s, d)),
        "system_statistics": lambda s, d: G.system_statistics(
            readings(s, d), metrics(s, d), alerts(s, d), AS_OF).drop("top_problematic_sensors"),
        "system_statistics_top": lambda s, d: G.system_statistics(
            readings(s, d), metrics(s, d), alerts(s, d), AS_OF).selectExpr("inline(top_problematic_sensors)"),
        "quality_metrics_summary_rollups": _summary_rollups,
        "system_statistics_rollups": _statistics_rollups,
        "summary_head": lambda s, d: _r6(G.summary_head(summary(s, d), 10), "avg_value"),
        "monitor_health": lambda s, d: G.monitor_health(readings(s, d), AS_OF).select(
            "recent_data_count", "active_sensors", "processed_count", "status"),
        "monitor_health_stopped": lambda s, d: G.monitor_health(readings(s, d), AS_OF, running=False),
        # described-only features (our semantics)
        "delayed_readings": lambda s, d: X.delayed_readings(fixtures.readings_received(s, d)),
        "offline_sensors": lambda s, d: X.offline_sensors(readings(s, d), AS_OF,
                                                          known_sensors=fixtures.sensor_registry(s, d)),
        "seasonal_validity": lambda s, d: X.seasonal_validity(readings(s, d)),
        "area_quality": lambda s, d: _r6(X.area_quality(metrics(s, d)), "avg_value"),
        # sliding aggregate (batch form of the streaming query)
        "sliding_aggregate": _sliding(False),
        "sliding_aggregate_panes": _sliding(True),
    }
    return q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main path: readings -> trailing window -> all metrics."""
    return metrics(spark, sf_dir)
