"""A1–A10: alerts from failed metrics and notification payloads.

All operators are projections, filters or one small aggregation keyed by the
evaluation ``(sensor_id, seq)``; nothing leaves the executors. Delivery
(HTTP) is not part of the library: payload rows are data, a sink may post them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorqc.functions import texts
from sensorqc.functions.expressions import (
    alert_emoji,
    alert_message,
    alert_severity,
    count_severity,
    fill,
    metric_order,
    metric_title,
    py_fixed,
    severity_color,
    severity_rank,
)
from sensorqc.functions.timeutil import ntz_literal, to_micros
from sensorqc.operators.metrics import metric_structs
from sensorqc.rules import DEFAULT_RULES, QualityRules

NOTIFY_SEVERITIES = ("HIGH", "CRITICAL")

ALERT_COLUMNS = ("seq", "sensor_id", "timestamp", "alert_type", "severity", "severity_rank",
                 "message", "metric_name", "metric_order", "metric_value", "threshold", "resolved")


def failed_metrics(metrics: DataFrame) -> DataFrame:
    """Metric rows with status FAIL."""
    return metrics.where(F.col("status") == "FAIL")


def with_severity(metrics: DataFrame) -> DataFrame:
    """A1: adds ``severity`` (and its rank) of each metric row."""
    return metrics.withColumn("severity", alert_severity()).withColumn("severity_rank", severity_rank())


def with_message(metrics: DataFrame) -> DataFrame:
    """A2: adds the alert ``message`` of each metric row."""
    return metrics.withColumn("message", alert_message())


def build_alerts(metrics: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """A3: one QUALITY_ALERT per failed metric, unresolved.

    ``timestamp`` defaults to the metric timestamp (the evaluation time).
    """
    ts = timestamp if timestamp is not None else F.col("timestamp")
    failed = failed_metrics(metrics)
    return failed.select(
        "seq", "sensor_id", ts.alias("timestamp"),
        F.lit(texts.ALERT_TYPE_QUALITY).alias("alert_type"),
        alert_severity().alias("severity"),
        alert_message().alias("message"),
        "metric_name", "metric_order", "metric_value", "threshold",
        F.lit(False).alias("resolved"),
    ).withColumn("severity_rank", severity_rank()).select(*ALERT_COLUMNS)


def notify_candidates(alerts: DataFrame) -> DataFrame:
    """A4: alerts severe enough to notify (HIGH, CRITICAL)."""
    return alerts.where(F.col("severity").isin(*NOTIFY_SEVERITIES))


def notification_severity(candidates: DataFrame) -> DataFrame:
    """A5: one row per evaluation: number of notified failures and severity."""
    return (
        candidates.groupBy("sensor_id", "seq")
        .agg(F.count(F.lit(1)).cast("long").alias("fail_count"))
        .withColumn("severity", count_severity("fail_count"))
    )


def with_severity_color(df: DataFrame) -> DataFrame:
    """Adds the attachment ``color`` of ``severity``."""
    return df.withColumn("color", severity_color())


def with_alert_emoji(df: DataFrame) -> DataFrame:
    """Adds the ``emoji`` of ``alert_type``."""
    return df.withColumn("emoji", alert_emoji())


def _payload_ts(ts: Column) -> Column:
    """Seconds since the epoch, as ``int(datetime.timestamp())`` of a naive time."""
    return F.floor(to_micros(ts) / F.lit(1_000_000)).cast("long")


def _message_field(name: Column, value: Column, threshold: Column) -> Column:
    """One field of a quality message."""
    return F.struct(
        metric_title(name).alias("title"),
        fill(texts.QUALITY_FIELD_VALUE, v=py_fixed(value, 2), t=py_fixed(threshold, 2), status=F.lit("FAIL"))
        .alias("value"),
        F.lit(True).alias("short"))


def _quality_messages(rows: DataFrame, channel: str) -> DataFrame:
    """A8 columns from rows with sensor_id, seq, timestamp, fail_count and ``_fields`` in metric order."""
    sev = count_severity("fail_count")
    out = rows.select(
        "sensor_id", "seq", "timestamp", "fail_count",
        sev.alias("severity"),
        severity_color(sev).alias("color"),
        fill(texts.QUALITY_TITLE, sensor_id=F.col("sensor_id")).alias("title"),
        fill(texts.QUALITY_TEXT, sensor_id=F.col("sensor_id")).alias("text"),
        F.concat_ws("\n\n", F.transform("_fields", lambda f: F.concat(f["title"], F.lit("\n"), f["value"]))).alias("fields_text"),
        "_fields",
    )
    return out.withColumn("payload", _payload(
        channel, texts.QUALITY_USERNAME, texts.QUALITY_ICON, F.col("timestamp"), text=F.col("text"),
        color=F.col("color"), title=F.col("title"), fields=F.col("_fields"))).drop("_fields")


def _payload(channel: str, username: str, icon: str, ts: Column, text: Column | None = None, **attachment: Column) -> Column:
    """A chat message as JSON: sender, optional text, one attachment with footer and time."""
    inner = F.struct(*[v.alias(k.rstrip("_")) for k, v in attachment.items()],
                     F.lit(texts.FOOTER).alias("footer"), _payload_ts(ts).alias("ts"))
    return F.to_json(F.struct(
        F.lit(channel).alias("channel"), F.lit(username).alias("username"), F.lit(icon).alias("icon_emoji"),
        *([text.alias("text")] if text is not None else []), F.array(inner).alias("attachments")))


def quality_notifications(alerts: DataFrame, channel: str = texts.DEFAULT_CHANNEL) -> DataFrame:
    """One notification per evaluation with HIGH/CRITICAL failures, from alert rows.

    Flat columns (title, text, color, severity, fail_count, fields_text) plus
    the message as JSON (``payload``). Fields keep the metric order. Works on
    the stored ``alerts`` table; where the window statistics are at hand,
    :func:`quality_notifications_of` gives the same without regrouping.
    """
    field = F.struct(metric_order().alias("_order"),
                     _message_field(F.col("metric_name"), F.col("metric_value"), F.col("threshold")).alias("_field"))
    grouped = notify_candidates(alerts).groupBy("sensor_id", "seq").agg(
        F.count(F.lit(1)).cast("long").alias("fail_count"),
        F.max("timestamp").alias("timestamp"),
        F.array_sort(F.collect_list(field)).alias("_sorted"),
    )
    return _quality_messages(grouped.withColumn("_fields", F.transform("_sorted", lambda f: f["_field"])), channel)


def _notified(stats: DataFrame, rules: QualityRules) -> DataFrame:
    """Window rows with ``_failed``: the metric structs that are notified, and their number, no shuffle."""
    metrics = F.array(*metric_structs(rules).values())
    failed = F.filter(metrics, lambda m: m["metric_value"].isNotNull() & (m["status"] == "FAIL")
                      & alert_severity(m["metric_name"], m["metric_value"]).isin(*NOTIFY_SEVERITIES))
    return (stats.select("sensor_id", "seq", "timestamp", failed.alias("_failed"))
            .withColumn("fail_count", F.size("_failed").cast("long")).where("fail_count > 0"))


def notification_severity_of(stats: DataFrame, rules: QualityRules = DEFAULT_RULES) -> DataFrame:
    """A5 from window statistics: the metrics of an evaluation come from one row, so nothing is regrouped."""
    return _notified(stats, rules).select("sensor_id", "seq", "fail_count", count_severity("fail_count").alias("severity"))


def quality_notifications_of(stats: DataFrame, rules: QualityRules = DEFAULT_RULES,
                             channel: str = texts.DEFAULT_CHANNEL) -> DataFrame:
    """A8 from window statistics, without a shuffle of its own."""
    fields = F.transform("_failed", lambda m: _message_field(m["metric_name"], m["metric_value"], m["threshold"]))
    return _quality_messages(_notified(stats, rules).withColumn("_fields", fields), channel)


def system_notifications(events: DataFrame, channel: str = texts.DEFAULT_CHANNEL) -> DataFrame:
    """Payload per system event (``alert_type, message, severity``)."""
    sev = F.coalesce(F.col("severity"), F.lit("MEDIUM"))
    out = events.select(
        *[c for c in ("seq", "timestamp") if c in events.columns],
        "alert_type", "message", sev.alias("severity"),
        severity_color(sev).alias("color"),
        alert_emoji().alias("emoji"),
    ).withColumn("title", fill(texts.SYSTEM_TITLE, emoji=F.col("emoji"), alert_type=F.col("alert_type")))
    ts = F.col("timestamp") if "timestamp" in events.columns else F.lit(None).cast("timestamp_ntz")
    return out.withColumn("payload", _payload(
        channel, texts.SYSTEM_USERNAME, texts.SYSTEM_ICON, ts,
        color=F.col("color"), title=F.col("title"), text_=F.col("message")))


def daily_summary(readings: DataFrame, metrics: DataFrame, day: str, top_k: int = 5,
                  channel: str = texts.DEFAULT_CHANNEL) -> DataFrame:
    """A10: one row for a day: figures, their texts, the top-k list and the message as JSON.

    Totals and top-k come from one aggregate per sensor (partial aggregation
    before the shuffle); both use the same columns of it, so that Spark plans
    the metrics once and reuses the exchange. The top-k list is a
    ``TakeOrderedAndProject`` over one row per sensor. The message is dated by
    the end of the day.
    """
    start = ntz_literal(f"{day} 00:00:00")
    end = F.timestamp_add("DAY", F.lit(1), start)
    in_day = lambda df: df.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    r = in_day(readings).agg(
        F.countDistinct("sensor_id").cast("long").alias("total_sensors"),
        F.count(F.lit(1)).cast("long").alias("total_records"))
    per_sensor = in_day(metrics).groupBy("sensor_id").agg(
        F.count(F.lit(1)).cast("long").alias("checks"),
        F.sum(F.when(F.col("status") == "FAIL", 1).otherwise(0)).alias("fail_count"))
    m = per_sensor.where(F.col("sensor_id").isNotNull() | (F.col("checks") > 0)).agg(
        F.sum("checks").cast("long").alias("quality_checks"),
        F.sum("fail_count").cast("long").alias("failed_checks"))
    top = (per_sensor.where((F.col("fail_count") > 0) & (F.col("checks") > 0))
           .orderBy(F.desc("fail_count"), F.asc("sensor_id")).limit(top_k)
           .agg(F.sort_array(F.collect_list(F.struct(
               (-F.col("fail_count")).alias("_k"), F.col("sensor_id"), F.col("fail_count")))).alias("_top")))
    lines = F.transform("_top", lambda s: fill(texts.SUMMARY_TOP_LINE, sensor_id=s["sensor_id"],
                                               fail_count=s["fail_count"].cast("string")))
    checks, failed = (F.coalesce(c, F.lit(0)).cast("long") for c in ("quality_checks", "failed_checks"))
    flat = (
        r.crossJoin(m).crossJoin(top)  # three one-row aggregates
        .select(
            F.lit(day).cast("date").alias("day"), "total_sensors", "total_records",
            checks.alias("quality_checks"), failed.alias("failed_checks"),
            F.format_number("total_records", 0).alias("total_records_text"),
            F.format_number(checks, 0).alias("quality_checks_text"),
            F.format_number(failed, 0).alias("failed_checks_text"),
            F.concat_ws("\n", lines).alias("top_sensors_text"),
        )
    )
    values = (F.col("total_sensors").cast("string"), F.col("total_records_text"), F.col("quality_checks_text"),
              F.col("failed_checks_text"))
    field = lambda title, value, short: F.struct(
        F.lit(title).alias("title"), value.alias("value"), F.lit(short).alias("short"))
    fields = F.array(*[field(t, v, True) for t, v in zip(texts.SUMMARY_FIELD_TITLES, values)])
    with_top = F.concat(fields, F.array(field(texts.SUMMARY_TOP_TITLE, F.col("top_sensors_text"), False)))
    return flat.withColumn("payload", _payload(
        channel, texts.SUMMARY_USERNAME, texts.SUMMARY_ICON, end, color=F.lit(texts.SUMMARY_COLOR),
        title=F.lit(texts.SUMMARY_TITLE), fields=F.when(F.col("top_sensors_text") != "", with_top).otherwise(fields)))
