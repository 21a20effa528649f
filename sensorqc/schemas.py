"""Schemas of the reading message and of the three stored tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Reading message as sent by sensors. Numbers are parsed from their raw text
# (try_cast) so that a non-numeric value nulls only its own field.
READING_JSON_SCHEMA = StructType([
    StructField("timestamp", StringType()),
    StructField("sensor_id", StringType()),
    StructField("area", StringType()),
    StructField("temperature", StringType()),
    StructField("humidity", StringType()),
    StructField("wind_speed", StringType()),
    StructField("_corrupt_record", StringType()),
])

SENSOR_DATA_SCHEMA = StructType([
    StructField("timestamp", TimestampNTZType(), False),
    StructField("sensor_id", StringType(), False),
    StructField("temperature", FloatType()),
    StructField("humidity", FloatType()),
    StructField("wind_speed", FloatType()),
    StructField("received_at", TimestampNTZType(), False),
    StructField("dt", DateType(), False),
    StructField("batch_id", StringType(), False),
])

QUALITY_METRICS_SCHEMA = StructType([
    StructField("timestamp", TimestampNTZType(), False),
    StructField("sensor_id", StringType(), False),
    StructField("metric_name", StringType(), False),
    StructField("metric_value", FloatType(), False),
    StructField("threshold", FloatType(), False),
    StructField("status", StringType(), False),
    StructField("window_start", TimestampNTZType(), False),
    StructField("window_end", TimestampNTZType(), False),
    StructField("created_at", TimestampNTZType(), False),
    StructField("dt", DateType(), False),
    StructField("batch_id", StringType(), False),
])

ALERTS_SCHEMA = StructType([
    StructField("seq", LongType()),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("sensor_id", StringType(), False),
    StructField("alert_type", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("message", StringType(), False),
    StructField("metric_name", StringType(), False),
    StructField("metric_value", FloatType(), False),
    StructField("threshold", FloatType(), False),
    StructField("resolved", BooleanType(), False),
    StructField("created_at", TimestampNTZType(), False),
    StructField("dt", DateType(), False),
    StructField("batch_id", StringType(), False),
])

REJECTS_SCHEMA = StructType([
    StructField("seq", LongType()),
    StructField("reject_reason", StringType(), False),
    StructField("raw", StringType()),
    StructField("rejected_at", TimestampNTZType(), False),
    StructField("dt", DateType(), False),
    StructField("batch_id", StringType(), False),
])

TABLE_SCHEMAS = {
    "sensor_data": SENSOR_DATA_SCHEMA,
    "quality_metrics": QUALITY_METRICS_SCHEMA,
    "alerts": ALERTS_SCHEMA,
    "rejects": REJECTS_SCHEMA,
}

#: Partial aggregates of the tables above, see :mod:`sensorqc.operators.rollups`.
ROLLUP_SCHEMAS = {
    "metric_rollups": StructType([
        StructField("hour", TimestampNTZType(), False),
        StructField("sensor_id", StringType(), False),
        StructField("metric_name", StringType(), False),
        StructField("value_count", LongType(), False),
        StructField("value_sum", DoubleType()),
        StructField("value_min", DoubleType()),
        StructField("value_max", DoubleType()),
        StructField("fail_count", LongType(), False),
        StructField("pass_count", LongType(), False),
        StructField("dt", DateType(), False),
        StructField("batch_id", StringType(), False),
    ]),
    "reading_rollups": StructType([
        StructField("hour", TimestampNTZType(), False),
        StructField("readings", LongType(), False),
        StructField("sensors", BinaryType(), False),
        StructField("dt", DateType(), False),
        StructField("batch_id", StringType(), False),
    ]),
}

#: Defaults of stored columns, as SQL: what an INSERT that leaves them out gets.
TABLE_DEFAULTS = {
    "sensor_data": {"received_at": "localtimestamp()"},
    "quality_metrics": {"created_at": "localtimestamp()"},
    "alerts": {"resolved": "false", "created_at": "localtimestamp()"},
    "rejects": {"rejected_at": "localtimestamp()"},
}

#: Partition columns of every table, in order: a day's folder holds its batches.
PARTITIONS = ("dt", "batch_id")

# Physical clustering of each table (sort key inside a file) and retention.
TABLE_CLUSTERING = {
    "sensor_data": ("sensor_id", "timestamp"),
    "quality_metrics": ("sensor_id", "metric_name", "timestamp"),
    "alerts": ("timestamp", "sensor_id", "severity_rank"),
    "rejects": ("reject_reason", "seq"),
    "metric_rollups": ("hour", "sensor_id", "metric_name"),
    "reading_rollups": ("hour",),
}
TABLE_RETENTION_DAYS = {"sensor_data": 30, "quality_metrics": 90, "alerts": 180, "rejects": 30,
                        "metric_rollups": 90, "reading_rollups": 90}
