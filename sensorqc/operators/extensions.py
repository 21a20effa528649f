"""Features the monitored system describes but does not implement.

Their meaning is ours (see README); they are kept apart from the parity set.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import lower_bound, to_micros
from sensorqc.rules import DEFAULT_RULES, QualityRules

# --- Fixed values -----------------------------------------------------------
DELAY_LIMIT_SECONDS = 10
# Temperature range per season (months), the rest keep the default range.
SEASONAL_TEMPERATURE = (
    ("winter", (12, 1, 2), (-30.0, 10.0)),
    ("spring", (3, 4, 5), (-20.0, 40.0)),
    ("summer", (6, 7, 8), (10.0, 45.0)),
    ("autumn", (9, 10, 11), (-20.0, 40.0)),
)
# ---------------------------------------------------------------------------


def delayed_readings(readings: DataFrame, limit_seconds: float = DELAY_LIMIT_SECONDS,
                     received_col: str = "received_at") -> DataFrame:
    """Readings received more than ``limit_seconds`` after their time."""
    delay_us = to_micros(F.col(received_col)) - to_micros(F.col("timestamp"))
    return (readings.withColumn("delay_seconds", delay_us / F.lit(1_000_000))
            .where(delay_us > F.lit(int(limit_seconds * 1_000_000))))


def offline_sensors(readings: DataFrame, as_of: datetime | None = None, rules: QualityRules = DEFAULT_RULES,
                    known_sensors: DataFrame | None = None) -> DataFrame:
    """Sensors without a reading in the last window before ``as_of``.

    Known sensors default to every sensor that ever reported; a registry
    DataFrame (``sensor_id``) adds sensors that never did (last_seen NULL).
    One aggregate per sensor (partial aggregation before the shuffle).
    """
    cutoff = lower_bound(as_of, minutes=rules.time_window_minutes)
    last = readings.groupBy("sensor_id").agg(F.max("timestamp").alias("last_seen"))
    if known_sensors is not None:
        last = known_sensors.select("sensor_id").distinct().join(last, "sensor_id", "left")
    return last.where(F.col("last_seen").isNull() | (F.col("last_seen") <= cutoff))


def seasonal_rules(spark: SparkSession) -> DataFrame:
    """The small season table (12 rows, one per month)."""
    rows = [(m, name, lo, hi) for name, months, (lo, hi) in SEASONAL_TEMPERATURE for m in months]
    return spark.createDataFrame(rows, "month int, season string, temperature_lo double, temperature_hi double")


def seasonal_validity(readings: DataFrame, rules_table: DataFrame | None = None) -> DataFrame:
    """Temperature validity against the range of the reading's season.

    The rules table has one row per month; Spark broadcasts a table of that
    size by itself. Of several rows for a month the first by season counts.
    """
    table = rules_table if rules_table is not None else seasonal_rules(readings.sparkSession)
    one = table.groupBy("month").agg(F.min(F.struct("season", "temperature_lo", "temperature_hi")).alias("r"))
    return (readings.withColumn("month", F.month("timestamp"))
            .join(one.select("month", "r.*"), "month", "left")
            .withColumn("temperature_in_range",
                        F.when(F.col("temperature").isNull(), F.lit(None))
                        .otherwise(F.col("temperature").between(F.col("temperature_lo"), F.col("temperature_hi"))))
            .drop("month"))


def area_quality(metrics: DataFrame) -> DataFrame:
    """Mean metric value and failure rate per area and metric."""
    return (metrics.groupBy("area", "metric_name")
            .agg(F.avg("metric_value").alias("avg_value"),
                 F.count(F.lit(1)).cast("long").alias("checks"),
                 F.count_if(F.col("status") == "FAIL").cast("long").alias("failed_checks"))
            .withColumn("failure_rate", (F.col("failed_checks") / F.col("checks")) * 100))
