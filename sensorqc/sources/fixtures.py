"""Sensor readings derived from the driver's ``events`` table.

Thirty days of events are squeezed 1,440 times into thirty minutes, so a
five-minute window holds about eleven readings at every scale factor. Every
step is a projection of one scan: no shuffle, filters and column pruning reach
the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import from_micros, iso_format

# --- Fixed values -----------------------------------------------------------
SQUEEZE = 1440
BASE_US = 1_704_067_200_000_000  # 2024-01-01 00:00:00
AREAS = ("Downtown", "North Side", "South Side", "West Side", "O'Hare")
# Reject injection in readings_json: blank id, cut text, bad timestamp.
BLANK_ID_EVERY, CUT_JSON_EVERY, BAD_TS_EVERY = 501, 503, 509
# Late rows in readings_late: every 33rd event, 10..60 s late.
LATE_EVERY, LATE_BASE_S, LATE_SPREAD = 33, 10, 51
# ---------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _area(user_id: Column) -> Column:
    expr = None
    for i, name in enumerate(AREAS):
        expr = (F.when if expr is None else expr.when)(F.pmod(user_id, F.lit(len(AREAS))) == i, F.lit(name))
    return expr


def readings_from_events(ev: DataFrame, late: bool = False, received: bool = False) -> DataFrame:
    """Project ``events`` to readings: seq, sensor_id, area, us, timestamp, 3 fields.

    ``late`` stamps every 33rd reading 10–60 s early (it arrives late);
    ``received`` adds ``received_at``, the on-time instant of each reading.
    """
    eid, err = F.col("event_id"), F.col("event_type") == "error"
    squeezed = F.lit(BASE_US) + F.expr(f"(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) - {BASE_US}) div {SQUEEZE}")
    on_time = squeezed
    if late:
        shift = (F.lit(LATE_BASE_S) + F.pmod(eid, F.lit(LATE_SPREAD))) * F.lit(1_000_000)
        squeezed = F.when(F.pmod(eid, F.lit(LATE_EVERY)) == 0, squeezed - shift).otherwise(squeezed)
    k = F.regexp_extract(F.col("props"), r"(\d+)", 1).cast("double")
    return ev.select(
        eid.alias("seq"),
        F.concat(F.lit("SNS-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("sensor_id"),
        _area(F.col("user_id")).alias("area"),
        squeezed.alias("us"),
        F.when(err | (F.pmod(eid, F.lit(20)) == 0), F.lit(None))
         .otherwise(F.col("value") * F.lit(0.4) - F.lit(10.0)).cast("double").alias("temperature"),
        F.when(err | (F.pmod(eid, F.lit(17)) == 0), F.lit(None))
         .otherwise(k * F.lit(1.05)).cast("double").alias("humidity"),
        F.when(err | (F.pmod(eid, F.lit(13)) == 0), F.lit(None))
         .otherwise(F.col("value") / F.lit(5.0)).cast("double").alias("wind_speed"),
        *([from_micros(on_time).alias("received_at")] if received else []),
    ).withColumn("timestamp", from_micros("us")).select(
        "seq", "sensor_id", "area", "us", "timestamp", "temperature", "humidity", "wind_speed",
        *(["received_at"] if received else []))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(events(spark, sf_dir))


def readings_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(events(spark, sf_dir), late=True)


def readings_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """readings_late with the time each reading was received (on time)."""
    return readings_from_events(events(spark, sf_dir), late=True, received=True)


def readings_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """readings of a clock that shows full minutes: many equal times per sensor."""
    us = F.col("us") - F.pmod("us", F.lit(60_000_000))
    return readings(spark, sf_dir).withColumn("us", us).withColumn("timestamp", from_micros("us"))


def sensor_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sensor ids, one per customer key (most never report a reading)."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(F.concat(F.lit("SNS-"), F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("sensor_id"))


def readings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as JSON messages (seq, value) with injected bad messages."""
    r = readings(spark, sf_dir)
    eid = F.col("seq")
    sid = F.when(F.pmod(eid, F.lit(BLANK_ID_EVERY)) == 0, F.lit("")).otherwise(F.col("sensor_id"))
    ts = F.when(F.pmod(eid, F.lit(BAD_TS_EVERY)) == 0, F.lit("x")).otherwise(iso_format("timestamp"))
    text = F.to_json(F.struct(
        ts.alias("timestamp"), sid.alias("sensor_id"), F.col("area"),
        F.col("temperature"), F.col("humidity"), F.col("wind_speed")), {"ignoreNullFields": "false"})
    cut = F.substring(text, 1, 40)
    return r.select("seq", F.when(F.pmod(eid, F.lit(CUT_JSON_EVERY)) == 0, cut).otherwise(text).alias("value"))


def system_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System events for A9: one per event, type and severity from the event."""
    ev = events(spark, sf_dir)
    et = F.col("event_type")
    alert_type = (F.when(et == "error", F.lit("SYSTEM_ERROR"))
                  .when(et == "signup", F.lit("SENSOR_OFFLINE"))
                  .when(et == "click", F.lit("DATA_DELAY"))
                  .when(et == "purchase", F.lit("THRESHOLD_BREACH"))
                  .otherwise(F.lit("SYSTEM_START")))
    severity = (F.when(F.col("value") >= 75, F.lit("CRITICAL"))
                .when(F.col("value") >= 50, F.lit("HIGH"))
                .when(F.col("value") >= 25, F.lit("MEDIUM"))
                .when(F.col("value") >= 10, F.lit("LOW"))
                .otherwise(F.lit("UNKNOWN")))
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("timestamp"),
        alert_type.alias("alert_type"),
        F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(": "), et).alias("message"),
        severity.alias("severity"),
    )

