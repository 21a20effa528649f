"""Reading messages from a stream or table into typed readings.

The message text is parsed once with ``from_json`` into string fields (plus
``_corrupt_record``), then every field is ``try_cast``: a broken message is
told apart from a bad number, and ANSI mode never fails the job. Rejected
messages are kept, with a reason, for a reject table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorqc.functions.timeutil import to_micros
from sensorqc.schemas import READING_JSON_SCHEMA

REJECT_MALFORMED = "malformed_json"
REJECT_NO_SENSOR = "missing_sensor_id"
REJECT_BAD_TIMESTAMP = "bad_timestamp"


def read_readings_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                         path: str | None = None, schema=None) -> DataFrame:
    """A streaming source of reading messages as ``(seq, value)``.

    ``fmt='kafka'`` subscribes to a topic (pass ``kafka.bootstrap.servers``,
    ``subscribe``; ``startingOffsets`` defaults to ``latest`` and
    ``maxOffsetsPerTrigger`` to a million, so that a backlog comes in batches
    of bounded size). File formats (``parquet``, ``json``, ...) read message
    files from ``path`` and must carry ``seq`` and ``value`` columns. The
    caller owns the session and the jars.
    """
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("maxOffsetsPerTrigger", "1000000")
        return number_messages(reader.options(**opts).load())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**opts).load(path)
    if "seq" not in df.columns:
        # Generated ids restart with every micro-batch, so they cannot order
        # arrivals across batches; the files must carry the arrival number.
        raise ValueError("file sources need a 'seq' (arrival number) column next to 'value'")
    return df


#: Bits of a partition's number and of an offset in ``seq``.
PARTITION_BITS, OFFSET_BITS = 16, 47


def number_messages(messages: DataFrame) -> DataFrame:
    """Kafka rows as (seq, value, received_at): arrival order is ``received_at``, then ``seq``.

    ``seq`` is partition and offset, so it is unique and in order within a
    partition, for 65,536 partitions of 2^47 messages; beyond, the query fails
    rather than let numbers clash. Over partitions the time orders: the
    broker's append time, which does not fall within a partition. A topic that
    keeps its producers' stamps (``timestampType`` 0) has no such time; there
    it is the time of the micro-batch, which a replayed batch keeps, and
    within a batch partitions come one after the other.
    """
    partition, offset = F.col("partition").cast("long"), F.col("offset").cast("long")
    fits = (partition < F.lit(1 << PARTITION_BITS)) & (offset < F.lit(1 << OFFSET_BITS))
    seq = F.when(fits, F.shiftleft(partition, OFFSET_BITS) + offset).otherwise(
        F.raise_error(F.lit("partition or offset too large for an arrival number")).cast("long"))
    time = F.col("timestamp")
    if "timestampType" in messages.columns:
        time = F.when(F.col("timestampType") == 1, time).otherwise(F.current_timestamp())
    return messages.select(seq.alias("seq"), F.col("value").cast("string").alias("value"),
                           F.timestamp_micros(F.unix_micros(time)).cast("timestamp_ntz").alias("received_at"))


def parse_readings(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> seq, sensor_id, area, us, timestamp, three fields, reason.

    A missing key or a non-numeric value gives NULL for that field only.
    ``reject_reason`` is NULL for good readings, else one of
    ``malformed_json``, ``missing_sensor_id``, ``bad_timestamp``.
    """
    parsed = F.from_json(F.col(value_col), READING_JSON_SCHEMA,
                         {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"})
    keep = [c for c in messages.columns if c not in (value_col,)]
    df = messages.select(*keep, F.col(value_col).alias("_raw"), parsed.alias("_m"))
    ts = F.expr("try_cast(_m.timestamp AS TIMESTAMP_NTZ)")
    malformed = F.col("_raw").isNull() | F.col("_m").isNull() | F.col("_m._corrupt_record").isNotNull()
    sid = F.col("_m.sensor_id")
    reason = (F.when(malformed, F.lit(REJECT_MALFORMED))
              .when(sid.isNull() | (sid == ""), F.lit(REJECT_NO_SENSOR))
              .when(ts.isNull(), F.lit(REJECT_BAD_TIMESTAMP)))
    number = lambda f: F.expr(f"try_cast(_m.{f} AS DOUBLE)")
    return df.select(
        *keep,
        F.when(~malformed, sid).alias("sensor_id"),
        F.when(~malformed, F.col("_m.area")).alias("area"),
        F.when(~malformed, to_micros(ts)).alias("us"),
        F.when(~malformed, ts).alias("timestamp"),
        F.when(~malformed, number("temperature")).alias("temperature"),
        F.when(~malformed, number("humidity")).alias("humidity"),
        F.when(~malformed, number("wind_speed")).alias("wind_speed"),
        reason.alias("reject_reason"),
        F.col("_raw").alias("raw"),
    )


def accept_readings(parsed: DataFrame) -> DataFrame:
    """Readings with a non-empty sensor id and a valid time."""
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason", "raw")


def reject_readings(parsed: DataFrame) -> DataFrame:
    """The complement of :func:`accept_readings`, with raw text and reason."""
    cols = [c for c in ("seq",) if c in parsed.columns]
    return parsed.where(F.col("reject_reason").isNotNull()).select(*cols, "reject_reason", "raw")

