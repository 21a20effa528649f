"""Message parsing and rejects; stored tables, clustering and retention."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from sensorqc.sinks import tables as S
from sensorqc.sources import fixtures
from sensorqc.sources.readings import accept_readings, parse_readings, reject_readings
from sensorqc.sources.tables import define_tables, read_table

SF = "/root/testdata/sf0.001"


def test_rejects_carry_a_reason_and_bad_numbers_become_null(spark):
    msgs = [
        (1, '{"timestamp": "2024-01-01T00:00:01", "sensor_id": "A", "temperature": "abc", "humidity": 5}'),
        (2, '{"timestamp": "2024-01-01T00:00:01", "sensor_id": "", "temperature": 1}'),
        (3, '{"timestamp": "2024-01-01T00:00:01", "temperature": 1}'),
        (4, '{"timestamp": "2024-01-01T00:00:01", "sensor_id": "A", "tempera'),
        (5, '{"timestamp": "x", "sensor_id": "A"}'),
        (6, '{"timestamp": "2024-01-01T00:00:02.500000", "sensor_id": "CHI-O\'H-063", "wind_speed": 3.5}'),
    ]
    p = parse_readings(spark.createDataFrame(msgs, "seq long, value string"))
    reasons = {r.seq: r.reject_reason for r in p.collect()}
    assert reasons == {1: None, 2: "missing_sensor_id", 3: "missing_sensor_id", 4: "malformed_json",
                       5: "bad_timestamp", 6: None}
    ok = {r.seq: r for r in accept_readings(p).collect()}
    assert ok[1].temperature is None and ok[1].humidity == 5.0
    assert ok[6].sensor_id == "CHI-O'H-063" and ok[6].us % 1_000_000 == 500_000
    rej = reject_readings(p).collect()
    assert {r.seq for r in rej} == {2, 3, 4, 5} and all(r.raw for r in rej)


def test_fixture_json_round_trip(spark):
    r = fixtures.readings(spark, SF)
    parsed = accept_readings(parse_readings(fixtures.readings_json(spark, SF)))
    same = parsed.join(r, ["seq"]).where(
        (parsed.us == r.us) & parsed.temperature.eqNullSafe(r.temperature) & parsed.humidity.eqNullSafe(r.humidity))
    assert same.count() == parsed.count() > 0.98 * r.count()


def test_tables_write_read_and_prune(spark, tmp_dir):
    r = fixtures.readings(spark, SF)
    base = os.path.join(tmp_dir, "t")
    S.append_readings(r, f"{base}/sensor_data")
    from sensorqc.plans.pipeline import quality_alerts, quality_metrics
    S.append_metrics(quality_metrics(r), f"{base}/quality_metrics")
    S.append_alerts(quality_alerts(r), f"{base}/alerts")
    sd = spark.read.parquet(f"{base}/sensor_data")
    assert sd.count() == r.count() and dict(sd.dtypes)["temperature"] == "float"
    assert set(sd.columns) == {"timestamp", "sensor_id", "temperature", "humidity", "wind_speed", "received_at", "dt", "batch_id"}
    # millisecond storage precision
    assert sd.where(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp) % 1000 != 0")) \
        .count() == 0
    got = read_table(spark, f"{base}/quality_metrics", as_of=datetime(2024, 1, 1, 0, 30), hours=1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert got.count() == spark.read.parquet(f"{base}/quality_metrics").count()
    names = define_tables(spark, f"{tmp_dir}/catalog")
    assert [spark.table(n).columns[-2:] for n in names] == [["dt", "batch_id"]] * 4


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def _days(spark, n=3):
    """The fixture's readings spread over n days."""
    r = fixtures.readings(spark, SF)
    us = F.col("us") + F.pmod("seq", F.lit(n)) * F.lit(86_400_000_000)
    return r.withColumn("us", us).withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))


def test_files_are_sorted_by_the_table_key(spark, tmp_dir):
    import pyarrow.parquet as pq
    path = os.path.join(tmp_dir, "t")
    S.append_readings(_days(spark), path, files=4)
    files = _files(path)
    assert 3 <= len(files) <= 4 + 3
    for f in files:
        t = pq.ParquetFile(f).read(columns=["sensor_id", "timestamp"]).to_pylist()
        keys = [(x["sensor_id"], x["timestamp"]) for x in t]
        assert keys == sorted(keys)


def test_batch_and_stream_share_one_layout(spark, tmp_dir):
    """Loads, micro-batches, replays, table definitions, retention and compaction on one path."""
    from sensorqc.sources.tables import recover_partitions
    base = os.path.join(tmp_dir, "all")
    path = f"{base}/sensor_data"
    r = _days(spark)
    S.append_readings(r, path)
    S.append_readings(r, path)  # another load adds rows
    S.append_readings(r, path, batch_id=3)
    S.append_readings(r, path, batch_id=3)  # a replay replaces them
    n = r.count()
    assert spark.read.parquet(path).count() == 3 * n
    spark.sql("CREATE DATABASE IF NOT EXISTS layout")
    names = define_tables(spark, base, "layout")
    recover_partitions(spark, names[:1])
    assert spark.table("layout.sensor_data").count() == 3 * n
    gone = S.expired_partitions(spark, path, days=1, as_of=datetime(2024, 1, 3, 12))
    assert gone == [f"{path}/dt=2024-01-01"] and os.path.isdir(gone[0])
    day = spark.read.parquet(path).where("dt = date'2024-01-02'").drop("batch_id")
    before = sorted(map(str, day.collect()))
    S.compact_day(spark, path, "sensor_data", "2024-01-02")
    after = spark.read.parquet(path).where("dt = date'2024-01-02'").drop("batch_id")
    assert sorted(map(str, after.collect())) == before and len(_files(f"{path}/dt=2024-01-02")) == 1
    spark.sql("DROP DATABASE layout CASCADE")


def test_published_records_reach_files(spark, tmp_dir):
    import json
    from sensorqc.plans.pipeline import quality_metrics
    m = quality_metrics(fixtures.readings(spark, SF))
    S.publish_metrics(m, "parquet", path=f"{tmp_dir}/topic")
    got = spark.read.parquet(f"{tmp_dir}/topic")
    assert got.columns == ["key", "value"] and got.count() == m.count()
    row = got.first()
    assert json.loads(row.value)["sensor_id"] == row.key


def test_retention_keeps_rows_younger_than_the_limit(spark, tmp_dir):
    ev = fixtures.events(spark, SF)
    kept = S.apply_retention(ev, "ts", days=10, as_of=datetime(2024, 1, 25))
    assert kept.where(F.col("ts") <= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).count() == 0
    assert kept.count() == ev.where(F.col("ts") > F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).count()
    path = os.path.join(tmp_dir, "ev")
    ev.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").parquet(path)
    gone = S.expired_partitions(spark, path, days=10, as_of=datetime(2024, 1, 25, 12))
    assert gone and all(p.rsplit("=", 1)[1] < "2024-01-15" for p in gone)
    assert f"{path}/dt=2024-01-14" in gone and f"{path}/dt=2024-01-15" not in gone


def test_metric_record_json(spark):
    import json
    from sensorqc.plans.pipeline import quality_metrics
    rec = S.metric_records(quality_metrics(fixtures.readings(spark, SF))).first()
    d = json.loads(rec.value_json)
    assert set(d) == {"timestamp", "sensor_id", "metric_name", "value", "threshold", "status",
                      "window_start", "window_end"}
    assert datetime.fromisoformat(d["timestamp"]).isoformat() == d["timestamp"]
