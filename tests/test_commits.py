"""Stored tables under restarts, replays, crashes, compaction and retention."""

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorqc.operators import reports
from sensorqc.operators.windows import trailing_window
from sensorqc.sinks import tables as S
from sensorqc.sinks.commits import CommitLog
from sensorqc.sources import fixtures
from sensorqc.sources.readings import accept_readings, parse_readings, read_readings_stream
from sensorqc.sources.tables import define_tables, read_table, recover_partitions
from sensorqc.streaming.fanout import FanOut, start_pipeline
from sensorqc.streaming.progress import processed_count
from tests.test_sources_sinks import SF, _days, _files
from tests.test_streaming import _write_parts

TABLES = ("sensor_data", "quality_metrics", "alerts", "notifications")


def new_folder():
    return tempfile.mkdtemp(prefix="sensorqc-commits-")


def rows(df):
    return sorted(map(str, df.drop("batch_id").collect()))


def with_fields(spark, r):
    return trailing_window(r).join(r.select("seq", "temperature", "humidity", "wind_speed"), "seq")


def test_two_checkpoints_on_one_base_path_keep_both_runs(spark):
    """Both count their batches from 0; the second must not take the first one's rows away."""
    src, base = new_folder(), new_folder()
    msgs = fixtures.readings_json(spark, SF)
    _write_parts(msgs, src, [(0, 500), (500, 10**9)])
    good = accept_readings(parse_readings(msgs)).count()
    for k in (1, 2):
        stream = read_readings_stream(spark, "parquet", path=src, schema=msgs.schema, options={"maxFilesPerTrigger": 1})
        for q in start_pipeline(stream, base, new_folder(), trigger={"availableNow": True}, state_buckets=2):
            q.awaitTermination()
        assert read_table(spark, f"{base}/sensor_data").count() == k * good
        assert spark.read.parquet(f"{base}/sensor_data").count() == k * good
        assert processed_count(spark, base).first()[0] == k * good


def test_replays_within_each_run(spark):
    base = new_folder()
    r = fixtures.readings(spark, SF)
    stats = with_fields(spark, r)
    for run in ("a", "b"):
        fan = FanOut(base, evaluated_at_reading_time=True, run=run, publish_fmt="parquet", publish_path=f"{base}/topic")
        fan(stats.where("seq % 2 = 0"), 0)
        fan(stats.where("seq % 2 = 1"), 1)
    want = {t: rows(read_table(spark, f"{base}/{t}").drop("received_at", "created_at")) for t in TABLES}
    published = spark.read.parquet(f"{base}/topic").count()
    assert len(want["sensor_data"]) == 2 * r.count() == processed_count(spark, base).first()[0]
    for run, n in (("a", 1), ("b", 0), ("b", 1), ("b", 1)):
        FanOut(base, evaluated_at_reading_time=True, run=run, publish_fmt="parquet", publish_path=f"{base}/topic")(
            stats.where(f"seq % 2 = {n}"), n)
    assert {t: rows(read_table(spark, f"{base}/{t}").drop("received_at", "created_at")) for t in TABLES} == want
    assert spark.read.parquet(f"{base}/topic").count() == published
    assert processed_count(spark, base).first()[0] == 2 * r.count()


STEPS = ("move_in", "commit", "clean_up", "finished", "drop_days")


class Died(Exception):
    pass


def dying(monkeypatch, step, when):
    real = getattr(CommitLog, step)

    def die(self, *a, **kw):
        if when == "after":
            real(self, *a, **kw)
        raise Died

    monkeypatch.setattr(CommitLog, step, die)


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", STEPS[:3])
def test_a_compaction_that_dies_shows_every_row_once(spark, monkeypatch, step, when):
    path = f"{new_folder()}/sensor_data"
    for k in range(3):
        S.append_readings(_days(spark).where(f"pmod(seq, 9) div 3 = {k}"), path)
    want = rows(read_table(spark, path))
    with monkeypatch.context() as m:
        dying(m, step, when)
        with pytest.raises(Died):
            S.compact_day(spark, path, "sensor_data", "2024-01-02")
        assert rows(read_table(spark, path)) == want
    S.compact_day(spark, path, "sensor_data", "2024-01-02")
    assert rows(read_table(spark, path)) == want == rows(read_table(spark, path, datetime(2024, 1, 4), hours=96))
    log = CommitLog(spark, path)
    assert len([d for d, _ in log.live() if d == "2024-01-02"]) == 1
    assert not [m for m in log.markers() if m.endswith("+")]


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", STEPS[:4])
def test_a_replay_after_any_crash(spark, monkeypatch, step, when):
    path = f"{new_folder()}/sensor_data"
    r = _days(spark)
    S.append_readings(r.where("seq % 2 = 0"), path, batch_id=0, run="r")
    for attempt in range(2):  # batch 1 dies in its first writing, and again in its replay
        with monkeypatch.context() as m:
            dying(m, step, when)
            try:
                S.append_readings(r.where("seq % 2 = 1"), path, batch_id=1, run="r")
            except Died:
                pass
        n = read_table(spark, path).count()
        assert n in (r.where("seq % 2 = 0").count(), r.count())
    S.append_readings(r.where("seq % 2 = 1"), path, batch_id=1, run="r")
    assert read_table(spark, path).count() == r.count() == spark.read.parquet(path).count()


def test_count_outlives_compaction_and_health_reads_it(spark):
    base = new_folder()
    r = fixtures.readings(spark, SF)
    fan = FanOut(base, evaluated_at_reading_time=True, run="r", rows_per_file=10**6)
    for n in range(4):
        fan(with_fields(spark, r.where(f"seq % 4 = {n}")), n)
    assert len(os.listdir(f"{base}/progress/run=r")) <= 2 * 2  # two records and their checksums
    before = processed_count(spark, base).first()[0]
    for day in CommitLog(spark, f"{base}/sensor_data").days():
        S.compact_day(spark, f"{base}/sensor_data", "sensor_data", day)
    assert processed_count(spark, base).first()[0] == before == r.count()
    as_of = r.agg(F.max("timestamp")).first()[0]
    stored = read_table(spark, f"{base}/sensor_data", as_of, hours=1)
    got = reports.monitor_health(stored, as_of, progress=processed_count(spark, base))
    want = reports.within_lookback(r, as_of, 1).agg(F.count("*"), F.countDistinct("sensor_id")).first()
    h = got.first()
    assert (h.recent_data_count, h.active_sensors, h.processed_count, h.status) == (*want, r.count(), "healthy")
    assert got.columns[:3] == ["recent_data_count", "active_sensors", "processed_count"]
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in scan


def test_files_follow_from_rows_and_bytes(spark):
    """A large micro-batch and a large day are written by several tasks."""
    base = new_folder()
    r = spark.range(1_000_000).selectExpr(
        "id as seq", "concat('s', id % 50) as sensor_id", "1704067200000000 + id * 1000 as us", "20.0 as temperature",
        "50.0 as humidity", "3.0 as wind_speed").withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))
    path = f"{base}/sensor_data"
    fan = FanOut(base)
    S.append_readings(r, path, files=fan._files(1_000_000))
    assert fan._files(1_000_000) == 4 and fan._files(6_000_000) == 24 and len(_files(path)) == 4
    S.compact_day(spark, path, "sensor_data", "2024-01-01", file_bytes=1 << 20)
    assert len(_files(path)) > 2 and read_table(spark, path).count() == 1_000_000
    S.compact_day(spark, path, "sensor_data", "2024-01-01")
    assert len(_files(path)) == 1 and read_table(spark, path).count() == 1_000_000


def test_expired_days_leave_folders_and_catalog(spark, monkeypatch):
    base = new_folder()
    path = f"{base}/sensor_data"
    S.append_readings(_days(spark), path)
    S.append_readings(_days(spark), path, batch_id=0, run="r")
    spark.sql("CREATE DATABASE IF NOT EXISTS expiry")
    name = define_tables(spark, base, "expiry")[0]
    recover_partitions(spark, [name])
    days = lambda df: sorted({str(x[0]) for x in df.select("dt").distinct().collect()})
    assert days(spark.table(name)) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    with monkeypatch.context() as m:
        dying(m, "clean_up", "before")
        with pytest.raises(Died):
            S.drop_expired(spark, path, days=1, as_of=datetime(2024, 1, 3, 12), name=name)
    assert days(read_table(spark, path)) == ["2024-01-02", "2024-01-03"]  # gone for readers, though still on disk
    assert os.path.isdir(f"{path}/dt=2024-01-01")
    assert S.drop_expired(spark, path, days=1, as_of=datetime(2024, 1, 3, 12), name=name) == ["2024-01-01"]
    assert days(read_table(spark, path)) == days(spark.table(name)) == days(spark.read.parquet(path)) == ["2024-01-02", "2024-01-03"]
    assert not os.path.exists(f"{path}/dt=2024-01-01")
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect() if "2024-01-01" in r[0]] == []
    assert S.drop_expired(spark, path, days=1, as_of=datetime(2024, 1, 3, 12), name=name) == []
    spark.sql("DROP DATABASE expiry CASCADE")


def test_defaults_of_left_out_columns(spark):
    base = new_folder()
    spark.sql("CREATE DATABASE IF NOT EXISTS defaults")
    names = define_tables(spark, base, "defaults")
    spark.sql(f"INSERT INTO {names[0]} (timestamp, sensor_id, temperature, humidity, wind_speed, dt, batch_id) VALUES "
              "(TIMESTAMP_NTZ'2024-01-01 00:00:00', 'TEST-001', 25.5F, 65.0F, 8.2F, DATE'2024-01-01', 'by-hand')")
    spark.sql(f"INSERT INTO {names[2]} (seq, timestamp, sensor_id, alert_type, severity, message, metric_name, metric_value, "
              "threshold, dt, batch_id) VALUES (1, TIMESTAMP_NTZ'2024-01-01 00:00:00', 'TEST-001', 'QUALITY_ALERT', 'LOW', "
              "'m', 'completeness', 1.0F, 2.0F, DATE'2024-01-01', 'by-hand')")
    got = spark.table(names[0]).first()
    assert got.received_at is not None and (got.sensor_id, got.temperature) == ("TEST-001", 25.5)
    alert = spark.table(names[2]).first()
    assert alert.resolved is False and alert.created_at is not None
    # rows inserted by hand count beside committed batches, and are compacted with them
    path = f"{base}/sensor_data"
    S.append_readings(_days(spark), path)
    n = _days(spark).count() + 1
    assert read_table(spark, path).count() == n
    S.compact_day(spark, path, "sensor_data", "2024-01-01")
    recover_partitions(spark, names[:1])
    assert read_table(spark, path).count() == n == spark.table(names[0]).count()
    spark.sql("DROP DATABASE defaults CASCADE")


def test_table_without_a_committed_batch(spark):
    path = f"{new_folder()}/sensor_data"
    S.append_readings(_days(spark).limit(0), path, batch_id=0, run="r")
    S.append_readings(_days(spark), path, batch_id=0, run="r")
    S.append_readings(_days(spark).limit(0), path, batch_id=0, run="r")  # a replay without rows takes them back
    empty = read_table(spark, path)
    assert empty.count() == 0 and "sensor_id" in empty.columns


@pytest.mark.parametrize("dictionary", ["true", "false"])
def test_one_sensor_is_read_from_the_files_that_hold_it(spark, dictionary):
    """Every micro-batch file spans the whole range of sensor ids; only those with the sensor give rows."""
    path = f"{new_folder()}/sensor_data"
    spark.conf.set("parquet.enable.dictionary", dictionary)
    try:
        for k in range(4):  # batch k holds the sensors k, k + 4, ...
            r = spark.range(20_000).selectExpr(
                "id as seq", f"concat('s', lpad(4 * (id % 1000) + {k}, 5, '0')) as sensor_id", "1704067200000000 + id as us",
                "20.0 as temperature", "50.0 as humidity", "3.0 as wind_speed")
            S.append_readings(r.withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz")), path, files=1)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    got = reports.for_sensor(read_table(spark, path), "s00402")
    assert got.count() == 20
    got.collect()
    scan = got._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 20_000  # one of four files
