"""Streams: batch equals stream, watermark, restart from checkpoint, fan-out."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import stats_by_seq
from sensorqc.operators.arrival import arrival_window
from sensorqc.operators.sliding import sliding_aggregate
from sensorqc.sources import fixtures
from sensorqc.sources.readings import accept_readings, parse_readings, read_readings_stream
from sensorqc.streaming.aggregate import sliding_aggregate_stream, start_stream
from sensorqc.streaming.fanout import FanOut
from sensorqc.streaming.progress import ProcessedCounter
from sensorqc.streaming.stateful import stateful_quality

SF = "/root/testdata/sf0.001"


def _write_parts(df, path, bounds):
    for lo, hi in bounds:
        df.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, schema, files_per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


@pytest.mark.parametrize("engine,buckets", [("group_state", None), ("transform", None), ("group_state", 4)])
def test_stateful_stream_equals_batch_arrival_window_with_late_rows(spark, engine, buckets):
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings_late(spark, SF)
    _write_parts(r, src, [(0, 300), (300, 700), (700, 10**9)])
    out = stateful_quality(_stream(spark, src, r.schema), engine=engine, state_buckets=buckets)
    name = f"r5_late_{engine}_{buckets}"
    q = start_stream(out, tempfile.mkdtemp(prefix="ck-"), fmt="memory", output_mode="append",
                     available_now=True, query_name=name)
    q.awaitTermination()
    got = stats_by_seq(spark.table(name))
    assert len(got) == r.count()
    assert got == stats_by_seq(arrival_window(r))


def test_stream_sliding_aggregate_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF)
    _write_parts(r, src, [(0, 400), (400, 10**9)])
    agg = sliding_aggregate_stream(_stream(spark, src, r.schema))
    q = start_stream(agg, tempfile.mkdtemp(prefix="ck-"), fmt="memory", output_mode="complete",
                     available_now=True, query_name="r1_stream")
    q.awaitTermination()
    cols = ["window_start", "sensor_id", "record_count", "avg_temperature", "temp_stddev"]
    rnd = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith(("avg", "temp")) else c
                                 for c in cols])
    assert sorted(rnd(spark.table("r1_stream")).collect()) == sorted(rnd(sliding_aggregate(r)).collect())


def test_watermark_drops_late_rows_but_stateful_keeps_them(spark):
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF)
    _write_parts(r, src, [(0, 10**9)])
    # a reading 20 minutes older than everything seen, in a second file
    late = (r.where("seq = 5").withColumn("seq", F.lit(10**6).cast("long"))
            .withColumn("us", F.col("us") - F.lit(1_200_000_000))
            .withColumn("timestamp", F.timestamp_add("MICROSECOND", F.lit(-1_200_000_000), "timestamp")))
    seen = []

    def collect(batch, batch_id):
        seen.append((batch_id, batch.count()))

    first_batches = []
    agg = sliding_aggregate_stream(_stream(spark, src, r.schema))
    ck = tempfile.mkdtemp(prefix="ck-")
    q = agg.writeStream.outputMode("update").foreachBatch(collect).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    first_batches.extend(seen)
    late.coalesce(1).write.mode("append").parquet(src)
    seen.clear()
    q = agg.writeStream.outputMode("update").foreachBatch(collect).option("checkpointLocation", ck) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert first_batches and sum(n for _, n in first_batches) > 0
    assert sum(n for _, n in seen) == 0  # the late row changed no window

    out = stateful_quality(_stream(spark, src, r.schema, files_per_trigger=10))
    q = start_stream(out, tempfile.mkdtemp(prefix="ck-"), fmt="memory", output_mode="append",
                     available_now=True, query_name="r5_keeps_late")
    q.awaitTermination()
    got = stats_by_seq(spark.table("r5_keeps_late").where(F.col("seq") == 10**6))
    expect = stats_by_seq(arrival_window(r.unionByName(late)).where(F.col("seq") == 10**6))
    assert len(got) == 1 and got == expect


def test_json_stream_restart_and_fan_out_are_idempotent(spark):
    src = tempfile.mkdtemp(prefix="sensorqc-msg-")
    msgs = fixtures.readings_json(spark, SF)
    _write_parts(msgs, src, [(0, 500)])
    base = tempfile.mkdtemp(prefix="sensorqc-tables-")
    ck = tempfile.mkdtemp(prefix="ck-")
    counter = ProcessedCounter()
    spark.streams.addListener(counter)

    def run():
        stream = read_readings_stream(spark, "parquet", path=src, schema=msgs.schema,
                                      options={"maxFilesPerTrigger": 1})
        stats = stateful_quality(accept_readings(parse_readings(stream)))
        q = (stats.writeStream.foreachBatch(FanOut(base, evaluated_at_reading_time=True))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        return q

    run()
    _write_parts(msgs, src, [(500, 10**9)])
    q2 = run()
    metrics = spark.read.parquet(f"{base}/quality_metrics")
    accepted = accept_readings(parse_readings(msgs))
    from sensorqc.plans.pipeline import quality_metrics
    expect = quality_metrics(accepted, form="arrival")
    assert metrics.count() == expect.count()
    key = ["sensor_id", "metric_name", "timestamp"]
    assert metrics.select(*key).distinct().count() == metrics.count()
    assert spark.read.parquet(f"{base}/sensor_data").count() == accepted.count()
    assert os.listdir(f"{base}/quality_metrics/dt=2024-01-01") and not os.path.exists(f"{base}/quality_metrics/batch_id=0")
    spark.streams.removeListener(counter)
    assert q2.lastProgress is not None


def test_replayed_micro_batch_replaces_its_output(spark):
    from sensorqc.operators.windows import trailing_window
    r = fixtures.readings(spark, SF)
    stats = trailing_window(r).join(r.select("seq", "temperature", "humidity", "wind_speed"), "seq")
    base = tempfile.mkdtemp(prefix="sensorqc-tables-")
    fan = FanOut(base, evaluated_at_reading_time=True)
    fan(stats, 7)
    first = {t: spark.read.parquet(f"{base}/{t}").count() for t in ("sensor_data", "quality_metrics", "alerts")}
    fan(stats, 7)  # the same batch again, as after a failure
    again = {t: spark.read.parquet(f"{base}/{t}").count() for t in ("sensor_data", "quality_metrics", "alerts")}
    assert first == again and first["sensor_data"] == r.count()


def test_processed_count_reaches_progress(spark):
    from sensorqc.streaming.progress import observe_processed
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF)
    _write_parts(r, src, [(0, 500), (500, 10**9)])
    counted = observe_processed(_stream(spark, src, r.schema))
    q = start_stream(counted, tempfile.mkdtemp(prefix="ck-"), fmt="noop", output_mode="append",
                     available_now=True)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p["numInputRows"]]
    assert sum(int(p["observedMetrics"]["sensorqc_progress"]["processed"]) for p in batches) == r.count()


def test_pipeline_stores_rejects_and_counts_all_batches(spark):
    from sensorqc.sources.readings import reject_readings
    from sensorqc.streaming.fanout import Rejects, start_pipeline
    from sensorqc.streaming.progress import processed_count
    src, base, ck = (tempfile.mkdtemp(prefix="sensorqc-p-") for _ in range(3))
    msgs = fixtures.readings_json(spark, SF)
    _write_parts(msgs, src, [(0, 500), (500, 10**9)])
    stream = read_readings_stream(spark, "parquet", path=src, schema=msgs.schema, options={"maxFilesPerTrigger": 1})
    queries = start_pipeline(stream, base, ck, trigger={"availableNow": True}, state_buckets=2)
    for q in queries:
        q.awaitTermination()
    parsed = parse_readings(msgs)
    want = sorted(map(tuple, reject_readings(parsed).collect()))
    got = spark.read.parquet(f"{base}/rejects")
    assert sorted(map(tuple, got.select("seq", "reject_reason", "raw").collect())) == want and want
    days = os.listdir(f"{base}/rejects")
    other = f"{base}/rejects/dt=2020-01-01"
    os.rename(f"{base}/rejects/{[d for d in days if d.startswith('dt=')][0]}", other)  # as written before midnight
    for i, (lo, hi) in enumerate([(0, 500), (500, 10**9)]):  # both batches replayed today
        Rejects(base, run=queries[1].id)(reject_readings(parsed.where((F.col("seq") >= lo) & (F.col("seq") < hi))), i)
    again = spark.read.parquet(f"{base}/rejects")
    assert sorted(map(tuple, again.select("seq", "reject_reason", "raw").collect())) == want
    assert processed_count(spark, base).first()[0] == accept_readings(parsed).count()


def test_silent_sensors_leave_the_state_and_come_back(spark):
    from sensorqc.operators.arrival import ArrivalWindow
    from sensorqc.rules import DEFAULT_RULES
    from sensorqc.streaming.stateful import drop_silent
    day = 86_400_000_000
    wins = {s: ArrivalWindow(DEFAULT_RULES) for s in "abcd"}
    for s, us in (("a", 0), ("b", 2 * day), ("c", 2 * day + 5), ("d", 900 * day)):
        wins[s].push(1, us, (1.0, 1.0, 1.0))
    drop_silent(wins, day)  # d's wrong clock takes nothing else with it
    assert sorted(wins) == ["b", "c", "d"]

    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF)
    back = F.col("us") + F.when(F.col("seq") >= 600, F.lit(3 * day)).otherwise(F.lit(0))
    r = r.withColumn("us", back).withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))
    _write_parts(r, src, [(0, 300), (300, 600), (600, 10**9)])
    out = stateful_quality(_stream(spark, src, r.schema), state_buckets=2)
    q = start_stream(out, tempfile.mkdtemp(prefix="ck-"), fmt="memory", output_mode="append",
                     available_now=True, query_name="r5_silent")
    q.awaitTermination()
    assert stats_by_seq(spark.table("r5_silent")) == stats_by_seq(arrival_window(r))


@pytest.mark.parametrize("received", [False, True])
def test_old_backlog_over_several_micro_batches(spark, received):
    """One bucket: two sensors are current, the third uploads points two days old, with a batch between without it."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    day, rows = 86_400_000_000, []
    for batch in range(5):
        for i in range(6):
            now = 10 * day + (batch * 6 + i) * 5_000_000
            sent = [("now1", now), ("now2", now + 1)] + [("old", now - 2 * day)] * (batch != 2)
            rows += [(len(rows) + k, sid, us, now, 20.0 + 15 * (i % 2), 50.0, None) for k, (sid, us) in enumerate(sent)]
    r = spark.createDataFrame(rows, "seq long, sensor_id string, us long, at long, temperature double, "
                                    "humidity double, wind_speed double")
    ntz = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    r = r.withColumn("timestamp", ntz("us")).withColumn("received_at", ntz("at"))
    r = r.drop("at") if received else r.drop("at", "received_at")
    first = [next(x[0] for x in rows if x[3] == 10 * day + b * 30_000_000) for b in range(5)]
    _write_parts(r, src, zip(first, [*first[1:], 10**9]))
    q = start_stream(stateful_quality(_stream(spark, src, r.schema), state_buckets=1), tempfile.mkdtemp(prefix="ck-"),
                     fmt="memory", output_mode="append", available_now=True, query_name=f"r5_backlog_{received}")
    q.awaitTermination()
    assert stats_by_seq(spark.table(f"r5_backlog_{received}")) == stats_by_seq(arrival_window(r.drop("received_at")))


def test_two_sensors_one_with_its_clock_ahead(spark):
    """The honest sensor of a bucket of two keeps its window through a batch without it."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    day = 86_400_000_000
    rows = [(i, sid, us + i * 5_000_000, 20.0, 50.0, 3.0) for i, (sid, us) in enumerate(
        [("good", 0), ("ahead", 2 * day)] * 3 + [("ahead", 2 * day)] * 3 + [("good", 0), ("ahead", 2 * day)] * 3)]
    r = spark.createDataFrame(rows, "seq long, sensor_id string, us long, temperature double, humidity double, "
                                    "wind_speed double")
    r = r.withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))
    _write_parts(r, src, [(0, 6), (6, 9), (9, 10**9)])
    q = start_stream(stateful_quality(_stream(spark, src, r.schema), state_buckets=1), tempfile.mkdtemp(prefix="ck-"),
                     fmt="memory", output_mode="append", available_now=True, query_name="r5_two")
    q.awaitTermination()
    assert stats_by_seq(spark.table("r5_two")) == stats_by_seq(arrival_window(r))


def test_silent_sensor_is_dropped_by_arrival_time():
    from sensorqc.operators.arrival import ArrivalWindow
    from sensorqc.rules import DEFAULT_RULES
    from sensorqc.streaming.stateful import drop_silent
    day = 86_400_000_000
    wins = {s: ArrivalWindow(DEFAULT_RULES) for s in "abc"}
    for s in wins:
        wins[s].push(1, 0, (1.0, 1.0, 1.0))
    drop_silent(wins, day, {"a": 5 * day, "b": 9 * day, "c": 0}, 10 * day, {"c"})
    assert sorted(wins) == ["b", "c"]


def test_stamps_from_the_future_keep_no_sensor():
    from sensorqc.operators.arrival import ArrivalWindow
    from sensorqc.rules import DEFAULT_RULES
    from sensorqc.streaming.stateful import drop_silent
    day = 86_400_000_000
    for by_arrival in (True, False):
        wins = {s: ArrivalWindow(DEFAULT_RULES) for s in ("ahead", "now", "idle")}
        for s, us in (("ahead", 900 * day), ("now", 10 * day), ("idle", 7 * day)):
            wins[s].push(1, us, (1.0, 1.0, 1.0))
        drop_silent(wins, day, {"ahead": 8 * day, "now": 10 * day, "idle": 7 * day}, 10 * day, {"now"}, by_arrival)
        assert sorted(wins) == ["now"]


@pytest.mark.parametrize("engine,buckets", [("group_state", None), ("transform", None), ("group_state", 4)])
def test_stateful_stream_orders_by_arrival_time_over_partitions(spark, engine, buckets):
    """Kafka numbers order a partition only: the broker's time puts a sensor's messages in order."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings_late(spark, SF).where("seq < 900").withColumn(
        "received_at", F.timestamp_micros(F.col("seq") * 1_000_000).cast("timestamp_ntz"))
    moved = F.shiftleft(F.pmod(F.col("seq"), F.lit(2)) * 200, 47) + F.col("seq")
    for lo, hi in ((0, 300), (300, 900)):
        part = r.where((F.col("seq") >= lo) & (F.col("seq") < hi)).withColumn("seq", moved)
        part.orderBy("seq").coalesce(1).write.mode("append").parquet(src)
    name = f"r5_order_{engine}_{buckets}"
    q = start_stream(stateful_quality(_stream(spark, src, r.schema), engine=engine, state_buckets=buckets),
                     tempfile.mkdtemp(prefix="ck-"), fmt="memory", output_mode="append", available_now=True, query_name=name)
    q.awaitTermination()
    back = spark.table(name).withColumn("seq", F.col("seq").bitwiseAND(F.lit((1 << 47) - 1)))
    assert stats_by_seq(back) == stats_by_seq(arrival_window(r.drop("received_at")))


def test_pane_stream_equals_batch_with_late_rows(spark):
    """Late rows within the watermark count in all their windows, one behind it in none."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF).select("seq", "sensor_id", "us", "timestamp", "temperature", "humidity", "wind_speed")
    end = r.agg(F.max("us")).first()[0]
    late = (r.where(F.col("us") > end - 60_000_000).withColumn("us", F.col("us") - F.lit(90_000_000))
            .withColumn("seq", F.col("seq") + 10**6).withColumn("temperature", F.lit(99.5)))
    flush = r.where("seq = 0").withColumn("us", F.lit(end + 3_600_000_000)).withColumn("seq", F.lit(10**8).cast("long"))
    behind = r.where("seq = 1").withColumn("us", F.lit(end - 1_200_000_000)).withColumn("seq", F.lit(10**8 + 1).cast("long"))
    stamped = lambda df: df.withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))
    assert late.count() > 0
    for part in (r, late, flush, behind):
        stamped(part).coalesce(1).write.mode("append").parquet(src)
    q = start_stream(sliding_aggregate_stream(_stream(spark, src, r.schema), panes=True), tempfile.mkdtemp(prefix="ck-"),
                     fmt="memory", output_mode="append", available_now=True, query_name="r1_panes")
    q.awaitTermination()
    rnd = lambda df: sorted(df.where(F.col("window_end") <= F.timestamp_micros(F.lit(end + 600_000_000)).cast("timestamp_ntz"))
                            .select("window_start", "sensor_id", "record_count", F.round("avg_temperature", 6).alias("a"),
                                    F.round("avg_wind_speed", 6).alias("b"), F.round("temp_stddev", 5).alias("c")).collect())
    want = rnd(sliding_aggregate(stamped(r.unionByName(late))))
    assert rnd(spark.table("r1_panes")) == want and len(want) > 100


def test_pane_stream_changes_fewer_states(spark):
    """Micro-batches of 15 seconds: the direct form changes five windows a sensor each time, the pane form one pane."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    rows = [(i, s, f"2024-01-01 00:0{i * 5 // 60}:{i * 5 % 60:02d}", 20.0 + i, 50.0, None) for i in range(24) for s in "abc"]
    rows += [(10**6, "a", "2024-01-01 02:00:00", 0.0, 0.0, 0.0)]
    r = spark.createDataFrame(rows, "seq long, sensor_id string, at string, temperature double, humidity double, "
                                    "wind_speed double").selectExpr("*", "cast(at as timestamp_ntz) as timestamp").drop("at")
    _write_parts(r, src, [(k, k + 3) for k in range(0, 24, 3)] + [(24, 10**9)])
    updates, found = {}, {}
    for panes in (True, False):
        q = start_stream(sliding_aggregate_stream(_stream(spark, src, r.schema), panes=panes), tempfile.mkdtemp(prefix="ck-"),
                         fmt="memory", output_mode="append", available_now=True, query_name=f"r1_updates_{panes}")
        q.awaitTermination()
        updates[panes] = sum(o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"])
        found[panes] = sorted(map(str, spark.table(f"r1_updates_{panes}").select(
            "window_start", "sensor_id", "record_count", "avg_temperature", F.round("temp_stddev", 6)).collect()))
    assert found[True] == found[False] and len(found[True]) == 18
    assert updates[True] <= 60 < 120 <= updates[False], updates


def test_processing_time_trigger_and_console(spark):
    """A query on a clock, in update mode, printing to the console."""
    src = tempfile.mkdtemp(prefix="sensorqc-src-")
    r = fixtures.readings(spark, SF).limit(20)
    r.coalesce(1).write.mode("append").parquet(src)
    agg = sliding_aggregate_stream(_stream(spark, src, r.schema))
    q = start_stream(agg, tempfile.mkdtemp(prefix="ck-"), fmt="console", trigger_seconds=1)
    try:
        q.processAllAvailable()
        assert q.isActive and q.lastProgress is not None
        assert sum(p["numInputRows"] for p in q.recentProgress) == 20
    finally:
        q.stop()
