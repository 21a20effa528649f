"""Window forms against a literal replay, and scale forms against plain forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import BASE, readings_df, replay, stats_by_seq
from sensorqc.operators.arrival import _removal_order, _with_context, arrival_chunk, arrival_key, arrival_window
from sensorqc.operators.windows import trailing_window
from sensorqc.rules import DEFAULT_RULES
from sensorqc.sources import fixtures

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.seq, r.sensor_id, r.us, r.temperature, r.humidity, r.wind_speed)
            for r in df.orderBy("seq").collect()]


def test_event_time_window_equals_replay_for_in_order_input(spark):
    r = fixtures.readings(spark, SF)
    assert stats_by_seq(trailing_window(r)) == replay(_rows(r))


@pytest.mark.parametrize("bucket_us", [300_000_000, 420_000_000, 3_600_000_000])
@pytest.mark.parametrize("source", [fixtures.readings, fixtures.readings_coarse])
def test_time_buckets_do_not_change_the_result(spark, bucket_us, source):
    r = source(spark, SF)
    assert stats_by_seq(trailing_window(r, bucket_us=bucket_us)) == stats_by_seq(trailing_window(r, bucket_us=10**15))


def test_equal_times_are_ordered_by_arrival(spark):
    rows = [(1, "A", 0, 10.0, 1.0, 1.0), (2, "A", 1, 11.0, 1.0, 1.0), (3, "A", 1, 12.0, 1.0, 1.0),
            (4, "A", 2, 39.0, 1.0, 1.0)]
    got = stats_by_seq(trailing_window(readings_df(spark, rows)))
    assert {k: (v["n"], v["pairs"], v["jumps"]) for k, v in got.items()} == {1: (1, 0, 0), 2: (2, 1, 0), 3: (3, 2, 0),
                                                                              4: (4, 3, 1)}
    r = fixtures.readings_coarse(spark, SF)
    assert r.groupBy("sensor_id", "us").count().where("count > 1").count() > 10
    assert stats_by_seq(trailing_window(r)) == replay(_rows(r)) == stats_by_seq(arrival_window(r))


def test_prefix_form_on_edge_rows(spark):
    import math
    from helpers import readings_df
    rows = [(1, "A", 0, 0.0, 1.0, 1.0), (2, "A", 1, math.nan, 1.0, 1.0), (3, "A", 2, 50.0, None, 1.0),
            (4, "A", 300, None, 1.0, 1.0), (5, "A", 301, 12.0, 1.0, 1.0), (6, "A", 301.5, 30.0, 1.0, 1.0),
            (7, "B", 5, 1.0, 1.0, 1.0), (8, "A", 900, 1.0, 1.0, 1.0)]
    df = readings_df(spark, rows)
    expect = replay([(s, k, BASE + int(round(sec * 1e6)), t, h, w) for s, k, sec, t, h, w in rows])
    assert stats_by_seq(trailing_window(df, bucket_us=300_000_000)) == expect


def test_bucket_shorter_than_window_is_refused(spark):
    with pytest.raises(ValueError):
        trailing_window(fixtures.readings(spark, SF), bucket_us=1_000_000)


@pytest.mark.parametrize("chunk_seqs", [None, 1 << 22, 40, 97, 7])
def test_arrival_window_equals_replay_with_late_rows(spark, chunk_seqs):
    r = fixtures.readings_late(spark, SF)
    got = stats_by_seq(arrival_window(r, chunk_seqs=chunk_seqs))
    assert got == replay(_rows(r))


@pytest.mark.parametrize("span_us", [60_000_000, 600_000_000, 3_600_000_000])
def test_arrival_window_in_chunks_of_arrival_time(spark, span_us):
    r = fixtures.readings_received(spark, SF)
    assert stats_by_seq(arrival_window(r, chunk_span_us=span_us)) == replay(_rows(r))


def test_arrival_window_with_a_reading_from_the_future(spark):
    """Never removed, it enters every later chunk; the plan stays the same and nothing stays cached."""
    rows = [(i, "A", i * 30, float(i % 7), 1.0, 1.0) for i in range(200)]
    rows[3] = (3, "A", 10**7, 5.0, 1.0, 1.0)
    expect = replay([(s, k, BASE + int(sec * 1e6), t, h, w) for s, k, sec, t, h, w in rows])
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    few, many = (arrival_window(readings_df(spark, rows), chunk_seqs=n) for n in (100, 4))
    assert stats_by_seq(few) == expect == stats_by_seq(many)
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(few) == size(many)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached


def test_kafka_numbers_follow_broker_time_over_partitions(spark):
    """30 days of one sensor over four partitions: arrival order, and an hour to a chunk."""
    from sensorqc.operators.arrival import DEFAULT_CHUNK_SPAN_US, arrival_chunk
    from sensorqc.sources.readings import number_messages
    raw = spark.range(0, 30 * 24 * 60).selectExpr(
        "timestamp_micros(1704067200000000 + id * 60000000) as timestamp", "cast(id % 4 as int) as partition",
        "id div 4 as offset", "cast('{}' as binary) as value", "id")
    numbered = number_messages(raw).orderBy("received_at", "seq")
    times = [r.received_at for r in numbered.collect()]
    assert times == sorted(times) and numbered.select("seq").distinct().count() == len(times)
    chunks = numbered.select(arrival_chunk(numbered, None, DEFAULT_CHUNK_SPAN_US).alias("c")).distinct().count()
    assert chunks == 720


def _broker_rows(spark, rows):
    return spark.createDataFrame(rows, "ms long, partition int, offset long, timestampType int").selectExpr(
        "timestamp_millis(ms) as timestamp", "partition", "offset", "timestampType", "cast('{}' as binary) as value")


def test_kafka_numbers_at_the_edges_of_partitions_and_offsets(spark):
    """Neighbouring offsets of one millisecond, 300 partitions, the largest numbers, and one too large."""
    from sensorqc.sources.readings import number_messages
    near = _broker_rows(spark, [(7, 3, o, 1) for o in (16385, 16383, 16384, (1 << 47) - 1)])
    seqs = [r.seq for r in number_messages(near).orderBy("received_at", "seq").collect()]
    assert [s & ((1 << 47) - 1) for s in seqs] == [16383, 16384, 16385, (1 << 47) - 1] and min(seqs) > 0
    many = number_messages(_broker_rows(spark, [(7, p, o, 1) for p in [*range(300), 65535] for o in range(3)]))
    assert many.select("seq").distinct().count() == 903 and many.where("seq < 0").count() == 0
    for partition, offset in ((65536, 0), (0, 1 << 47)):
        with pytest.raises(Exception, match="too large"):
            number_messages(_broker_rows(spark, [(7, partition, offset, 1)])).collect()


def test_producer_stamps_are_no_arrival_times(spark):
    from sensorqc.sources.readings import number_messages
    got = number_messages(_broker_rows(spark, [(9, 0, 0, 0), (5, 0, 1, 0), (9, 1, 0, 1)])).orderBy("seq").collect()
    assert got[0].received_at == got[1].received_at > got[2].received_at  # the query's time, then the broker's
    assert got[2].received_at.microsecond == 9000


def test_arrival_window_over_partitions_follows_broker_time(spark):
    """A sensor's messages alternate between partitions, one of which has far higher numbers; some are late."""
    from sensorqc.sources.readings import number_messages
    rng = random.Random(3)
    sent = [(i * 20_000 + (i % 3 == 0), i % 2 * 200, i // 2, i * 20 - rng.choice([0, 0, 10, 350])) for i in range(400)]
    raw = _broker_rows(spark, [(ms, p, o, 1) for ms, p, o, _ in sent])
    at = {(p << 47) + o: (ms, sec) for ms, p, o, sec in sent}
    order = {s: k for k, s in enumerate(sorted(at, key=lambda s: (at[s][0], s)))}
    df = readings_df(spark, [(s, "A", sec, float(order[s] % 7), 50.0, 3.0) for s, (_, sec) in at.items()])
    df = df.join(number_messages(raw).select("seq", "received_at"), "seq")
    ranked = [(order[s], "A", BASE + at[s][1] * 1_000_000, float(order[s] % 7), 50.0, 3.0) for s in at]
    expect = replay(sorted(ranked))
    for span in (600_000_000, 3_600_000_000):
        got = stats_by_seq(arrival_window(df, chunk_span_us=span))
        assert {order[s]: v for s, v in got.items()} == expect


def test_arrival_window_sensor_going_back_in_time(spark):
    # A sensor replays old readings for a while: survivors outlive several
    # chunks and are matched with the sensor's list of chunks.
    rng = random.Random(7)
    rows, seq = [], 0
    for block in range(6):
        for i in range(25):
            sec = (block % 3) * 400 + i * 3 + rng.random()
            t = None if rng.random() < 0.1 else rng.uniform(-30, 50)
            rows.append((seq, "A" if rng.random() < 0.8 else "B", sec, t, rng.uniform(-5, 110), rng.uniform(-2, 60)))
            seq += 1
    df = readings_df(spark, rows)
    expect = replay([(s, k, BASE + int(round(sec * 1e6)), t, h, w) for s, k, sec, t, h, w in rows])
    for chunk_seqs in (10, 33, 1000):
        assert stats_by_seq(arrival_window(df, chunk_seqs=chunk_seqs)) == expect


def test_random_sequences_property(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(400):
        sec = seq * 4 + (-rng.uniform(10, 400) if rng.random() < 0.1 else 0)
        rows.append((seq, rng.choice("ABC"), sec, rng.choice([None, rng.uniform(-25, 45)]),
                     rng.uniform(0, 100), rng.choice([None, 3.0])))
    df = readings_df(spark, rows)
    expect = replay([(s, k, BASE + int(round(sec * 1e6)), t, h, w) for s, k, sec, t, h, w in rows])
    assert stats_by_seq(arrival_window(df, chunk_seqs=50)) == expect


def _unit_rows(df, chunk_seqs):
    """Rows of every chunk with their removers, as the operator sees them."""
    base = df.select("seq", "sensor_id", "us", "temperature", "humidity", "wind_speed",
                     arrival_key(df, chunk_seqs).alias("_at"), arrival_chunk(df, chunk_seqs, 0).alias("_chunk"))
    return _removal_order(_with_context(base, DEFAULT_RULES.window_us), DEFAULT_RULES)


def test_late_readings_of_every_pattern_natively_and_replayed(spark):
    """300 sensors: single late readings, late runs in and out of order, equal times, resent days, clocks ahead."""
    rng = random.Random(11)
    rows, seq = [], 0
    for k in range(300):
        now, step, odd = 0.0, rng.choice([5, 20, 60, 200]), rng.choice([0.05, 0.3, 0.8])
        backlog = None
        for _ in range(40):
            now += step * rng.choice([0, 0.5, 1, 1])
            if backlog is not None and rng.random() < 0.7:
                backlog += rng.choice([0, 1, step])
                sec = backlog
            elif rng.random() < odd:
                sec = now + rng.choice([-50, -250, -300, -301, -700, 40 if k % 3 else 500])
                backlog = sec if k % 2 and rng.random() < 0.5 else None
            else:
                sec, backlog = now, None
            t = None if rng.random() < 0.15 else rng.choice([math.nan, -30.0, 5.0, 14.0, 15.0, 26.0])
            rows.append((seq, f"S{k}", sec, t, rng.choice([None, 50.0, 120.0]), 3.0))
            seq += 1
    df = readings_df(spark, rows)
    expect = replay([(s, k, BASE + int(round(sec * 1e6)), t, h, w) for s, k, sec, t, h, w in rows])
    for chunk_seqs in (17, 1 << 20):
        assert stats_by_seq(arrival_window(df, chunk_seqs=chunk_seqs)) == expect
        kinds = {(r["_replay"], r["dents"] > 1) for r in _unit_rows(df, chunk_seqs).groupBy(
            "sensor_id", "_chunk", "_replay").agg(F.count_if("_dent").alias("dents")).collect()}
        assert kinds >= {(False, False), (False, True), (True, True)}


def test_arrival_window_replays_no_chunk_of_the_late_fixture_by_python(spark):
    r = fixtures.readings_late(spark, SF)
    units = _unit_rows(r, 97).groupBy("_replay").agg(F.count_if("_dent").alias("dents"), F.count("*").alias("n"))
    found = {u["_replay"]: (u["dents"], u["n"]) for u in units.collect()}
    assert found[False][0] > 0 and found.get(True, (0, 0))[1] < 0.02 * found[False][1]


def test_arrival_window_shuffles_all_rows_once(spark):
    """Two scans (one of times only); besides the rows, one shuffle each of newest times, their lists, context rows."""
    df = arrival_window(fixtures.readings_received(spark, SF), chunk_span_us=600_000_000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    assert len(shuffles) <= 5
    assert len([x for x in shuffles if "REPARTITION_BY_COL" in x]) == 2  # rows, context rows


def test_readings_without_sensor_or_arrival_time_and_empty_tables(spark):
    rows = [(1, None, 0, 1.0, 1.0, 1.0), (2, "A", 1, 1.0, 1.0, 1.0), (3, "A", 2, 30.0, 1.0, 1.0)]
    df = readings_df(spark, rows).withColumn("received_at", F.lit(None).cast("timestamp_ntz"))
    got = stats_by_seq(arrival_window(df))
    assert sorted(got) == [2, 3] and (got[3]["n"], got[3]["jumps"]) == (2, 1)
    assert arrival_window(df.where("false")).count() == 0


def test_trailing_window_plan_has_one_shuffle(spark):
    plan = trailing_window(fixtures.readings(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters" in plan or "FileScan parquet" in plan


def test_reading_columns_are_pruned(spark):
    plan = fixtures.readings(spark, SF).select("seq", "sensor_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
