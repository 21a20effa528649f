"""Reports on hourly partial aggregates against the same reports on all rows."""

import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorqc.operators import reports, rollups
from sensorqc.operators.alerts import build_alerts
from sensorqc.operators.metrics import evaluate_all
from sensorqc.operators.windows import trailing_window
from sensorqc.sinks import tables as S
from sensorqc.sources import fixtures
from sensorqc.sources.tables import read_table
from sensorqc.streaming.fanout import FanOut

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def rounded(df):
    return sorted(map(str, df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if t in ("double", "float") else c
                                       for c, t in df.dtypes]).collect()))


@pytest.fixture(scope="module")
def stored(spark):
    """The fixture's readings over a day and a half, in three micro-batches, one of them replayed."""
    base = tempfile.mkdtemp(prefix="sensorqc-rollups-")
    r = fixtures.readings(spark, SF)
    us = F.col("us") + F.pmod("seq", F.lit(5)) * F.lit(9 * 3_600_000_000)
    r = r.withColumn("us", us).withColumn("timestamp", F.timestamp_micros("us").cast("timestamp_ntz"))
    stats = trailing_window(r).join(r.select("seq", "temperature", "humidity", "wind_speed"), "seq")
    fan = FanOut(base, evaluated_at_reading_time=True, run="r", rollups=True)
    for k in (0, 1, 2, 1):
        fan(stats.where(F.pmod("seq", F.lit(3)) == k), k)
    return base


def tables(spark, base):
    return [read_table(spark, f"{base}/{t}") for t in ("metric_rollups", "reading_rollups", "quality_metrics",
                                                       "sensor_data", "alerts")]


@pytest.mark.parametrize("hours,minutes", [(24, 0), (24, 17), (1, 0), (0.25, 3), (1000, 0), (0.01, 59)])
def test_reports_equal_those_on_all_rows(spark, stored, hours, minutes):
    as_of = START + timedelta(hours=37, minutes=minutes)
    partial, by_reading, metrics, readings, alerts = tables(spark, stored)
    got = rollups.quality_metrics_summary(partial, metrics, hours, as_of)
    want = reports.quality_metrics_summary(metrics, hours, as_of)
    assert got.columns == want.columns and rounded(got) == rounded(want)
    assert rounded(reports.sensor_failure_rates(got)) == rounded(reports.sensor_failure_rates(want))
    got = rollups.system_statistics(by_reading, partial, readings, metrics, alerts, as_of)
    assert rounded(got) == rounded(reports.system_statistics(readings, metrics, alerts, as_of))
    count = rollups.active_sensor_count(by_reading, readings, hours, as_of).first()[0]
    assert count == reports.active_sensor_count(reports.within_lookback(readings, as_of, hours)).first()[0]


def test_bounds_on_the_hour_read_rollups_only(spark, stored):
    partial, _, metrics, _, _ = tables(spark, stored)

    def files(df):
        return {f.rsplit("/dt=", 1)[0].rsplit("/", 1)[1] for f in df.inputFiles()}

    as_of = START + timedelta(hours=37)
    assert files(rollups.quality_metrics_summary(partial, metrics, 24, as_of)) == {"metric_rollups"}
    cut = rollups.quality_metrics_summary(partial, metrics, 24, as_of + timedelta(minutes=1))
    assert files(cut) == {"metric_rollups", "quality_metrics"}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(timestamp" in plan


def test_now_as_the_time_of_the_report(spark):
    r = fixtures.readings(spark, SF).limit(200)
    r = r.withColumn("timestamp", F.timestamp_add("MICROSECOND", -F.col("seq") * 40_000_000, F.localtimestamp()))
    r = spark.createDataFrame(r.toPandas(), r.schema)
    rolled = rollups.reading_rollup(r)
    for hours in (0.5, 1):
        got = rollups.active_sensor_count(rolled, r, hours).first()[0]
        assert got == reports.active_sensor_count(reports.within_lookback(r, None, hours)).first()[0] > 0


def test_compaction_merges_partial_rows(spark, stored):
    partial, by_reading, *_ = tables(spark, stored)
    before = partial.count(), by_reading.count()
    want = rounded(rollups.merge_metric_rollups(partial))
    hours = sorted(map(tuple, rollups.merge_reading_rollups(by_reading).select(
        "hour", "readings", F.hll_sketch_estimate("sensors")).collect()))
    for t in ("metric_rollups", "reading_rollups"):
        for day in ("2024-01-01", "2024-01-02"):
            S.compact_day(spark, f"{stored}/{t}", t, day)
    partial, by_reading, metrics, *_ = tables(spark, stored)
    assert (partial.count(), by_reading.count()) == (len(want), len(hours)) < before
    assert rounded(partial.drop("batch_id")) == want
    assert sorted(map(tuple, by_reading.select("hour", "readings", F.hll_sketch_estimate("sensors")).collect())) == hours
    as_of = START + timedelta(hours=37, minutes=5)
    assert rounded(rollups.quality_metrics_summary(partial, metrics, 24, as_of)) == rounded(
        reports.quality_metrics_summary(metrics, 24, as_of))


def test_distinct_sensors_within_the_stated_error(spark):
    n = 200_000
    r = spark.range(n * 2).select(F.concat(F.lit("S"), (F.col("id") % n).cast("string")).alias("sensor_id"),
                                  F.timestamp_micros(F.col("id") * 50_000).cast("timestamp_ntz").alias("timestamp"))
    hours = rollups.reading_rollup(r)
    got = rollups.active_sensor_count(hours, r, 24, datetime(1970, 1, 2)).first()[0]
    assert abs(got - n) < 4 * 0.016 * n


def test_empty_tables_and_null_values(spark, tmp_dir):
    r = fixtures.readings(spark, SF)
    m = evaluate_all(trailing_window(r).join(r.select("seq", "temperature", "humidity", "wind_speed"), "seq"))
    none = m.where("false")
    rolled = rollups.metric_rollup(none)
    assert rollups.quality_metrics_summary(rolled, none, 24, START).count() == 0
    empty = rollups.system_statistics(rollups.reading_rollup(r.where("false")), rolled, r.where("false"), none,
                                      build_alerts(none), START)
    assert rounded(empty) == rounded(reports.system_statistics(r.where("false"), none, build_alerts(none), START))
    assert rollups.active_sensor_count(rollups.reading_rollup(r.where("false")), r.where("false"), 1, START).first()[0] == 0
    nulls = m.withColumn("metric_value", F.when(F.col("sensor_id") > "SNS-00020", F.col("metric_value")))
    as_of = START + timedelta(hours=1)
    assert rounded(rollups.quality_metrics_summary(rollups.metric_rollup(nulls), nulls, 24, as_of)) == rounded(
        reports.quality_metrics_summary(nulls, 24, as_of))
    S.append_rollups(r.where("false"), none, tmp_dir, batch_id=0, run="r")
    assert read_table(spark, f"{tmp_dir}/metric_rollups").count() == 0
