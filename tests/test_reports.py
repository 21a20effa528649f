"""Report edge cases: inclusive lookback, ties in top-k, empty inputs."""

from datetime import datetime

from pyspark.sql import functions as F

from helpers import readings_df
from sensorqc.operators import alerts as A
from sensorqc.operators import reports as G
from sensorqc.plans.pipeline import quality_metrics

AS_OF = datetime(2024, 1, 1, 0, 10)


def test_lookback_lower_bound_is_inclusive_and_future_rows_pass(spark):
    # BASE is 2024-01-01 00:00:00; as_of 00:10 with 10 minutes -> bound 00:00:00
    r = readings_df(spark, [(1, "A", 0, 1.0, 1.0, 1.0), (2, "A", -0.000001, 1.0, 1.0, 1.0),
                            (3, "A", 3600, 1.0, 1.0, 1.0)])
    got = {x.seq for x in G.within_lookback(r, AS_OF, minutes=10).collect()}
    assert got == {1, 3}


def test_summary_and_failure_rates(spark):
    rows = [(i, "A" if i % 2 else "B", i * 20, None if i % 3 == 0 else 10.0, 50.0, 5.0) for i in range(12)]
    m = quality_metrics(readings_df(spark, rows))
    summary = G.quality_metrics_summary(m, hours=10**5, as_of=AS_OF)
    s = summary.collect()
    assert [(x.sensor_id, x.metric_name) for x in s] == sorted((x.sensor_id, x.metric_name) for x in s)
    rates = {x.sensor_id: x for x in G.sensor_failure_rates(summary).collect()}
    for sid, x in rates.items():
        assert x.total_checks == m.where(F.col("sensor_id") == sid).count()
        assert x.failure_rate == x.failed_checks / x.total_checks * 100


def test_top_problem_sensors_break_ties_by_id(spark):
    rates = spark.createDataFrame([("C", 4, 1, 25.0), ("A", 4, 1, 25.0), ("B", 2, 1, 50.0), ("D", 4, 0, 0.0)],
                                  "sensor_id string, total_checks long, failed_checks long, failure_rate double")
    assert [x.sensor_id for x in G.top_problem_sensors(rates, 3).collect()] == ["B", "A", "C"]


def test_completeness_score_empty_is_null_and_band(spark):
    m = quality_metrics(readings_df(spark, [(1, "A", 0, 1.0, 1.0, 1.0)]))
    assert G.completeness_score(m, hours=1, as_of=datetime(2030, 1, 1)).first().quality_score is None
    bands = spark.createDataFrame([(79.9,), (80.0,), (94.9,), (95.0,)], "quality_score double")
    assert [x.band for x in G.with_score_band(bands).collect()] == ["red", "yellow", "yellow", "green"]


def test_lookback_without_a_length_is_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        G.within_lookback(readings_df(spark, [(1, "A", 0, 1.0, 1.0, 1.0)]), AS_OF)


def _stored(spark, tmp, how):
    """The three tables as sinks write them: batch loads, or the stream's fan-out."""
    from sensorqc.operators.windows import trailing_window
    from sensorqc.sinks import tables as S
    from sensorqc.streaming.fanout import FanOut
    rows = [(i, "S%d" % (i % 5), i * 4, None if i % 3 else 10.0 + i % 50, None if i % 2 else 50.0, 5.0 if i % 4 else 90.0)
            for i in range(150)]
    r = readings_df(spark, rows)
    m = quality_metrics(r)
    if how == "batch":
        S.append_readings(r, f"{tmp}/sensor_data")
        S.append_metrics(m, f"{tmp}/quality_metrics")
        S.append_alerts(A.build_alerts(m), f"{tmp}/alerts")
    else:
        stats = trailing_window(r).join(r.select("seq", "temperature", "humidity", "wind_speed"), "seq")
        FanOut(tmp, evaluated_at_reading_time=True)(stats, 0)
    return r, m, *[spark.read.parquet(f"{tmp}/{t}") for t in ("sensor_data", "quality_metrics", "alerts")]


def test_reports_run_on_stored_tables(spark):
    """Every report gives on the tables that the sinks wrote what it gives in memory."""
    import tempfile
    as_of = datetime(2024, 1, 1, 0, 30)
    rows = lambda df: sorted(map(str, df.collect()))
    for how in ("batch", "stream"):
        r, m, sd, qm, al = _stored(spark, tempfile.mkdtemp(prefix="sensorqc-test-"), how)
        mem = A.build_alerts(m)
        assert al.count() == mem.count() > 100
        assert G.sensor_data_count(sd, None, 24, as_of).first()["count"] == 150
        text = lambda df: rows(df.select("timestamp", "sensor_id", "severity", "message"))
        assert text(G.active_alerts(al, 24, as_of)) == text(G.active_alerts(mem, 24, as_of))
        top, want = (G.recent_alerts(x, 1, 10, as_of).collect() for x in (al, mem))
        assert top == want and len(top) == 10
        counts = G.severity_counts(mem, 24, as_of)
        assert rows(G.severity_counts(al, 24, as_of)) == rows(counts)
        assert rows(G.severity_counts(G.active_alerts(al, 24, as_of), 24, as_of)) == rows(counts)
        assert {x.severity: x.severity_rank for x in counts.collect()}.items() <= \
            {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}.items()
        for source in (al, G.active_alerts(al, 24, as_of)):
            assert G.recent_critical_alerts(source, 5, 24, as_of).collect() == \
                G.recent_critical_alerts(mem, 5, 24, as_of).collect()
        resolved = al.withColumn("resolved", F.lit(True))
        assert G.severity_counts(resolved, 24, as_of).count() == 0 == G.recent_critical_alerts(resolved, 5, 24, as_of).count()
        assert G.severity_counts(al, 24, datetime(2024, 1, 3)).count() == 0  # expired
        stat = G.system_statistics(sd, qm, al, as_of).first()
        same = G.system_statistics(r, m, mem, as_of).first()
        assert stat == same and stat.active_alerts_count == mem.count()
        summary = G.quality_metrics_summary(qm, 24, as_of)
        assert G.summary_head(summary, 3).count() == 3 and G.active_sensor_count(summary).first()[0] == 5
        assert G.status_distribution(qm, 1, as_of).count() == 2 and G.average_temperature_series(sd, 1, as_of).count() > 0
        assert G.with_score_band(G.completeness_score(qm, 1, as_of)).first().band in ("red", "yellow", "green")
        assert G.top_problem_sensors(G.sensor_failure_rates(summary), 2).count() == 2
        health = G.monitor_health(sd, as_of, running=False).first()
        assert (health.status, health.processed_count, health.processor_running) == ("stopped", 150, False)
        assert G.monitor_health(sd, as_of, error="x").first().status == "unhealthy"
        sev = lambda df: rows(df.select("sensor_id", "seq", "fail_count", "severity"))
        assert sev(A.notification_severity(A.notify_candidates(al))) == sev(A.notification_severity(A.notify_candidates(mem)))
        assert sev(A.quality_notifications(al)) == sev(A.quality_notifications(mem))


def test_recent_alerts_newest_first_and_resolved_excluded(spark):
    rows = [(i, "A", i * 10, None, None, 1.0) for i in range(15)]  # completeness fails on every reading
    alerts = A.build_alerts(quality_metrics(readings_df(spark, rows)))
    top = G.recent_alerts(alerts, hours=10**5, k=3, as_of=AS_OF).collect()
    assert len(top) == 3 and top[0].timestamp >= top[1].timestamp >= top[2].timestamp
    none = G.recent_alerts(alerts.withColumn("resolved", F.lit(True)), hours=10**5, as_of=AS_OF)
    assert none.count() == 0


def test_system_statistics_one_row(spark):
    rows = [(i, "S%d" % (i % 4), i * 7, 10.0 if i % 5 else None, 50.0, 5.0) for i in range(40)]
    r = readings_df(spark, rows)
    m = quality_metrics(r)
    out = G.system_statistics(r, m, A.build_alerts(m), as_of=datetime(2024, 1, 1, 0, 30)).collect()
    assert len(out) == 1
    assert out[0].total_data_points == 40 and out[0].active_sensors_count == 4
    assert len(out[0].top_problematic_sensors) == 4
