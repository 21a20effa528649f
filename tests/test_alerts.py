"""Severity boundaries, message texts and number formatting."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sensorqc.functions.expressions import py_fixed
from sensorqc.operators import alerts as A
from sensorqc.operators import reports as G

METRIC = "seq long, sensor_id string, timestamp timestamp_ntz, metric_name string, metric_order int, " \
         "metric_value double, threshold double, status string, window_start timestamp_ntz, window_end timestamp_ntz"


def _metrics(spark, rows):
    from datetime import datetime
    t = datetime(2024, 1, 1, 0, 10)
    order = {"completeness": 0, "temperature_validity": 1, "humidity_validity": 2, "wind_speed_validity": 3,
             "timeliness": 4, "consistency": 5}
    data = [(i, sid, t, name, order.get(name, 9), v, thr, "FAIL", t, t) for i, (sid, name, v, thr) in enumerate(rows)]
    return spark.createDataFrame(data, METRIC)


@pytest.mark.parametrize("name,low,high,sev", [
    ("completeness", 49.9, 50.0, "CRITICAL"), ("timeliness", 69.9, 70.0, "HIGH"),
    ("temperature_validity", 79.9, 80.0, "HIGH"), ("wind_speed_validity", 79.9, 80.0, "HIGH"),
    ("consistency", 59.9, 60.0, "MEDIUM")])
def test_severity_boundaries(spark, name, low, high, sev):
    a = {r.metric_value: r for r in A.build_alerts(_metrics(spark, [("S", name, low, 90.0),
                                                                   ("S", name, high, 90.0)])).collect()}
    assert a[low].severity == sev and a[high].severity == "LOW"
    assert a[high].severity_rank == 1 and a[low].alert_type == "QUALITY_ALERT" and a[low].resolved is False


def test_message_rounds_like_python(spark):
    a = A.build_alerts(_metrics(spark, [("S", "completeness", 56.25, 80.0), ("S", "odd_metric", 1.25, 2.0)]))
    msgs = {r.metric_name: r.message for r in a.collect()}
    assert msgs["completeness"] == "데이터 완전성이 56.2%로 임계값 80.0% 미만입니다."
    assert msgs["odd_metric"] == "odd_metric 메트릭이 임계값을 벗어났습니다: 1.2 (임계값: 2.0)"


def test_fixed_point_formatting_matches_python(spark):
    rng = random.Random(1)
    vals = {n / m * 100 for m in [*range(1, 120), *range(1990, 2011), 3999, 4000] for n in range(0, m + 1)}
    vals |= {n / 2000 for n in range(2001)} | {100 - v for v in list(vals)[:20000]}
    vals |= {rng.uniform(-1000, 1000) for _ in range(5000)} | {rng.randrange(-10**6, 10**6) / 1000 for _ in range(5000)}
    vals |= {0.05, 0.15, 0.25, 2.675, -0.04, 1e-9, 123456.785, -0.0, 0.125, 0.375, 2.5, -2.675, 1e11 + 0.25}
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = df.select("v", py_fixed("v", 1).alias("a"), py_fixed("v", 2).alias("b")).collect()
    assert not [(r.v, r.a, r.b) for r in got if (r.a, r.b) != (f"{r.v:.1f}", f"{r.v:.2f}")]


def test_notification_payload(spark):
    rows = [("S1", "completeness", 40.0, 80.0), ("S1", "consistency", 70.0, 80.0)]
    m = _metrics(spark, rows).withColumn("seq", F.lit(1).cast("long"))
    n = A.quality_notifications(A.build_alerts(m)).collect()
    assert len(n) == 1 and n[0].fail_count == 1 and n[0].severity == "MEDIUM" and n[0].color == "warning"
    p = json.loads(n[0].payload)
    assert p["text"] == "센서 S1에서 데이터 품질 문제가 감지되었습니다."
    att = p["attachments"][0]
    assert att["title"] == "🚨 데이터 품질 알림 - S1" and att["footer"] == "Smart City Data Quality System"
    assert att["fields"] == [{"title": "Completeness", "value": "현재값: 40.00\n임계값: 80.00\n상태: FAIL",
                              "short": True}]


def test_notifications_from_statistics_equal_those_from_alerts(spark):
    """Without regrouping: one shuffle (the window's), the same messages."""
    from sensorqc.operators.windows import trailing_window
    from sensorqc.plans.pipeline import quality_alerts
    from sensorqc.sources import fixtures
    r = fixtures.readings(spark, "/root/testdata/sf0.001")
    stats, alerts = trailing_window(r), quality_alerts(r)
    for a, b in ((A.quality_notifications_of(stats), A.quality_notifications(alerts)),
                 (A.notification_severity_of(stats), A.notification_severity(A.notify_candidates(alerts)))):
        assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_fixed_values():
    """Texts and thresholds as literals, so that a wrong constant cannot pass on both sides of a comparison."""
    from sensorqc.functions import texts
    from sensorqc.rules import DEFAULT_RULES as R
    assert (R.max_missing_percent, R.validity_threshold, R.timeliness_threshold, R.consistency_threshold) == (20, 95, 90, 80)
    assert (R.window_us, R.expected_points, R.jump_limit) == (300_000_000, 60, 10)
    assert [R.range_of(f) for f in ("temperature", "humidity", "wind_speed")] == [(-20, 40), (0, 100), (0, 50)]
    assert texts.SEVERITIES == ("LOW", "MEDIUM", "HIGH", "CRITICAL")
    assert texts.SEVERITY_COLORS == {"LOW": "good", "MEDIUM": "warning", "HIGH": "danger", "CRITICAL": "#FF0000"}
    assert texts.SCORE_BANDS == (("red", 80.0), ("yellow", 95.0), ("green", None))


def test_daily_summary_message(spark):
    from sensorqc.plans.pipeline import quality_metrics
    from sensorqc.sources import fixtures
    r = fixtures.readings(spark, "/root/testdata/sf0.001")
    got = A.daily_summary(r, quality_metrics(r), "2024-01-01").first()
    p = json.loads(got.payload)
    assert (p["username"], p["icon_emoji"], p["channel"]) == ("ReportBot", ":bar_chart:", "#smart-city-alerts")
    att = p["attachments"][0]
    assert att["color"] == "good" and att["title"] == "📊 일일 데이터 품질 요약 보고서" and att["ts"] == 1704153600
    assert [f["title"] for f in att["fields"]] == ["총 센서 수", "처리된 데이터 건수", "품질 평가 수행 횟수", "실패한 품질 검사",
                                                   "문제 센서 Top 5"]
    assert att["fields"][0]["value"] == str(got.total_sensors) and att["fields"][1]["value"] == "1,000"
    assert att["fields"][4] == {"title": "문제 센서 Top 5", "value": got.top_sensors_text, "short": False}
    empty = A.daily_summary(r, quality_metrics(r), "2030-01-01").first()
    assert len(json.loads(empty.payload)["attachments"][0]["fields"]) == 4


def test_system_payload(spark):
    ev = spark.createDataFrame([("SYSTEM_ERROR", "disk full", "HIGH")], "alert_type string, message string, severity string")
    p = json.loads(A.system_notifications(ev).first().payload)
    assert p == {"channel": "#smart-city-alerts", "username": "SystemBot", "icon_emoji": ":robot_face:", "attachments": [
        {"color": "danger", "title": "🔥 시스템 알림 - SYSTEM_ERROR", "text": "disk full",
         "footer": "Smart City Data Quality System"}]}


def test_system_notification_lookups(spark):
    ev = spark.createDataFrame([("SENSOR_OFFLINE", "m", "CRITICAL"), ("WHATEVER", "m", "ODD")],
                               "alert_type string, message string, severity string")
    out = {r.alert_type: r for r in A.system_notifications(ev).collect()}
    assert out["SENSOR_OFFLINE"].emoji == "📵" and out["SENSOR_OFFLINE"].color == "#FF0000"
    assert out["WHATEVER"].emoji == "ℹ️" and out["WHATEVER"].color == "warning"
    assert out["SENSOR_OFFLINE"].title == "📵 시스템 알림 - SENSOR_OFFLINE"


def test_quote_in_sensor_id_matches_literally(spark):
    from helpers import readings_df
    r = readings_df(spark, [(1, "CHI-O'H-063", 0, 1.0, 1.0, 1.0), (2, "CHI-DOW-001", 1, 1.0, 1.0, 1.0)])
    assert G.sensor_data_count(r, "CHI-O'H-063", hours=10**6).first()["count"] == 1
    assert G.sensor_data_count(r, "", hours=10**6).first()["count"] == 2  # empty id: no filter
