"""Edge cases of the window and the metrics, in both window forms."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import readings_df
from sensorqc.plans.pipeline import quality_metrics, window_stats
from sensorqc.rules import DEFAULT_RULES

FORMS = ["event_time", "arrival"]


def metrics_of(spark, rows, form, rules=DEFAULT_RULES, seq=None):
    m = quality_metrics(readings_df(spark, rows), rules, form=form)
    if seq is not None:
        m = m.where(F.col("seq") == seq)
    return {r.metric_name: r for r in m.collect()}


@pytest.mark.parametrize("form", FORMS)
def test_point_exactly_one_window_old_is_outside(spark, form):
    rows = [(1, "A", 0, 1.0, 1.0, 1.0), (2, "A", 300, 1.0, 1.0, 1.0), (3, "A", 300.000001 - 0.000001, 1.0, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows[:2]), form=form).collect()}
    assert st[2].n == 1
    rows = [(1, "A", 0, 1.0, 1.0, 1.0), (2, "A", 299.999999, 1.0, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows), form=form).collect()}
    assert st[2].n == 2


@pytest.mark.parametrize("form", FORMS)
def test_timeliness_54_of_60_passes(spark, form):
    rows = [(i, "A", i * 5, 1.0, 1.0, 1.0) for i in range(54)]
    m = metrics_of(spark, rows, form, seq=53)
    assert m["timeliness"].metric_value == 90.0 and m["timeliness"].status == "PASS"
    m = metrics_of(spark, rows[:53], form, seq=52)
    assert m["timeliness"].status == "FAIL"


@pytest.mark.parametrize("form", FORMS)
def test_completeness_exactly_20_percent_missing_passes(spark, form):
    rows = [(1, "A", 0, None, 1.0, 1.0), (2, "A", 1, 1.0, None, 1.0), (3, "A", 2, 1.0, 1.0, None),
            (4, "A", 3, 1.0, 1.0, 1.0), (5, "A", 4, 1.0, 1.0, 1.0)]
    m = metrics_of(spark, rows, form, seq=5)["completeness"]
    assert m.metric_value == 80.0 and m.threshold == 80.0 and m.status == "PASS"


@pytest.mark.parametrize("form", FORMS)
def test_validity_19_of_20_and_bounds(spark, form):
    temps = [-20.0, 40.0] + [10.0] * 17 + [40.0001]
    rows = [(i, "A", i, t, 0.0, 50.0) for i, t in enumerate(temps)]
    m = metrics_of(spark, rows, form, seq=19)
    assert m["temperature_validity"].metric_value == 95.0
    assert m["temperature_validity"].status == "PASS"
    assert m["humidity_validity"].metric_value == 100.0  # 0 is on the bound
    assert m["wind_speed_validity"].metric_value == 100.0  # 50 is on the bound


@pytest.mark.parametrize("form", FORMS)
def test_jump_of_exactly_ten_is_consistent(spark, form):
    rows = [(1, "A", 0, 0.0, 1.0, 1.0), (2, "A", 1, 10.0, 1.0, 1.0), (3, "A", 2, 20.0001, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows), form=form).collect()}
    assert (st[2].pairs, st[2].jumps) == (1, 0)
    assert (st[3].pairs, st[3].jumps) == (2, 1)
    m = metrics_of(spark, rows, form, seq=3)["consistency"]
    assert m.metric_value == 50.0 and m.status == "FAIL"


@pytest.mark.parametrize("form", FORMS)
def test_null_breaks_the_chain(spark, form):
    rows = [(1, "A", 0, 5.0, 1.0, 1.0), (2, "A", 1, None, 1.0, 1.0), (3, "A", 2, 50.0, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows), form=form).collect()}
    assert st[3].pairs == 0
    assert metrics_of(spark, rows, form, seq=3)["consistency"].metric_value == 100.0


@pytest.mark.parametrize("form", FORMS)
def test_single_reading(spark, form):
    m = metrics_of(spark, [(1, "A", 0, 5.0, 1.0, 1.0)], form)
    c = m["consistency"]
    assert c.metric_value == 100.0 and c.status == "PASS"
    assert (c.window_end - c.window_start).total_seconds() == 300
    assert c.window_end == m["completeness"].window_end
    assert m["timeliness"].metric_value == pytest.approx(100 / 60)


@pytest.mark.parametrize("form", FORMS)
def test_field_null_everywhere_gives_no_validity_row(spark, form):
    rows = [(1, "A", 0, None, 1.0, 1.0), (2, "A", 1, None, 1.0, 1.0)]
    m = metrics_of(spark, rows, form, seq=2)
    assert "temperature_validity" not in m
    assert set(m) == {"completeness", "humidity_validity", "wind_speed_validity", "timeliness", "consistency"}


@pytest.mark.parametrize("form", FORMS)
def test_nan_is_present_invalid_and_never_a_jump(spark, form):
    rows = [(1, "A", 0, 0.0, 1.0, 1.0), (2, "A", 1, math.nan, 1.0, 1.0), (3, "A", 2, 50.0, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows), form=form).collect()}
    assert st[3].temperature_nulls == 0 and st[3].temperature_n == 3 and st[3].temperature_valid == 1
    assert (st[3].pairs, st[3].jumps) == (2, 0)


@pytest.mark.parametrize("form", FORMS)
def test_sensors_are_independent_and_metric_order(spark, form):
    rows = [(1, "A", 0, 1.0, 1.0, 1.0), (2, "B", 1, 1.0, 1.0, 1.0), (3, "A", 2, 1.0, 1.0, 1.0)]
    st = {r.seq: r for r in window_stats(readings_df(spark, rows), form=form).collect()}
    assert (st[1].n, st[2].n, st[3].n) == (1, 1, 2)
    m = quality_metrics(readings_df(spark, rows), form=form).where("seq = 3").orderBy("metric_order").collect()
    assert [r.metric_name for r in m] == ["completeness", "temperature_validity", "humidity_validity",
                                          "wind_speed_validity", "timeliness", "consistency"]
