"""Property: the window operators equal a literal replay on random sequences."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import BASE, readings_df, replay, stats_by_seq
from sensorqc.operators.arrival import arrival_window
from sensorqc.operators.windows import trailing_window

temps = st.one_of(st.none(), st.just(math.nan), st.floats(-40, 60, allow_nan=False))
fields = st.one_of(st.none(), st.floats(-20, 130, allow_nan=False))
step = st.tuples(st.sampled_from("AB"), st.integers(0, 120), st.booleans(), st.integers(0, 400), temps, fields, fields)


def _rows(steps, allow_late):
    rows, clock = [], 0
    for seq, (sensor, gap, late, back, t, h, w) in enumerate(steps):
        clock += gap
        sec = clock - (back if (late and allow_late) else 0)
        rows.append((seq, sensor, sec, t, h, w))
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(step, min_size=1, max_size=60), st.sampled_from([None, 5, 17]))
def test_arrival_window_equals_replay(spark, steps, chunk_seqs):
    rows = _rows(steps, allow_late=True)
    expect = replay([(s, k, BASE + sec * 1_000_000, t, h, w) for s, k, sec, t, h, w in rows])
    got = stats_by_seq(arrival_window(readings_df(spark, rows), chunk_seqs=chunk_seqs))
    assert got == expect


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(step, min_size=1, max_size=60))
def test_trailing_window_equals_replay_in_order(spark, steps):
    # in-order input, also with equal times: event time = arrival order
    rows, clock = [], 0
    for seq, (sensor, gap, _late, _back, t, h, w) in enumerate(steps):
        clock += gap if _late else gap % 2
        rows.append((seq, sensor, clock, t, h, w))
    expect = replay([(s, k, BASE + sec * 1_000_000, t, h, w) for s, k, sec, t, h, w in rows])
    for bucket in (300_000_000, 3_600_000_000):
        assert stats_by_seq(trailing_window(readings_df(spark, rows), bucket_us=bucket)) == expect
