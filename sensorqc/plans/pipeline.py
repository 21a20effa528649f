"""End-to-end plans: readings -> window statistics -> metrics -> alerts.

Each plan is a lazy DataFrame; nothing is collected. The window step is the
only shuffle of the main path (on ``sensor_id`` plus a time bucket or an
arrival chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from sensorqc.operators.alerts import build_alerts
from sensorqc.operators.arrival import DEFAULT_CHUNK_SPAN_US, arrival_window
from sensorqc.operators.metrics import evaluate_all
from sensorqc.operators.windows import DEFAULT_BUCKET_US, trailing_window
from sensorqc.rules import DEFAULT_RULES, QualityRules


def window_stats(readings: DataFrame, rules: QualityRules = DEFAULT_RULES, form: str = "event_time",
                 bucket_us: int = DEFAULT_BUCKET_US, chunk_seqs: int | None = None,
                 chunk_span_us: int = DEFAULT_CHUNK_SPAN_US) -> DataFrame:
    """W1 (``form='event_time'``) or W2 (``form='arrival'``) statistics."""
    if form == "event_time":
        return trailing_window(readings, rules, bucket_us)
    if form == "arrival":
        return arrival_window(readings, rules, chunk_seqs, chunk_span_us)
    raise ValueError(f"unknown window form {form!r}")


def quality_metrics(readings: DataFrame, rules: QualityRules = DEFAULT_RULES, form: str = "event_time",
                    evaluated_at: Column | None = None, **kw) -> DataFrame:
    """M7 over W1/W2: every metric row of every reading."""
    return evaluate_all(window_stats(readings, rules, form, **kw), rules, evaluated_at)


def quality_alerts(readings: DataFrame, rules: QualityRules = DEFAULT_RULES, form: str = "event_time",
                   **kw) -> DataFrame:
    """A3 over M7: one alert per failed metric."""
    return build_alerts(quality_metrics(readings, rules, form, **kw))
