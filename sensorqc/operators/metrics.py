"""M1–M8: quality metrics from window statistics (W1 or W2 output).

Each metric is a struct expression over one row of window statistics; the
single-metric operators and :func:`evaluate_all` share them, so all metrics of
an evaluation come out of one projection (``inline`` of an array of structs:
one scan, no union, no extra shuffle).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorqc.functions.expressions import status
from sensorqc.functions.timeutil import minus
from sensorqc.rules import (
    DEFAULT_RULES,
    METRIC_NAMES,
    SHORT_WINDOW_SPAN_MINUTES,
    QualityRules,
)

METRIC_COLUMNS = ("seq", "sensor_id", "timestamp", "metric_name", "metric_order",
                  "metric_value", "threshold", "status", "window_start", "window_end")


def _metric(name: str, value: Column, threshold: Column | float, passed: Column,
            start: Column | None = None, end: Column | None = None) -> Column:
    """One metric as a struct; a NULL value means "no metric row"."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.struct(
        F.lit(name).alias("metric_name"),
        F.lit(METRIC_NAMES.index(name)).alias("metric_order"),
        value.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold"),
        status(passed).alias("status"),
        (start if start is not None else F.col("window_start")).alias("window_start"),
        (end if end is not None else F.col("window_end")).alias("window_end"),
    )


def completeness_struct(rules: QualityRules = DEFAULT_RULES) -> Column:
    """M1: share of present fields; passes while missing% <= limit."""
    n = F.col("n")
    missing = F.col("temperature_nulls") + F.col("humidity_nulls") + F.col("wind_speed_nulls")
    missing_pct = (missing / (n * 3)) * 100
    return _metric(
        "completeness",
        F.lit(100) - missing_pct,
        100 - rules.max_missing_percent,
        missing_pct <= F.lit(rules.max_missing_percent),
    )


def validity_struct(field: str, rules: QualityRules = DEFAULT_RULES) -> Column:
    """M2–M4: in-range share of the present values of one field.

    The value is NULL (no metric row) when the field has no present value.
    """
    cnt, ok = F.col(f"{field}_n"), F.col(f"{field}_valid")
    rate = F.when(cnt > 0, (ok / cnt) * 100)
    return _metric(f"{field}_validity", rate, rules.validity_threshold,
                   rate >= F.lit(rules.validity_threshold))


def timeliness_struct(rules: QualityRules = DEFAULT_RULES) -> Column:
    """M5: received / expected readings, capped at 100."""
    rate = F.least((F.col("n") / F.lit(rules.expected_points)) * 100, F.lit(100.0))
    return _metric("timeliness", rate, rules.timeliness_threshold,
                   rate >= F.lit(rules.timeliness_threshold))


def consistency_struct(rules: QualityRules = DEFAULT_RULES,
                       evaluated_at: Column | None = None) -> Column:
    """M6: share of adjacent temperature pairs without a jump.

    No pair -> 100. Fewer than two readings -> 100/PASS with a five-minute
    span ending at the evaluation time instead of the window bounds.
    """
    at = evaluated_at if evaluated_at is not None else F.col("timestamp")
    pairs, jumps = F.col("pairs"), F.col("jumps")
    rate = F.when(pairs > 0, ((pairs - jumps) / pairs) * 100).otherwise(F.lit(100.0))
    short = F.col("n") < 2
    return _metric(
        "consistency",
        F.when(short, F.lit(100.0)).otherwise(rate),
        rules.consistency_threshold,
        short | (rate >= F.lit(rules.consistency_threshold)),
        start=F.when(short, minus(at, timedelta(minutes=SHORT_WINDOW_SPAN_MINUTES))).otherwise(F.col("window_start")),
        end=F.when(short, at).otherwise(F.col("window_end")),
    )


def metric_structs(rules: QualityRules = DEFAULT_RULES,
                   evaluated_at: Column | None = None) -> dict[str, Column]:
    return {
        "completeness": completeness_struct(rules),
        "temperature_validity": validity_struct("temperature", rules),
        "humidity_validity": validity_struct("humidity", rules),
        "wind_speed_validity": validity_struct("wind_speed", rules),
        "timeliness": timeliness_struct(rules),
        "consistency": consistency_struct(rules, evaluated_at),
    }


def _long_form(stats: DataFrame, structs: list[Column], evaluated_at: Column | None) -> DataFrame:
    at = evaluated_at if evaluated_at is not None else F.col("timestamp")
    keep = [c for c in ("area",) if c in stats.columns]
    return (
        stats.select("seq", "sensor_id", *keep, at.alias("timestamp"),
                     F.inline(F.array(*structs)))
        .where(F.col("metric_value").isNotNull())
        .select(*METRIC_COLUMNS[:3], *keep, *METRIC_COLUMNS[3:])
    )


def evaluate_metrics(stats: DataFrame, names: tuple[str, ...] | list[str],
                     rules: QualityRules = DEFAULT_RULES,
                     evaluated_at: Column | None = None) -> DataFrame:
    """Long-form metric rows of the named metrics, in evaluation order."""
    structs = metric_structs(rules, evaluated_at)
    return _long_form(stats, [structs[n] for n in METRIC_NAMES if n in names], evaluated_at)


def evaluate_all(stats: DataFrame, rules: QualityRules = DEFAULT_RULES,
                 evaluated_at: Column | None = None) -> DataFrame:
    """M7: all metrics of every evaluation (3 to 6 rows per reading).

    ``evaluated_at`` is the metric timestamp; by default the reading's own
    time (batch). Streams pass ``current_timestamp()``-like columns.
    """
    return evaluate_metrics(stats, METRIC_NAMES, rules, evaluated_at)
