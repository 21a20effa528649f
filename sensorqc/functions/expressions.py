"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorqc.functions import texts
from sensorqc.rules import METRIC_NAMES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status(passed: Column) -> Column:
    """M8: 'PASS' when the predicate holds, else 'FAIL' (WARN is never made)."""
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _nearest_tie(a: Column, digits: int) -> tuple[Column, Column]:
    """(n, side): the tie n / (2 * 10**digits) nearest to a, and the sign of a minus the tie.

    The factor is a sum of powers of two (20 = 16 + 4, 200 = 128 + 64 + 8).
    Taken from n one by one, largest first, each product is exact and lies
    within a factor of two of what is left, so each difference is exact too.
    """
    powers = [1 << i for i in range(12, -1, -1) if 2 * 10 ** digits >> i & 1]
    n = F.round(a * F.lit(2.0 * 10 ** digits))
    left = n
    for power in powers[:-1]:
        left = left - a * F.lit(float(power))
    return n, F.signum(a * F.lit(float(powers[-1])) - left)


def py_fixed(value: Column | str, digits: int) -> Column:
    """``f"{v:.{digits}f}"`` as Python prints it: the binary value, half to even.

    A decimal text that is a tie (0.05, 2.675) need not be one as a binary
    value; on which side of the tie that lies is decided exactly, for one or
    two digits. NaN, infinities and values from 1e12 go to Java's formatter.
    """
    value = _col(value)
    a = F.abs(value)
    n, side = _nearest_tie(a, digits)
    tie = (n % 2 == 1) & (n / F.lit(2.0 * 10 ** digits) == a)
    rounded = F.bround(F.when(tie, (n + side) / F.lit(2.0 * 10 ** digits)).otherwise(a), digits)
    text = rounded.cast(f"decimal(38,{digits})").cast("string")
    return (F.when(F.isnan(value) | (a >= F.lit(1e12)), F.format_string(f"%.{digits}f", value))
            .when((value < 0) | (value.cast("string") == "-0.0"), F.concat(F.lit("-"), text))  # Python keeps "-0.0"
            .otherwise(text))


def alert_severity(metric_name: Column | str = "metric_name",
                   value: Column | str = "metric_value") -> Column:
    """A1: severity of one failed metric from its name and value."""
    name, v = _col(metric_name), _col(value)
    return (
        F.when((name == "completeness") & (v < 50), F.lit("CRITICAL"))
        .when((name == "timeliness") & (v < 70), F.lit("HIGH"))
        .when(name.contains("validity") & (v < 80), F.lit("HIGH"))
        .when((name == "consistency") & (v < 60), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def severity_rank(severity: Column | str = "severity") -> Column:
    """Enum ordinal (LOW=1 .. CRITICAL=4); order by this, never by the text."""
    sev = _col(severity)
    expr = F.lit(None).cast("int")
    for rank, name in reversed(list(enumerate(texts.SEVERITIES, start=1))):
        expr = F.when(sev == name, F.lit(rank)).otherwise(expr)
    return expr


def count_severity(fail_count: Column | str) -> Column:
    """A5: notification severity from the number of failures it carries."""
    n = _col(fail_count)
    return (
        F.when(n >= 3, F.lit("CRITICAL"))
        .when(n >= 2, F.lit("HIGH"))
        .when(n >= 1, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def metric_order(metric_name: Column | str = "metric_name") -> Column:
    """Place of a metric in the evaluation order; last when unknown."""
    names = F.array(*[F.lit(m) for m in METRIC_NAMES])
    at = F.array_position(names, _col(metric_name))
    return F.when(at > 0, at - 1).otherwise(F.lit(len(METRIC_NAMES))).cast("int")


def _lookup(key: Column, table: dict[str, str], default: str) -> Column:
    return reduce(
        lambda acc, kv: acc.when(key == kv[0], F.lit(kv[1])),
        list(table.items())[1:],
        F.when(key == list(table)[0], F.lit(table[list(table)[0]])),
    ).otherwise(F.lit(default))


def severity_color(severity: Column | str = "severity") -> Column:
    """Attachment colour of a severity, 'warning' when unknown."""
    return _lookup(_col(severity), texts.SEVERITY_COLORS, texts.SEVERITY_COLOR_DEFAULT)


def alert_emoji(alert_type: Column | str = "alert_type") -> Column:
    """Emoji of an alert type, 'ℹ️' when unknown."""
    return _lookup(_col(alert_type), texts.ALERT_EMOJIS, texts.ALERT_EMOJI_DEFAULT)


def fill(template: str, **values: Column) -> Column:
    """A text template with ``{key}`` places filled by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[x] if i % 2 else F.lit(x) for i, x in enumerate(parts) if i % 2 or x])


def alert_message(metric_name: Column | str = "metric_name",
                  value: Column | str = "metric_value",
                  threshold: Column | str = "threshold") -> Column:
    """A2: alert text of one failed metric, numbers with one decimal."""
    name = _col(metric_name)
    v, t = py_fixed(value, 1), py_fixed(threshold, 1)

    render = lambda template: fill(template, v=v, t=t, name=name)
    expr = None
    for metric, template in texts.ALERT_MESSAGES.items():
        expr = (F.when if expr is None else expr.when)(name == metric, render(template))
    return expr.otherwise(render(texts.ALERT_MESSAGE_DEFAULT))


def metric_title(metric_name: Column | str = "metric_name") -> Column:
    """'wind_speed_validity' -> 'Wind Speed Validity' (replace + title case)."""
    return F.initcap(F.regexp_replace(_col(metric_name), "_", " "))


def score_band(value: Column | str) -> Column:
    """Dashboard colour of a percentage score (red < 80 <= yellow < 95)."""
    v = _col(value)
    expr = None
    for name, upper in texts.SCORE_BANDS:
        if upper is None:
            return expr.otherwise(F.lit(name))
        expr = (F.when if expr is None else expr.when)(v < upper, F.lit(name))
    return expr
