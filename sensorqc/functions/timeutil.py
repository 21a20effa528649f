"""Timestamp helpers that do not depend on the session time zone.

Readings carry naive wall-clock times, so the library works in
``TIMESTAMP_NTZ`` and in integer microseconds (``us``). Conversions go
through NTZ interval arithmetic, never through the session zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_literal(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (folded by Catalyst, pushable to Parquet)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


def to_micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a NTZ (or LTZ) timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_SQL), ts.cast("timestamp_ntz"))


def from_micros(us: Column | str) -> Column:
    """TIMESTAMP_NTZ from microseconds since 1970-01-01."""
    us = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH_SQL))


def minus(ts: Column, delta: timedelta) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(-int(delta / timedelta(microseconds=1))), ts)


def iso_format(ts: Column | str) -> Column:
    """ISO-8601 text as Python's ``datetime.isoformat()`` writes it.

    The fraction ``.ffffff`` is left out when the microseconds are zero.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.pmod(to_micros(ts), F.lit(1_000_000)) == 0, whole).otherwise(frac)


def lower_bound(as_of: datetime | None, hours: float | None = None,
                minutes: float | None = None) -> Column:
    """``as_of - lookback`` as a NTZ column; ``as_of=None`` means now."""
    delta = timedelta(hours=hours or 0, minutes=minutes or 0)
    if as_of is None:
        return minus(F.localtimestamp(), delta)
    return ntz_literal(as_of - delta)
