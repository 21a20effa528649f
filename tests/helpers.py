"""Hand-written readings and a plain-Python replay of the per-reading window."""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import functions as F

from sensorqc.functions.timeutil import from_micros
from sensorqc.rules import DEFAULT_RULES

BASE = 1_704_067_200_000_000
SCHEMA = "seq long, sensor_id string, us long, temperature double, humidity double, wind_speed double"


def readings_df(spark, rows):
    """rows: (seq, sensor, seconds, t, h, w) -> readings DataFrame."""
    data = [(seq, s, BASE + int(round(sec * 1_000_000)), t, h, w) for seq, s, sec, t, h, w in rows]
    return spark.createDataFrame(data, SCHEMA).withColumn("timestamp", from_micros("us"))


def replay(rows, rules=DEFAULT_RULES):
    """The per-reading semantics, literally: append, then keep ts > t - window.

    rows in arrival order: (seq, sensor, us, t, h, w). Returns {seq: dict}.
    """
    W = rules.window_us
    win = defaultdict(list)
    out = {}
    for seq, s, us, t, h, w in rows:
        win[s].append((seq, us, t, h, w))
        win[s] = [p for p in win[s] if p[1] > us - W]
        pts = win[s]
        rec = {"n": len(pts), "window_start_us": pts[0][1]}
        for k, f in enumerate(("temperature", "humidity", "wind_speed")):
            vals = [p[2 + k] for p in pts]
            lo, hi = rules.range_of(f)
            rec[f"{f}_nulls"] = sum(v is None for v in vals)
            rec[f"{f}_n"] = sum(v is not None for v in vals)
            rec[f"{f}_valid"] = sum(v is not None and lo <= v <= hi for v in vals)
        pairs = jumps = 0
        for a, b in zip(pts, pts[1:]):
            if a[2] is not None and b[2] is not None:
                pairs += 1
                if abs(b[2] - a[2]) > rules.jump_limit:  # NaN compares False
                    jumps += 1
        rec["pairs"], rec["jumps"] = pairs, jumps
        out[seq] = rec
    return out


def stats_by_seq(df):
    cols = ["n", "temperature_nulls", "humidity_nulls", "wind_speed_nulls", "temperature_n", "temperature_valid",
            "humidity_n", "humidity_valid", "wind_speed_n", "wind_speed_valid", "pairs", "jumps"]
    rows = df.select("seq", *cols, F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                                     "window_start").alias("window_start_us")).collect()
    return {r.seq: {c: r[c] for c in cols + ["window_start_us"]} for r in rows}


def nan_to_none(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v
