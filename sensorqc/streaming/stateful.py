"""Per-reading quality in a stream, with keyed state per sensor.

``transformWithStateInPandas`` keeps each sensor's window (the points not yet
removed, in arrival order) in a ``ListState`` on the RocksDB state store. Each
micro-batch of a sensor is sorted by arrival (``received_at``, then ``seq``) and replayed on the
:class:`~sensorqc.operators.arrival.ArrivalWindow` state machine, so late
readings are never dropped and results equal the batch W2 form.

Each sensor's state is bounded by the window: every arrival evicts the points
a window older than it. By default state is keyed by buckets of sensors, and
sensors that have been silent for a day (``idle_us``) are dropped from it. A
sensor with a row in the micro-batch is never dropped, however old its points;
for every sensor the bucket's clock at its last row is kept, and it is silent
when that lies ``idle_us`` behind the clock. With a
``received_at`` column the clock is the latest arrival time, so a backlog may
take any number of micro-batches and stamps from the future change nothing. Without one
its newest point must lie that far behind, too (or ahead, then it is no time at all),
and the clock is the lower median of the
sensors' newest points, never going back (a lower median, so that one sensor
with a clock ahead moves nothing, also in a bucket of two); there a sensor
whose backlog came before the bucket knew the present time can be dropped
between two of its uploads. The measure is in the data and the state alone, so
replays and backfills give the same results. Points that old only matter to
readings that are themselves later than that.

Keys per sensor (``state_buckets=None``) can expire idle keys by processing
time only (``idle_timeout_ms``, off by default), as a silent key is not called
otherwise; that mode's housekeeping batches keep an ``availableNow`` query from
ending.

A key's rows of one micro-batch are sorted in one frame, as a keyed store
requires; the source bounds a batch (``maxOffsetsPerTrigger``). The shuffle is
by the key only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorqc.functions.timeutil import from_micros, to_micros
from sensorqc.operators.arrival import _COUNTS, ArrivalWindow
from sensorqc.rules import DEFAULT_RULES, QualityRules

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SCHEMA = "seq long, us long, temperature double, humidity double, wind_speed double"
FIELDS = ("temperature", "humidity", "wind_speed")
OUTPUT_SCHEMA = ("seq long, sensor_id string, area string, us long, temperature double, humidity double, "
                 "wind_speed double, _start_us long, " + ", ".join(f"{c} long" for c in _COUNTS))
DEFAULT_IDLE_TIMEOUT_MS = None
DEFAULT_STATE_BUCKETS = 64
DEFAULT_IDLE_US = 86_400_000_000  # a day


def in_arrival_order(pdf: pd.DataFrame, *first: str) -> pd.DataFrame:
    """Rows by ``first``, time of arrival (unknown first) and arrival number."""
    keys = [*first, *(["arrived_us"] if pdf["arrived_us"].notna().any() else []), "seq"]
    if not first and all(pdf[k].is_monotonic_increasing for k in keys):
        return pdf
    return pdf.sort_values(keys, kind="stable", na_position="first")


class ArrivalQualityProcessor(StatefulProcessor):
    """Keyed by sensor: replays new readings on the stored window."""

    def __init__(self, rules: QualityRules = DEFAULT_RULES, idle_timeout_ms: int | None = DEFAULT_IDLE_TIMEOUT_MS):
        self.rules = rules
        self.idle_timeout_ms = idle_timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", STATE_SCHEMA, self.idle_timeout_ms)

    def handleInputRows(self, key, rows, timerValues):
        pdf = in_arrival_order(pd.concat(list(rows), ignore_index=True))
        win = ArrivalWindow(self.rules)
        for seq, us, t, h, w in self.points.get():  # empty for a new sensor
            win.load(seq, us, (t, h, w))
        fvals = [[None if isnull else v for v, isnull in zip(pdf[f].tolist(), pdf[f"{f}_isnull"].tolist())]
                 for f in FIELDS]
        out = {k: [] for k in ("seq", "us", "_start_us", "area", *FIELDS, *_COUNTS)}
        areas = pdf["area"].tolist() if "area" in pdf.columns else [None] * len(pdf)
        for i, (seq, us) in enumerate(zip(pdf["seq"].tolist(), pdf["us"].tolist())):
            vals = (fvals[0][i], fvals[1][i], fvals[2][i])
            c, start = win.push(seq, us, vals)
            out["seq"].append(seq)
            out["us"].append(us)
            out["_start_us"].append(start)
            out["area"].append(areas[i])
            for f, v in zip(FIELDS, vals):
                out[f].append(v)
            for name, v in zip(_COUNTS, c):
                out[name].append(v)
        self.points.put(win.points())
        res = pd.DataFrame(out)
        res.insert(1, "sensor_id", key[0])
        yield res[[c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]]

    def close(self) -> None:
        pass


GROUP_STATE_SCHEMA = ("seq array<long>, us array<long>, temperature array<double>, humidity array<double>, "
                      "wind_speed array<double>")


def _group_state_fn(rules: QualityRules, idle_timeout_ms: int | None):
    """``applyInPandasWithState`` body: the window travels with the key's rows
    (no state-server round trip per key), stored as parallel arrays."""
    columns = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]

    def fn(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({c: [] for c in columns})
            return
        win = ArrivalWindow(rules)
        if state.exists:
            for seq, us, t, h, w in zip(*state.get):
                win.load(seq, us, (t, h, w))
        parts = list(batches)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        pdf = in_arrival_order(pdf)
        seqs, uss = pdf["seq"].tolist(), pdf["us"].tolist()
        fvals = [[None if isnull else v for v, isnull in zip(pdf[f].tolist(), pdf[f"{f}_isnull"].tolist())]
                 for f in FIELDS]
        starts, counts = [], []
        for seq, us, t, h, w in zip(seqs, uss, *fvals):
            c, start = win.push(seq, us, (t, h, w))
            starts.append(start)
            counts.append(tuple(c))
        pts = win.points()
        state.update(tuple(list(col) for col in zip(*pts)) if pts else ([], [], [], [], []))
        if idle_timeout_ms:
            state.setTimeoutDuration(idle_timeout_ms)
        out = {"seq": seqs, "sensor_id": [key[0]] * len(seqs), "area": pdf["area"].tolist(), "us": uss,
               "temperature": fvals[0], "humidity": fvals[1], "wind_speed": fvals[2], "_start_us": starts}
        for name, col in zip(_COUNTS, zip(*counts)):
            out[name] = list(col)
        yield pd.DataFrame(out, columns=columns)

    return fn


BUCKET_STATE_SCHEMA = ("sensor_id array<string>, seq array<long>, us array<long>, temperature array<double>, "
                       "humidity array<double>, wind_speed array<double>, name array<string>, seen array<long>, "
                       "clock long")


def _newest(wins: dict[str, ArrivalWindow]) -> dict[str, int | None]:
    return {sid: win.newest for sid, win in wins.items()}


def lower_median(newest: dict[str, int | None]) -> int | None:
    times = sorted(us for us in newest.values() if us is not None)
    return times[(len(times) - 1) // 2] if times else None


def drop_silent(wins: dict[str, ArrivalWindow], idle_us: int, seen: dict[str, int] | None = None,
                clock: int | None = None, reported: frozenset[str] | set[str] = frozenset(),
                by_arrival: bool = False) -> None:
    """Forgets windows of sensors last seen ``idle_us`` before ``clock``, but of none that has reported.

    Without ``seen`` a sensor was last seen at its newest point, without
    ``clock`` it is the lower median of these. ``by_arrival`` tells that the
    clock is arrival time, next to which the points' own times do not count;
    nor do they where they lie more than ``idle_us`` ahead of the clock.
    """
    newest = _newest(wins)
    clock = lower_median(newest) if clock is None else clock
    for sid, us in newest.items():
        if sid in reported:
            continue
        last = (seen or {}).get(sid)
        if us is not None and (last is None or not by_arrival and last < us <= clock + idle_us):
            last = us
        if last is None or last < clock - idle_us:
            del wins[sid]


def _bucket_state_fn(rules: QualityRules, idle_us: int):
    """Keyed by a bucket of sensors: one call per bucket and micro-batch, the
    bucket's windows (all its sensors) stored as parallel arrays."""
    columns = [c.split()[0] for c in OUTPUT_SCHEMA.split(", ")]

    def fn(key, batches, state):
        wins: dict[str, ArrivalWindow] = {}
        seen: dict[str, int] = {}
        clock = None
        if state.exists:
            *points, names, times, clock = state.get
            seen = dict(zip(names, times))
            for sid, seq, us, t, h, w in zip(*points):
                win = wins.get(sid)
                if win is None:
                    win = wins[sid] = ArrivalWindow(rules)
                win.load(seq, us, (t, h, w))
        parts = list(batches)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        pdf = in_arrival_order(pdf, "sensor_id")
        sids, seqs, uss = pdf["sensor_id"].tolist(), pdf["seq"].tolist(), pdf["us"].tolist()
        fvals = [[None if isnull else v for v, isnull in zip(pdf[f].tolist(), pdf[f"{f}_isnull"].tolist())]
                 for f in FIELDS]
        starts, counts = [], []
        for sid, seq, us, t, h, w in zip(sids, seqs, uss, *fvals):
            win = wins.get(sid)
            if win is None:
                win = wins[sid] = ArrivalWindow(rules)
            c, start = win.push(seq, us, (t, h, w))
            starts.append(start)
            counts.append(tuple(c))
        arrived = pdf["arrived_us"].dropna()
        present = int(arrived.max()) if len(arrived) else lower_median(_newest(wins))
        clock = present if clock is None else max(clock, present)
        reported = set(sids)
        seen |= dict.fromkeys(reported, clock)
        drop_silent(wins, idle_us, seen, clock, reported, by_arrival=len(arrived) > 0)
        seen = {sid: t for sid, t in seen.items() if sid in wins}
        cols = ([], [], [], [], [], [])
        for sid, win in wins.items():
            for seq, us, t, h, w in win.points():
                for col, v in zip(cols, (sid, seq, us, t, h, w)):
                    col.append(v)
        state.update((*cols, list(seen), list(seen.values()), clock))
        out = {"seq": seqs, "sensor_id": sids, "area": pdf["area"].tolist(), "us": uss,
               "temperature": fvals[0], "humidity": fvals[1], "wind_speed": fvals[2], "_start_us": starts}
        for name, col in zip(_COUNTS, zip(*counts)):
            out[name] = list(col)
        yield pd.DataFrame(out, columns=columns)

    return fn


def use_rocksdb(spark) -> None:
    """Keyed state for ``transformWithState`` lives in RocksDB (spills to disk)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stateful_quality(readings: DataFrame, rules: QualityRules = DEFAULT_RULES,
                     idle_timeout_ms: int | None = DEFAULT_IDLE_TIMEOUT_MS, engine: str = "group_state",
                     state_buckets: int | None = DEFAULT_STATE_BUCKETS,
                     idle_us: int = DEFAULT_IDLE_US) -> DataFrame:
    """Window statistics per arriving reading (W2 semantics) on a stream.

    Output: the W2 columns plus the reading's three fields (for the raw table).
    ``state_buckets=B`` (default 64) keys the state by ``hash(sensor_id) mod B``:
    one call per bucket and batch. The whole bucket's state is rewritten when
    any of its sensors reports, which costs nothing extra when most sensors
    report in every batch; pick B so that a bucket holds a few hundred sensors
    at most. ``state_buckets=None`` keys by sensor: ``engine='group_state'`` runs
    ``applyInPandasWithState``; ``engine='transform'`` runs
    ``transformWithStateInPandas`` with a ``ListState`` (one state-server round
    trip per key and batch).
    """
    use_rocksdb(readings.sparkSession)
    area = F.col("area") if "area" in readings.columns else F.lit(None).cast("string")
    arrived = to_micros(F.col("received_at")) if "received_at" in readings.columns else F.lit(None).cast("long")
    prepared = readings.select(
        "seq", "sensor_id", area.alias("area"), "us", arrived.alias("arrived_us"), *FIELDS,
        *[F.col(f).isNull().alias(f"{f}_isnull") for f in FIELDS])
    if state_buckets and engine == "group_state":
        bucket = F.pmod(F.xxhash64("sensor_id"), F.lit(state_buckets)).alias("_state_bucket")
        stats = prepared.select("*", bucket).groupBy("_state_bucket").applyInPandasWithState(
            _bucket_state_fn(rules, idle_us), OUTPUT_SCHEMA, BUCKET_STATE_SCHEMA, "append", "NoTimeout")
    elif engine == "transform":
        stats = prepared.groupBy("sensor_id").transformWithStateInPandas(
            statefulProcessor=ArrivalQualityProcessor(rules, idle_timeout_ms),
            outputStructType=OUTPUT_SCHEMA, outputMode="Append",
            timeMode="ProcessingTime" if idle_timeout_ms else "None")
    else:
        stats = prepared.groupBy("sensor_id").applyInPandasWithState(
            _group_state_fn(rules, idle_timeout_ms), OUTPUT_SCHEMA, GROUP_STATE_SCHEMA, "append",
            "ProcessingTimeTimeout" if idle_timeout_ms else "NoTimeout")
    ts = from_micros("us")
    return stats.select(
        "seq", "sensor_id", "area", "us", ts.alias("timestamp"), *FIELDS, *_COUNTS,
        from_micros("_start_us").alias("window_start"), ts.alias("window_end"))

