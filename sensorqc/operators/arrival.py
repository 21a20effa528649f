"""The window in arrival order, exact under late readings.

When reading *i* arrives with event time ``t_i``, every point of the sensor
with ``ts <= t_i - 5 min`` is removed for good; all others stay, in arrival
order. With late readings this differs from the event-time frame of W1: a late
point can outlive newer ones, and a point removed by a newer reading does not
come back when an older one arrives.

Plan (batch), built so that no task holds more than one chunk of one sensor;
its size does not depend on the data and no job runs while it is built:

1. Readings are cut into chunks of consecutive arrivals: an hour of arrival
   time where the source gives one (``received_at``, the broker's time), else
   ``chunk_seqs`` arrival numbers. A hot sensor is thereby split into many
   independent units of work. This is the only shuffle of all rows.
2. The state a chunk starts with is the window at its first arrival: the
   earlier readings not yet removed. A reading survives its own chunk when no
   later reading of the chunk is a window newer (a reverse running ``max``).
   It enters every later chunk of its sensor up to the first whose newest
   reading is a window newer than it: nearly always just the next one. Each
   chunk's record (its newest time) is put in its sensor's list, where every
   chunk finds the chunks that its survivors can reach; survivors meet that
   record and are copied into those chunks as *context rows*.
3. Inside a chunk everything is native (:func:`_event_windows`): a reading's
   remover is the first later reading a window newer, and all figures are
   running sums over appends minus running sums over removals.
4. Chunks in which a reading arrives a whole window after a newer one, or with
   late readings in a row that are removed in another order, are replayed by
   :class:`ArrivalWindow` in ``mapInPandas`` instead, sorted by arrival.

A sensor's list has one entry per chunk, so an hour of arrivals each: 8,760 a
year.

The replay core, :class:`ArrivalWindow`, is also the state machine of the
streaming operator (R5).
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from sensorqc.functions.timeutil import from_micros, to_micros
from sensorqc.operators.windows import reading_flags
from sensorqc.rules import DEFAULT_RULES, QualityRules, READING_FIELDS

DEFAULT_CHUNK_SEQS = 1 << 16
DEFAULT_CHUNK_SPAN_US = 3_600_000_000

_COUNTS = ("n", "temperature_nulls", "humidity_nulls", "wind_speed_nulls",
           "temperature_n", "temperature_valid", "humidity_n", "humidity_valid",
           "wind_speed_n", "wind_speed_valid", "pairs", "jumps")


class ArrivalWindow:
    """Window of one sensor in arrival order (the per-reading semantics).

    ``push`` appends a reading, removes every point at least one window older
    than it, and returns the window's counts. Removal order comes from a heap
    on event time; adjacency from a doubly linked list in arrival order.
    """

    __slots__ = ("W", "lo", "hi", "jump", "us", "vals", "prev", "next", "head", "tail", "heap",
                 "seqs", "c", "newest")

    def __init__(self, rules: QualityRules):
        self.W = rules.window_us
        self.lo = [rules.range_of(f)[0] for f in ("temperature", "humidity", "wind_speed")]
        self.hi = [rules.range_of(f)[1] for f in ("temperature", "humidity", "wind_speed")]
        self.jump = rules.jump_limit
        self.us, self.vals, self.seqs = {}, {}, {}
        self.prev, self.next = {}, {}
        self.head = self.tail = None
        self.heap = []
        self.newest = None  # only a newer reading removes it, so it always is in the window
        # n, nulls x3, present x3, valid x3, pairs, jumps
        self.c = [0] * 12

    # -- bookkeeping -------------------------------------------------------
    def _pair(self, a, b, sign):
        ta, tb = self.vals[a][0], self.vals[b][0]
        if ta is None or tb is None:
            return
        self.c[10] += sign
        d = tb - ta
        if abs(d) > self.jump and not math.isnan(d):
            self.c[11] += sign

    def _count(self, vals, sign):
        c = self.c
        c[0] += sign
        for k, v in enumerate(vals):
            if v is None:
                c[1 + k] += sign
            else:
                c[4 + 2 * k] += sign
                if self.lo[k] <= v <= self.hi[k]:
                    c[5 + 2 * k] += sign

    def _append(self, key, seq, us, vals):
        self.us[key], self.vals[key], self.seqs[key] = us, vals, seq
        self.prev[key], self.next[key] = self.tail, None
        if self.tail is not None:
            self.next[self.tail] = key
            self._pair(self.tail, key, 1)
        else:
            self.head = key
        self.tail = key
        self._count(vals, 1)
        if self.newest is None or us > self.newest:
            self.newest = us
        heapq.heappush(self.heap, (us, seq, key))

    def _remove(self, key):
        p, q = self.prev.pop(key), self.next.pop(key)
        if p is not None:
            self._pair(p, key, -1)
            self.next[p] = q
        else:
            self.head = q
        if q is not None:
            self._pair(key, q, -1)
            self.prev[q] = p
        else:
            self.tail = p
        if p is not None and q is not None:
            self._pair(p, q, 1)
        self._count(self.vals.pop(key), -1)
        del self.us[key], self.seqs[key]

    # -- public ------------------------------------------------------------
    def load(self, seq, us, vals):
        """Add a point that is already in the window (state, context)."""
        self._append(seq, seq, us, vals)

    def push(self, seq, us, vals):
        """Arrival of a reading: append, then evict points with ts <= us - W."""
        self._append(seq, seq, us, vals)
        cutoff = us - self.W
        heap = self.heap
        while heap and heap[0][0] <= cutoff:
            _, _, key = heapq.heappop(heap)
            self._remove(key)
        return self.c, self.us[self.head]

    def points(self):
        """Points in arrival order as (seq, us, temperature, humidity, wind_speed)."""
        out, k = [], self.head
        while k is not None:
            out.append((self.seqs[k], self.us[k], *self.vals[k]))
            k = self.next[k]
        return out


def _replay_partition(rules: QualityRules, passthrough: tuple[str, ...]):
    """mapInPandas body: rows sorted by (sensor, chunk, seq), context rows first."""
    fields = ("temperature", "humidity", "wind_speed")

    def run(batches):
        current, win = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            cols = {c: pdf[c].tolist() for c in ("sensor_id", "_chunk", "seq", "us", "_own", *passthrough)}
            # Arrow turns NULL into NaN; the null flags keep NULL and NaN apart.
            fvals = [[None if isnull else v for v, isnull in zip(pdf[f].tolist(), pdf[f"_{f}_null"].tolist())]
                     for f in fields]
            out = {k: [] for k in ("seq", "sensor_id", "us", "_start_us", *_COUNTS, *passthrough)}
            for i in range(len(pdf)):
                key = (cols["sensor_id"][i], cols["_chunk"][i])
                if key != current:
                    current, win = key, ArrivalWindow(rules)
                vals = (fvals[0][i], fvals[1][i], fvals[2][i])
                seq, us = cols["seq"][i], cols["us"][i]
                if not cols["_own"][i]:
                    win.load(seq, us, vals)
                    continue
                c, start = win.push(seq, us, vals)
                out["seq"].append(seq)
                out["sensor_id"].append(key[0])
                out["us"].append(us)
                out["_start_us"].append(start)
                for name, v in zip(_COUNTS, c):
                    out[name].append(v)
                for p in passthrough:
                    out[p].append(cols[p][i])
            if out["seq"]:
                yield pd.DataFrame(out)

    return run


def arrival_chunk(readings: DataFrame, chunk_seqs: int | None, chunk_span_us: int) -> Column:
    """Chunk number of a reading; it never falls in arrival order (:func:`arrival_key`).

    By arrival time if the readings carry ``received_at`` and no ``chunk_seqs``
    is asked for, else by arrival number.
    """
    if chunk_seqs is None and "received_at" in readings.columns:
        number, length = to_micros("received_at"), int(chunk_span_us)
    else:
        number, length = F.col("seq").cast("long"), int(chunk_seqs or DEFAULT_CHUNK_SEQS)
    return F.call_function("div", number - F.pmod(number, F.lit(length)), F.lit(length))  # exact floor


def arrival_key(readings: DataFrame, chunk_seqs: int | None = None) -> Column:
    """What orders arrivals: ``received_at``, then ``seq`` (unique), or ``seq`` alone without it.

    A broker numbers the messages of each partition only, so ``seq`` alone says
    nothing over partitions; its time does.
    """
    if chunk_seqs is None and "received_at" in readings.columns:
        return F.struct(F.coalesce(to_micros("received_at"), F.lit(-(1 << 63))).alias("time"),
                        F.col("seq").cast("long").alias("seq"))
    return F.col("seq").cast("long")


def _never(key: DataType) -> Column:
    """A value that no arrival key exceeds."""
    last = F.lit((1 << 63) - 1)
    return F.struct(*[last.alias(f.name) for f in key.fields]) if isinstance(key, StructType) else last


def _reached_chunks(chunks: DataFrame, window_us: int) -> DataFrame:
    """Per sensor and chunk, the later chunks its survivors can reach (``_rest``).

    They end with the first whose newest reading is a window newer than the
    chunk's own newest, for which the next chunk is looked at first. The
    newest reading of a chunk survives it, so no list is longer than that
    reading's own context rows.
    """
    lists = chunks.groupBy("sensor_id").agg(F.sort_array(F.collect_list(F.struct("_chunk", "_cmax"))).alias("_list"))
    items = F.col("_list")

    def reach(x: Column, i: Column) -> Column:
        limit, following = x["_cmax"] + F.lit(window_us), F.get(items, i + 1)
        tail = F.slice(items, i + 2, F.size(items))
        last = F.get(F.filter(tail, lambda y: y["_cmax"] >= limit), F.lit(0))["_chunk"]
        longer = F.get(F.transform(F.array(last), lambda z: F.filter(
            tail, lambda y: z.isNull() | (y["_chunk"] <= z))), F.lit(0))
        return F.struct(x["_chunk"].alias("_chunk"),
                        F.when(following["_cmax"] >= limit, F.array(following)).otherwise(longer).alias("_rest"))

    return lists.select("sensor_id", F.explode(F.transform(items, reach)).alias("_r")).select(
        "sensor_id", F.col("_r._chunk").alias("_chunk"), F.col("_r._rest").alias("_rest")).where(F.size("_rest") > 0)


def _with_context(readings: DataFrame, window_us: int) -> DataFrame:
    """Rows of every chunk (``_own``) and the readings still in the window at its start.

    The result is partitioned by sensor and chunk. Newest times are aggregated
    before any shuffle, so that the rows themselves are shuffled once.
    """
    base = readings.repartition("sensor_id", "_chunk")
    cols = base.columns
    later = (Window.partitionBy("sensor_id", "_chunk").orderBy(F.desc("_at"))
             .rowsBetween(Window.unboundedPreceding, -1))
    survivors = (base.withColumn("_later_max", F.max("us").over(later))
                 .where(F.col("_later_max").isNull() | (F.col("_later_max") < F.col("us") + F.lit(window_us)))
                 .drop("_later_max"))
    chunks = readings.groupBy("sensor_id", "_chunk").agg(F.max("us").alias("_cmax"))
    reach = survivors.join(_reached_chunks(chunks, window_us), ["sensor_id", "_chunk"])
    removers = F.filter("_rest", lambda x: x["_cmax"] >= F.col("us") + F.lit(window_us))
    row_cols = [c for c in cols if c != "_chunk"]
    context = (reach.withColumn("_last", F.get(removers, F.lit(0))["_chunk"])
               .select(*row_cols, F.explode(F.filter(
                   "_rest", lambda x: F.col("_last").isNull() | (x["_chunk"] <= F.col("_last")))).alias("_to"))
               .select(*row_cols, F.col("_to._chunk").alias("_chunk")))
    return (base.withColumn("_own", F.lit(True)).unionByName(
        context.withColumn("_own", F.lit(False)).repartition("sensor_id", "_chunk")))


def _removal_order(rows: DataFrame, rules: QualityRules) -> DataFrame:
    """Each row's remover, its left neighbours, and whether its chunk must be replayed.

    ``_gone`` is the arrival key of the first reading a window newer (the
    largest key: none). A row is a *dent* when it goes before one that
    arrived earlier; the others go in arrival order. The pairs a row can form
    with rows before it are two: with the last row before it that is no dent
    (``_f1``: from its arrival or, after a dent, from when that dent is gone),
    and with a dent right before it (``_f2``). That holds as long as dents in a row go in
    arrival order, too; else, or if a remover arrived before the row, ``_replay``.
    """
    key = Window.partitionBy("sensor_id", "_chunk")
    newer = key.orderBy("_neg_us").rangeBetween(Window.unboundedPreceding, -rules.window_us)
    arrived = key.orderBy("_at")
    before = arrived.rowsBetween(Window.unboundedPreceding, -1)
    never = _never(rows.schema["_at"].dataType)
    t = F.col("temperature")

    def pair(left: Column) -> tuple[Column, Column]:
        diff = t - left
        both = t.isNotNull() & left.isNotNull()
        return both, both & (F.abs(diff) > F.lit(rules.jump_limit)) & ~F.isnan(diff)

    gone = (rows.withColumn("_neg_us", -F.col("us"))
            .withColumn("_gone", F.coalesce(F.min(F.when(F.col("_own"), F.col("_at"))).over(newer), never))
            .withColumn("_dent", F.coalesce(F.col("_gone") < F.max("_gone").over(before), F.lit(False))))
    near = gone.select("*", F.lag(F.struct("_dent", "_gone", F.col("temperature").alias("t"))).over(arrived).alias("_p"),
                       F.last(F.when(~F.col("_dent"), F.struct("_gone", F.col("temperature").alias("t"))),
                              ignorenulls=True).over(before).alias("_a"))
    after_dent = F.coalesce(F.col("_p._dent"), F.lit(False))
    # The first pair begins with the row or, where that is later, with the removal of the dent before it.
    waits = after_dent & (F.col("_p._gone") > F.col("_at"))
    begins = F.when(waits, F.col("_p._gone")).otherwise(F.col("_at"))
    lives1 = F.col("_a").isNotNull() & (begins < F.least("_a._gone", "_gone"))
    lives2 = after_dent & (F.col("_at") < F.col("_p._gone"))
    (pair1, jump1), (pair2, jump2) = pair(F.col("_a.t")), pair(F.col("_p.t"))
    as_long = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    odd = (F.col("_gone") < F.col("_at")) | (F.col("_dent") & after_dent & (F.col("_gone") < F.col("_p._gone")))
    return (near.select("*", waits.alias("_waits"),
                        *[as_long(c).alias(n) for n, c in (
                            ("_f1_pairs", lives1 & pair1), ("_f1_jumps", lives1 & jump1),
                            ("_f2_pairs", lives2 & pair2), ("_f2_jumps", lives2 & jump2))],
                        as_long(odd).alias("_odd"))
            .withColumn("_replay", F.max("_odd").over(key) > 0)
            .drop("_neg_us", "_p", "_a", "_odd"))


def _event_windows(rows: DataFrame, rules: QualityRules) -> DataFrame:
    """Window statistics of chunks that need no replay, all by running sums.

    A figure is what rows up to this one added when they arrived, plus what
    those gone by now changed when they went. The rows gone at a reading are
    those a window older than the newest own reading so far, hence a running sum in time
    order at that newest reading, carried on in arrival order. The first point
    in the window never is a dent: it follows the last one gone that was none.
    """
    key = Window.partitionBy("sensor_id", "_chunk")
    arrived = key.orderBy("_at")
    upto = arrived.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    older = key.orderBy("us").rangeBetween(Window.unboundedPreceding, -rules.window_us)

    dent, nothing = F.col("_dent"), F.lit(0)
    linked = ["_waits", "_f1_pairs", "_f1_jumps", "_f2_pairs", "_f2_jumps"]
    next_kept = F.expr("lead(if(_dent, null, struct(us, _f1_pairs, _f1_jumps))) ignore nulls "
                       "over (partition by sensor_id, _chunk order by _at)")
    near = rows.select("*", *reading_flags(rules),
                       F.lead(F.struct(*linked)).over(arrived).alias("_q"), next_kept.alias("_b"))
    adds = {"n": F.lit(1)}
    leaves = {"n": F.lit(1)}
    for f in READING_FIELDS:
        adds[f"{f}_nulls"] = leaves[f"{f}_nulls"] = F.col(f"_{f}_null")
        adds[f"{f}_valid"] = leaves[f"{f}_valid"] = F.col(f"_{f}_ok")
    for k in ("pairs", "jumps"):
        first, second = F.col(f"_f1_{k}"), F.col(f"_f2_{k}")
        next_first = F.when(F.col("_q._waits"), F.col(f"_q._f1_{k}")).otherwise(nothing)
        adds[k] = F.when(F.col("_waits"), nothing).otherwise(first) + second
        # A dent takes its pairs along, and the row after it gets its first pair; another row, its pair with the next.
        leaves[k] = F.when(dent, first + F.coalesce(F.col(f"_q._f2_{k}"), nothing) - F.coalesce(next_first, nothing)
                           ).otherwise(F.coalesce(F.col(f"_b._f1_{k}"), nothing))
    gone = near.select(
        "*", *[c.alias(f"_in_{k}") for k, c in adds.items()], *[c.alias(f"_out_{k}") for k, c in leaves.items()],
    ).select("*", F.when(F.col("_own"), F.struct(
        "us", *[F.coalesce(F.sum(f"_out_{k}").over(older), nothing).alias(k) for k in leaves],
        F.max(F.when(~dent, F.struct("_at", F.col("_b.us").alias("start")))).over(older)["start"].alias("start"),
    )).alias("_left"))
    stats = gone.select(
        "*", F.max("_left").over(upto).alias("_now"), F.first("us").over(upto).alias("_first_us"),
        *[F.sum(f"_in_{k}").over(upto).alias(f"_sum_{k}") for k in adds]).where(F.col("_own"))
    now = {k: F.col(f"_sum_{k}") - F.col(f"_now.{k}") for k in adds}
    for f in READING_FIELDS:
        now[f"{f}_n"] = now["n"] - now[f"{f}_nulls"]
    return stats.select("seq", "sensor_id", *_passthrough(rows), "us",
                        F.coalesce("_now.start", "_first_us").alias("_start_us"),
                        *[now[c].alias(c) for c in _COUNTS])


def _replayed_windows(rows: DataFrame, rules: QualityRules) -> DataFrame:
    """The same by :class:`ArrivalWindow`, partition by partition in arrival order."""
    passthrough = _passthrough(rows)
    schema = StructType(
        [StructField("seq", LongType()), StructField("sensor_id", StringType()), StructField("us", LongType()),
         StructField("_start_us", LongType())]
        + [StructField(c, LongType()) for c in _COUNTS]
        + [StructField(p, StringType()) for p in passthrough])
    flagged = rows.select("seq", "sensor_id", *passthrough, "us", *READING_FIELDS, "_chunk", "_own", "_at",
                          *[F.col(f).isNull().alias(f"_{f}_null") for f in READING_FIELDS])
    return (flagged.sortWithinPartitions("sensor_id", "_chunk", "_at").drop("_at")
            .mapInPandas(_replay_partition(rules, passthrough), schema))


def _passthrough(readings: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in readings.columns if c in ("area",))


def arrival_window(readings: DataFrame, rules: QualityRules = DEFAULT_RULES,
                   chunk_seqs: int | None = None, chunk_span_us: int = DEFAULT_CHUNK_SPAN_US) -> DataFrame:
    """Window statistics per reading in arrival order (:func:`arrival_key`).

    Same output columns as :func:`sensorqc.operators.windows.trailing_window`;
    ``window_start`` is the first point in arrival order: by ``received_at`` and then
    ``seq``, or by ``seq`` alone where there is no ``received_at`` or ``chunk_seqs`` is given.
    Readings without a sensor, which P2 rejects, belong to no window.
    """
    passthrough = _passthrough(readings)
    base = readings.select(
        "seq", "sensor_id", *passthrough, "us", *READING_FIELDS, arrival_key(readings, chunk_seqs).alias("_at"),
        F.coalesce(arrival_chunk(readings, chunk_seqs, chunk_span_us), F.lit(-(1 << 63))).alias("_chunk"),
    ).where(F.col("sensor_id").isNotNull())
    rows = _removal_order(_with_context(base, rules.window_us), rules)
    stats = _event_windows(rows.where(~F.col("_replay")), rules).unionByName(
        _replayed_windows(rows.where("_replay"), rules))
    cols = ["seq", "sensor_id", *passthrough, "us", F.col("_ts").alias("timestamp"), *_COUNTS,
            from_micros("_start_us").alias("window_start"), F.col("_ts").alias("window_end")]
    return stats.withColumn("_ts", from_micros("us")).select(*cols)
