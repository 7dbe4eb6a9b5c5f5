"""A2, A3, T7, T8 live: the legacy windowed rule as one event-time operator.

Per sensor, an event-time window feeds a look-back list, and the list's state
decides about the open episode.  Readings of both inputs wait in the state
until the watermark has passed them, because only then can no earlier one
still come; then they are applied in time order, as the batch form applies
them:

* a presence reading goes into its tumbling window; a window fires at its
  end, before a reading of that instant;
* a fire is added to the look-back list, from which items ``look_back_s`` old
  or older (by their latest reading) are evicted;
* a fire with the lamp on (P7) and nobody present in the look-back opens, and
  overwrites an open episode; an off reading closes and emits.

Sensors are dealt to ``SHARDS`` groups by a hash of their key; a group's state
holds, column by column, for each of its sensors: the readings that the
watermark has not passed yet (as many as arrive within the allowed disorder
and one micro-batch), one open window, ``look_back_s / width_s`` look-back
items and one, the latest actuator reading and the open episode.  So a
micro-batch costs one call per group, not per sensor.  A reading is shuffled
once.  Readings behind the
watermark are dropped by the engine; ``job.split_late`` shows them.  The rule
reads occupancy only, so the lux fold of the batch form is not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampwatch import labels as L
from lampwatch.functions import timefns as tf
from lampwatch.operators import episodes as E
from lampwatch.operators.legacy import closed_columns
from lampwatch.streaming.processor import SHARDS

US = 1_000_000


def _columns(prefix: str, **types: T.DataType) -> list:
    return [T.StructField(prefix + n, T.ArrayType(t)) for n, t in types.items()]


#: the sensors; per waiting reading and per look-back item the sensor's number; times in microseconds.
#: A window is its end, the time of its latest reading, whether anybody was present
STATE = T.StructType([
    *_columns("", keys=T.StringType(), window_end=T.LongType(), window_last=T.LongType(),
              window_occupied=T.BooleanType(), a_ts=T.LongType(), a_level=T.DoubleType(), start_ts=T.LongType()),
    *_columns("item_", at=T.IntegerType(), end=T.LongType(), last=T.LongType(), occupied=T.BooleanType()),
    *_columns("wait_", at=T.IntegerType(), t=T.LongType(), src=T.IntegerType(), id=T.LongType(),
              level=T.DoubleType(), occupied=T.BooleanType())])
WAIT = {"at": np.int64, "t": np.int64, "src": np.int64, "id": np.int64, "level": np.float64, "occupied": np.bool_}
OUTPUT = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("start_us", T.LongType()),
    T.StructField("finish_us", T.LongType())])


class Rule:
    """The rule's state of one sensor."""

    def __init__(self, width_s: int, look_back_s: int, window=None, items=(), a_ts=None, a_level=None, start_ts=None):
        self.width, self.look_back = width_s * US, look_back_s * US
        self.window = tuple(window) if window else None
        self.items = [tuple(i) for i in items]
        self.a_ts, self.a_level, self.start_ts = a_ts, a_level, start_ts

    def fire(self, until: int) -> None:
        """Close the open window if it ends by ``until``."""
        if self.window is None or self.window[0] > until:
            return
        last = self.window[1]
        self.items = [i for i in self.items if last - i[1] < self.look_back] + [self.window]
        self.window = None
        if self.a_level is not None and self.a_level > L.LEGACY_ON_LEVEL and not any(i[2] for i in self.items):
            self.start_ts = self.a_ts

    def apply(self, t: int, src: int, level: float | None, occupied: bool | None) -> tuple | None:
        """One reading in time order; the ``(start, finish)`` it closes, if any."""
        self.fire(t)
        if src == E.SRC_PRESENCE:
            present = bool(occupied) or (self.window is not None and self.window[2])
            self.window = ((t // self.width + 1) * self.width, t, present)
            return None
        self.a_ts, self.a_level = t, level or 0.0
        if self.a_level <= L.LEGACY_ON_LEVEL and self.start_ts is not None:
            closed, self.start_ts = (self.start_ts, t), None
            return closed
        return None


class Shard:
    """The sensors of a group: their rules, and the readings that wait."""

    def __init__(self, width_s: int, look_back_s: int, state: tuple | None):
        keys, end, last, occupied, a_ts, a_level, start_ts, *more = state or ([] for _ in STATE.fields)
        self.rule_of = {}
        items = [[] for _ in keys]
        for at, *item in zip(*more[:4]):
            items[at].append(item)
        self.width_s, self.look_back_s = width_s, look_back_s
        for k, *window, a, level, start, found in zip(keys, end, last, occupied, a_ts, a_level, start_ts, items):
            self.rule_of[k] = Rule(width_s, look_back_s, window if window[0] is not None else None, found, a, level,
                                   start)
        self.waiting = {c: np.array(v, dtype=t) for (c, t), v in zip(WAIT.items(), more[4:])}

    def add(self, f: pd.DataFrame) -> None:
        """Readings that come."""
        code, keys = pd.factorize(f["key"])
        for k in keys:
            self.rule_of.setdefault(k, Rule(self.width_s, self.look_back_s))
        number = {k: i for i, k in enumerate(self.rule_of)}
        level = f["level"].to_numpy(dtype=float, na_value=np.nan)
        rows = {"at": np.array([number[k] for k in keys], dtype=np.int64)[code], "t": f["t"], "src": f["src"],
                "id": f["id"], "level": np.where(np.isnan(level), 0.0, level), "occupied": f["occupied"].eq(True)}
        self.waiting = {c: np.concatenate([self.waiting[c], np.asarray(rows[c], dtype=t)]) for c, t in WAIT.items()}

    def advance(self, passed: int) -> list:
        """Apply what the watermark has passed: ``(key, start, finish)`` of
        the episodes that this closes."""
        due = np.flatnonzero(self.waiting["t"] <= passed)
        w = {c: v[due] for c, v in self.waiting.items()}
        self.waiting = {c: np.delete(v, due) for c, v in self.waiting.items()}
        order = np.lexsort((w["id"], w["src"], w["t"], w["at"]))
        keys, rules = list(self.rule_of), list(self.rule_of.values())
        closed = []
        for at, t, src, level, occupied in zip(*(w[c][order].tolist() for c in ("at", "t", "src", "level", "occupied"))):
            if c := rules[at].apply(t, src, level, occupied):
                closed.append((keys[at], *c))
        for rule in rules:
            rule.fire(passed)
        return closed

    def ahead(self) -> int | None:
        """The earliest reading or window end that the watermark has to pass."""
        ends = [r.window[0] for r in self.rule_of.values() if r.window]
        return min([*ends, *([int(self.waiting["t"].min())] if len(self.waiting["t"]) else [])], default=None)

    def dump(self) -> tuple:
        rules = self.rule_of.values()
        windows = [r.window or (None, None, None) for r in rules]
        items = [(at, *i) for at, r in enumerate(rules) for i in r.items]
        return (list(self.rule_of), *([w[n] for w in windows] for n in range(3)), [r.a_ts for r in rules],
                [r.a_level for r in rules], [r.start_ts for r in rules], *([i[n] for i in items] for n in range(4)),
                *(v.tolist() for v in self.waiting.values()))


def legacy_shard_fn(width_s: int, look_back_s: int):
    """``applyInPandasWithState`` by shard, with an event-time timer at the
    earliest reading or window end that the watermark has to pass."""
    def fn(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        shard = Shard(width_s, look_back_s, state.get if state.exists else None)
        if not state.hasTimedOut:
            for f in frames:
                shard.add(f)
        passed = state.getCurrentWatermarkMs() * 1000
        closed = shard.advance(passed)
        state.update(shard.dump())
        if (ahead := shard.ahead()) is not None:  # whole milliseconds, after the watermark
            state.setTimeoutTimestamp(max(-(-ahead // 1000), passed // 1000 + 1))
        if closed:
            keys, starts, finishes = zip(*closed)
            yield pd.DataFrame({"key": keys, "start_us": starts, "finish_us": finishes})
    return fn


def legacy_stream(actuator: DataFrame, presence: DataFrame, width_s: int,
                  look_back_s: int = L.QUIET_S, strategy: str = "legacy", shards: int = SHARDS) -> DataFrame:
    """Finished legacy episodes (the columns of the batch ``legacy_episodes``)
    of two watermarked streams (``event_time``, see ``job.with_watermark``).
    What the watermark has not passed is still to come out: an idle input
    holds it back, unless some sensor's heartbeat moves it on.  A restart names
    the same number of ``shards``."""
    rows = E.readings(actuator, presence, ("event_time",)).select(
        "key", "event_time", tf.micros("ts").alias("t"), F.col("src").cast("int").alias("src"), "id", "level",
        "occupied")
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    closed = dealt.groupBy("shard").applyInPandasWithState(
        legacy_shard_fn(width_s, look_back_s), outputStructType=OUTPUT, stateStructType=STATE,
        outputMode="append", timeoutConf="EventTimeTimeout")
    return closed.select(*closed_columns(F.col("key"), tf.wall_time("start_us"), tf.wall_time("finish_us"), strategy))
