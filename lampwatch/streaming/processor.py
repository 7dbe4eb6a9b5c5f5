"""T1-T3 (and T6) as Structured Streaming stateful operators.

``groupBy(shard, dead).applyInPandasWithState(shard_fn(params))``: sensors are
dealt to ``SHARDS`` shards by a hash of their key.  One state row per shard
holds, column by column, the state of every rule for every sensor of the
shard, so a micro-batch costs one call per shard and numpy over its rows, and
no call per sensor.  A hand-over from a batch backfill (T6) comes as seed
rows, which fill the store before a sensor's first reading is applied.  Raw
messages that could not be decoded come as *dead* groups and pass through
without state, so that one pass and one commit serve both outputs.  Per rule
and micro-batch the rows are sorted by ``(sensor, ts, src, id)`` and run
through the same steps as the batch plan, for all sensors of the shard at
once:

* latest actuator reading and latest occupied time (forward fill within a
  sensor, starting from its state);
* row labels O / C from the rule's gates;
* transitions against the previous label (start: the state's open flag);
* one output row per open and per finish; the state keeps the open
  episode, if any.

Rows are applied in arrival order across micro-batches, as the original
per-record operator did, unless late rows are dropped (W4).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T

from lampwatch import labels as L

US = 1_000_000
DAY_US = 86_400 * US

STATE = T.StructType([
    T.StructField("a_ts", T.LongType()),       # wall-clock microseconds
    T.StructField("a_id", T.LongType()),
    T.StructField("a_level", T.DoubleType()),
    T.StructField("o_ts", T.LongType()),
    T.StructField("open_ts", T.LongType()),
    T.StructField("open_id", T.LongType()),
    T.StructField("start_ts", T.LongType()),
    T.StructField("ev_a_ts", T.LongType()),
    T.StructField("ev_a_level", T.DoubleType()),
    T.StructField("ev_lux", T.DoubleType()),
    T.StructField("ev_occupied", T.BooleanType()),
])

OUTPUT = T.StructType([
    T.StructField("rule_id", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("open_ts", T.TimestampNTZType()),
    T.StructField("open_id", T.LongType()),
    T.StructField("start_ts", T.TimestampNTZType()),
    T.StructField("finish_ts", T.TimestampNTZType()),
    T.StructField("a_ts", T.TimestampNTZType()),
    T.StructField("a_level", T.DoubleType()),
    T.StructField("lux", T.DoubleType()),
    T.StructField("occupied", T.BooleanType()),
])

# the state as rows of a batch DataFrame: what a hand-over passes on
INITIAL = T.StructType([T.StructField("rule_id", T.StringType()),
                        T.StructField("key", T.StringType()), *STATE.fields])


def _wall_us(s: pd.Series) -> np.ndarray:
    return s.to_numpy(dtype="datetime64[us]").astype(np.int64)


PARAMS = ["strategy", "on_level", "hour_start", "minute_start", "hour_end", "minute_end",
          "quiet_s", "settle_s", "warmup_s", "program_start"]
SRC_ACTUATOR, SRC_PRESENCE = 0, 1


# one row per reading, with the sorted ids of the rules that list the sensor
SENSOR_COLUMNS = ["rules", "seed", "key", "dead", "ts", "src", "id", "level", "occupied", "lux"]
# of raw messages besides: what a dead row passes on (its ``id`` is the message's)
REJECT_COLUMNS = ["source", "reason", "value"]
REJECTS = T.StructType([T.StructField("msg_id", T.LongType()),
                        *[T.StructField(c, T.StringType()) for c in REJECT_COLUMNS]])
RULE_SEP = "\x1f"


def rule_params(rules) -> dict:
    """``rule_id -> parameters`` of a (configuration-sized) rules table,
    held by the driver and shipped with the processor."""
    out = {}
    for r in rules.select("rule_id", *PARAMS).collect():
        d = r.asDict()
        d["program_start"] = int(np.datetime64(d["program_start"], "us").astype(np.int64))
        out[d.pop("rule_id")] = d
    return out


# a missing value in a numpy column of longs, of booleans (as int8); of doubles it is NaN
NONE = np.iinfo(np.int64).min
_MISSING = {T.LongType(): (NONE, np.int64), T.DoubleType(): (np.nan, np.float64), T.BooleanType(): (-1, np.int8)}
OPEN_FIELDS = ["open_ts", "open_id", "start_ts", "ev_a_ts", "ev_a_level", "ev_lux", "ev_occupied"]


def _missing(field: str) -> tuple:
    return _MISSING[STATE[field].dataType]


def _column(field: str, values: list) -> np.ndarray:
    none, dtype = _missing(field)
    return np.array([none if v is None else v for v in values], dtype=dtype)


def _known(column: np.ndarray) -> np.ndarray:
    return ~np.isnan(column) if column.dtype == np.float64 else column != (-1 if column.dtype == np.int8 else NONE)


def _plain(column: np.ndarray) -> list:
    """A numpy column as Python values, None where missing."""
    values = column.astype(bool).tolist() if column.dtype == np.int8 else column.tolist()
    known = _known(column)
    return values if known.all() else [v if k else None for v, k in zip(values, known.tolist())]


def sorted_rows(batch: pd.DataFrame, at: np.ndarray) -> dict:
    """The readings as numpy columns, by sensor (its number ``at``), then in
    the order of the batch plan."""
    cols = {"at": at, "ts": _wall_us(batch["ts"]), "src": batch["src"].to_numpy(dtype=np.int64),
            "id": batch["id"].to_numpy(dtype=np.int64),
            "level": batch["level"].to_numpy(dtype=float, na_value=np.nan),
            "occupied": batch["occupied"].eq(True).to_numpy(dtype=bool),
            "lux": batch["lux"].to_numpy(dtype=float, na_value=np.nan)}
    order = np.lexsort((cols["id"], cols["src"], cols["ts"], at))
    return {c: v[order] for c, v in cols.items()}


def step(rows: dict, st: dict, prm: dict) -> dict:
    """One rule, one micro-batch, all sensors of a shard: the output columns.
    ``st`` holds a column per state field, indexed by the sensor's number, and
    is brought up to date in place."""
    strategy = prm["strategy"]
    on = float(prm["on_level"])
    at, ts, level, occ = rows["at"], rows["ts"], rows["level"], rows["occupied"]
    is_act, is_pre = rows["src"] == SRC_ACTUATOR, rows["src"] == SRC_PRESENCE
    n = np.arange(len(ts))
    begins = np.append(True, at[1:] != at[:-1])
    begin = np.maximum.accumulate(np.where(begins, n, 0))

    def latest(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.maximum.accumulate(np.where(which, n, -1))
        return np.maximum(i, 0), i >= begin

    # step 1: as-of actuator reading and latest occupied time
    pick, have = latest(is_act)
    a_ts = np.where(have, ts[pick], st["a_ts"][at])
    a_level = np.where(have, level[pick], st["a_level"][at])
    o_pick, o_have = latest(is_pre & occ)
    o_ts = np.maximum(np.where(o_have, ts[o_pick], NONE), st["o_ts"][at])

    # step 2: gates and labels (calendar from wall-clock microseconds;
    # 1970-01-01 was a Thursday)
    day = np.floor_divide(ts, DAY_US)
    sod = ts - day * DAY_US
    weekday = (day + 3) % 7 < 5
    start_s = (int(prm["hour_start"]) * 3600 + int(prm["minute_start"]) * 60) * US
    end_s = (int(prm["hour_end"]) * 3600 + int(prm["minute_end"]) * 60) * US
    in_sched = weekday & (sod >= start_s) & (sod <= end_s)
    is_on = level >= on
    last_on = a_level >= on
    quiet = ~_known(o_ts) | (o_ts + int(prm["quiet_s"]) * US < ts)
    settled = _known(a_ts) & (a_ts + int(prm["settle_s"]) * US < ts)
    warm = prm["program_start"] + int(prm["warmup_s"]) * US < ts
    if strategy == L.TIME_ONLY:
        opens = is_act & is_on & ~in_sched
        closes = is_act & ~is_on
    else:
        opens = is_pre & ~occ & last_on & settled & quiet & warm
        if strategy == L.SENSOR_AND_TIME:
            opens &= ~in_sched
        closes = (is_act & ~is_on) | (is_pre & occ)
        opens &= ~closes

    # steps 3-4: a labelled row counts if its label differs from the one before
    # (a sensor's first: from the state's open flag)
    labelled = np.flatnonzero(opens | closes)
    label, where = opens[labelled], at[labelled]
    first = np.append(True, where[1:] != where[:-1])[:len(where)]
    before = np.where(first, _known(st["open_ts"])[where], np.append(False, label[:-1])[:len(label)])
    kept = labelled[label != before]
    opening, where = opens[kept], at[kept]
    first = np.append(True, where[1:] != where[:-1])[:len(where)]
    presence = is_pre[kept]
    opened = {"open_ts": ts[kept], "open_id": rows["id"][kept],
              "start_ts": (a_ts if strategy == L.SENSOR_ONLY else ts)[kept], "ev_a_ts": a_ts[kept],
              "ev_a_level": a_level[kept], "ev_lux": np.where(presence, rows["lux"][kept], np.nan),
              "ev_occupied": np.where(presence, occ[kept], -1).astype(np.int8)}
    # a closing row ends the episode of the kept row before it, or the state's
    opener = np.maximum(np.arange(len(kept)) - ~opening, 0)
    held = ~opening & first
    out = {"at": where, "finish_ts": np.where(opening, NONE, ts[kept])}
    for f, values in opened.items():
        out[f] = np.where(held, st[f][where], values[opener])

    last = np.append(where[1:] != where[:-1], True)[:len(where)]
    for f, values in opened.items():
        st[f][where[last]] = np.where(opening[last], values[last], _missing(f)[0])
    ends = np.flatnonzero(np.append(at[1:] != at[:-1], True))
    st["o_ts"][at[ends]] = o_ts[ends]
    ends = ends[have[ends]]
    for f, c in (("a_ts", "ts"), ("a_id", "id"), ("a_level", "level")):
        st[f][at[ends]] = rows[c][pick[ends]]
    return out


def _times(v: np.ndarray) -> np.ndarray:
    return v.astype("datetime64[us]")  # NONE is NaT


def _frame(found: list, keys: list) -> pd.DataFrame:
    """Output rows of ``(rule_id, columns)``."""
    c = {f: np.concatenate([out[f] for _, out in found]) for f in found[0][1]}
    return pd.DataFrame({
        "rule_id": np.repeat(np.array([r for r, _ in found], dtype=object), [len(out["at"]) for _, out in found]),
        "key": np.array(keys, dtype=object)[c["at"]],
        "open_ts": _times(c["open_ts"]), "open_id": c["open_id"],
        "start_ts": _times(c["start_ts"]), "finish_ts": _times(c["finish_ts"]), "a_ts": _times(c["ev_a_ts"]),
        "a_level": c["ev_a_level"], "lux": c["ev_lux"],
        "occupied": pd.arrays.BooleanArray(c["ev_occupied"] == 1, c["ev_occupied"] == -1),
    })


#: the states of a shard: its sensors, and per (sensor, rule) the sensor's number, the rule and its state
SHARD_STATE = T.StructType([
    T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("at", T.ArrayType(T.IntegerType())),
    T.StructField("rule_id", T.ArrayType(T.StringType())),
    *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in STATE.fields]])
#: groups that sensors are dealt to; a checkpoint is bound to its number of shards, as it is to its number of
#: partitions.  A shard's state row is about 100 bytes per sensor and rule
SHARDS = 2048


class Shard:
    """The states of a shard's sensors: per rule a column for each field,
    indexed by the sensor's number, and which sensors have a state."""

    def __init__(self, state: tuple | None):
        keys, at, rule, *columns = state or ([] for _ in SHARD_STATE.fields)
        self.keys = list(keys)
        self.number = {k: i for i, k in enumerate(self.keys)}
        self.rules = {}
        at, rule = np.array(at, dtype=np.int64), np.array(rule, dtype=object)
        columns = {f: _column(f, c) for f, c in zip(STATE.fieldNames(), columns)}
        for r in dict.fromkeys(rule.tolist()):
            these = rule == r
            self._set(r, at[these], {f: c[these] for f, c in columns.items()})

    def numbers(self, keys) -> np.ndarray:
        """The sensors' numbers, new ones for new sensors."""
        for k in keys:
            if k not in self.number:
                self.number[k] = len(self.keys)
                self.keys.append(k)
        return np.array([self.number[k] for k in keys], dtype=np.int64)

    def rule(self, rule_id: str) -> tuple[np.ndarray, dict]:
        """Which sensors have a state of the rule, and the state's columns."""
        has, st = self.rules.get(rule_id, (np.zeros(0, dtype=bool), None))
        more = len(self.keys) - len(has)
        if more:
            st = {f: np.concatenate([st[f] if st else np.zeros(0, dtype=_missing(f)[1]),
                                     np.full(more, *_missing(f))]) for f in STATE.fieldNames()}
            has = np.concatenate([has, np.zeros(more, dtype=bool)])
            self.rules[rule_id] = has, st
        return self.rules[rule_id]

    def _set(self, rule_id: str, at: np.ndarray, columns: dict) -> None:
        has, st = self.rule(rule_id)
        has[at] = True
        for f, c in columns.items():
            st[f][at] = c

    def seed(self, key: str, seed: str) -> None:
        """The states of a hand-over, as the sensor's seed row holds them;
        it counts only while the sensor has no state."""
        if key in self.number:
            return
        at = self.numbers([key])
        for r in json.loads(seed):
            self._set(r["rule_id"], at, {f: _column(f, [r.get(f)]) for f in STATE.fieldNames()})

    def dump(self) -> tuple:
        at = {r: np.flatnonzero(has) for r, (has, _) in self.rules.items()}
        columns = [sum((_plain(self.rules[r][1][f][i]) for r, i in at.items()), []) for f in STATE.fieldNames()]
        return (self.keys, sum((i.tolist() for i in at.values()), []),
                [r for r, i in at.items() for _ in range(len(i))], *columns)


def step_rules(batch: pd.DataFrame, shard: Shard, params: dict) -> pd.DataFrame | None:
    """Every rule's step for a shard's micro-batch (rows carry the list of
    their sensor's rules); brings the states up to date, returns the output
    rows, if any."""
    code, keys = pd.factorize(batch["key"])
    code_of_rules, lists = pd.factorize(batch["rules"])
    lists = [set(x.split(RULE_SEP)) for x in lists]
    number = shard.numbers(keys)
    rows = sorted_rows(batch, number[code])
    listed = np.zeros(len(shard.keys), dtype=np.int64)
    listed[number[code]] = code_of_rules  # a sensor has one list
    found = []
    for rule_id in sorted(set().union(*lists)):
        use = np.array([rule_id in x for x in lists])[listed[rows["at"]]]
        if params[rule_id]["strategy"] == L.TIME_ONLY:  # this strategy reads no presence
            use &= rows["src"] == SRC_ACTUATOR
        if not use.any():
            continue
        has, st = shard.rule(rule_id)
        mine = rows if use.all() else {c: v[use] for c, v in rows.items()}
        has[mine["at"]] = True
        out = step(mine, st, params[rule_id])
        if len(out["at"]):
            found.append((rule_id, out))
    return _frame(found, shard.keys) if found else None


def shard_fn(params: dict, rejects: bool = False):
    """``applyInPandasWithState`` grouped by shard (and ``dead``): one call
    runs the step of every rule for every sensor of the shard that reports, so
    the per-group overhead is paid once per shard.  A seed row counts only
    while its sensor has no state, so a replayed one changes nothing."""
    def fn(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if key[1]:
            for f in frames:
                yield _rejected(f)
            return
        frames = list(frames)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        shard = Shard(state.get if state.exists else None)
        seeds = batch["seed"].notna()
        if seeds.any():
            for sensor, seed in zip(batch["key"][seeds], batch["seed"][seeds]):
                shard.seed(sensor, seed)
            batch = batch[~seeds]
        out = step_rules(batch, shard, params) if len(batch) else None
        state.update(shard.dump())
        if out is not None:
            yield _with_rejects(out, None) if rejects else out
    return fn


def _with_rejects(changes: pd.DataFrame, rows: pd.DataFrame | None) -> pd.DataFrame:
    for c in REJECTS.fieldNames():
        changes[c] = None if rows is None else rows["id" if c == "msg_id" else c].to_numpy()
    return changes


def _rejected(rows: pd.DataFrame) -> pd.DataFrame:
    """Dead rows as output rows without a change."""
    none = pd.DataFrame({c: np.full(len(rows), None, dtype=object) for c in OUTPUT.fieldNames()})
    return _with_rejects(none, rows)
