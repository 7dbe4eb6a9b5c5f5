"""Sequential per-sensor state machine, the test model for the set-based
plans.  Plain Python, one event at a time, written from the rule
semantics (not used by the library)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from lampwatch import labels as L


@dataclass
class Rule:
    strategy: str
    hour_start: int = 8
    minute_start: int = 0
    hour_end: int = 18
    minute_end: int = 0
    on_level: float = L.ON_LEVEL
    quiet_s: int = L.QUIET_S
    settle_s: int = L.SETTLE_S
    warmup_s: int = L.WARMUP_S
    program_start: dt.datetime = dt.datetime(2024, 1, 1)


def in_schedule(ts: dt.datetime, r: Rule) -> bool:
    if ts.isoweekday() in (6, 7):
        return False
    start = ts.replace(hour=r.hour_start, minute=r.minute_start, second=0, microsecond=0)
    end = ts.replace(hour=r.hour_end, minute=r.minute_end, second=0, microsecond=0)
    return start <= ts <= end


def next_start_gap_s(ts: dt.datetime, r: Rule) -> int:
    start = ts.replace(hour=r.hour_start, minute=r.minute_start, second=0, microsecond=0)
    if ts < start:
        gap = start - ts
    else:
        gap = start + dt.timedelta(days=1) - ts
    return int(gap.total_seconds() // 1)


@dataclass
class SensorState:
    last_act: tuple | None = None          # (ts, level)
    queue: list = field(default_factory=list)
    open: dict | None = None


def run(events: list[dict], r: Rule) -> list[dict]:
    """``events``: dicts with key, ts, src (0 actuator, 1 presence), id,
    level / occupied.  Returns episodes ``(key, open_ts, start_ts,
    finish_ts)`` in emission order."""
    out = []
    states: dict[str, SensorState] = {}
    for e in sorted(events, key=lambda e: (e["key"], e["ts"], e["src"], e["id"])):
        st = states.setdefault(e["key"], SensorState())
        ts = e["ts"]
        if e["src"] == 0:
            st.last_act = (ts, e["level"])
            if e["level"] < r.on_level:
                if st.open is not None:
                    st.open["finish_ts"] = ts
                    st.open = None
            elif (r.strategy == L.TIME_ONLY and st.open is None
                  and not in_schedule(ts, r)):
                st.open = dict(key=e["key"], open_ts=ts, start_ts=ts, finish_ts=None)
                out.append(st.open)
            continue
        if r.strategy == L.TIME_ONLY:
            continue
        quiet = dt.timedelta(seconds=r.quiet_s)
        while st.queue and st.queue[0] + quiet < ts:
            st.queue.pop(0)
        if e["occupied"]:
            st.queue.append(ts)
            if st.open is not None:
                st.open["finish_ts"] = ts
                st.open = None
            continue
        la = st.last_act
        ok = (la is not None and la[1] >= r.on_level
              and la[0] + dt.timedelta(seconds=r.settle_s) < ts
              and st.open is None and not st.queue
              and r.program_start + dt.timedelta(seconds=r.warmup_s) < ts)
        if r.strategy == L.SENSOR_AND_TIME:
            ok = ok and not in_schedule(ts, r)
        if ok:
            start = la[0] if r.strategy == L.SENSOR_ONLY else ts
            st.open = dict(key=e["key"], open_ts=ts, start_ts=start, finish_ts=None)
            out.append(st.open)
    return out
