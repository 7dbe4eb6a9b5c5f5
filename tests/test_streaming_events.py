"""Event-time operators: the legacy rule live (A2, A3, T7, T8) and the
readings that come too late (W2, W4)."""

import datetime as dt
import random

import pytest

from lampwatch import schemas
from lampwatch.operators import legacy as LG
from lampwatch.plans import streams as ST
from lampwatch.session import scratch_path, ship_package
from lampwatch.streaming import job as J
from lampwatch.streaming.legacy import Rule, legacy_stream

START = dt.datetime(2024, 1, 1)
WIDTH_S, LOOK_BACK_S = 600, 1200


def random_rows(seed, n=240, sensors=4):
    """Readings of both inputs on a grid of 100 s, so that times tie and hit
    window ends."""
    rnd = random.Random(seed)
    act, pre = [], []
    for i in range(n):
        key, ts = f"k{rnd.randrange(sensors)}", START + dt.timedelta(seconds=100 * rnd.randrange(n * 2))
        if rnd.random() < 0.5:
            act.append((key, 1, ts, i, rnd.choice([0.0, 0.5, 0.6, 90.0, None])))
        else:
            pre.append((key, 1, ts, i, rnd.choice([True, False, False, None]), 1.0))
    return act, pre


def frames(spark, act, pre):
    return spark.createDataFrame(act, schemas.ACTUATOR), spark.createDataFrame(pre, schemas.PRESENCE)


def batch(spark, act, pre):
    out = LG.legacy_episodes(*frames(spark, act, pre), f"{WIDTH_S} seconds", LOOK_BACK_S)
    return sorted(tuple(r) for r in out.select("sensor_key", "start_ts", "finish_ts").collect())


@pytest.mark.parametrize("seed", range(3))
def test_rule_equals_batch(spark, seed):
    act, pre = random_rows(seed)
    us = lambda t: (t - START) // dt.timedelta(microseconds=1) + 1_704_067_200_000_000
    rules, got = {}, []
    rows = [(us(t), 0, i, k, v, None) for k, _, t, i, v in act] + [(us(t), 1, i, k, None, o) for k, _, t, i, o, _ in pre]
    for t, src, _, key, level, occupied in sorted(rows, key=lambda r: r[:3]):
        closed = rules.setdefault(key, Rule(WIDTH_S, LOOK_BACK_S)).apply(t, src, level, occupied)
        if closed:
            got.append((key, *(START + dt.timedelta(microseconds=c - us(START)) for c in closed)))
    assert len(got) > 2
    assert sorted(got) == batch(spark, act, pre)


def test_disordered_stream_equals_batch(spark):
    """Readings out of order across micro-batches, within the allowed disorder,
    over a restart from the checkpoint."""
    ship_package(spark)
    root = scratch_path(spark, "test-legacy")
    act, pre = random_rows(7)
    rnd = random.Random(1)
    both = sorted([(0, r) for r in act] + [(1, r) for r in pre],
                  key=lambda r: r[1][2] + dt.timedelta(seconds=rnd.randrange(3600)))
    end = START + dt.timedelta(days=3)
    beats = [(0, ("beat", 1, end, -1, 0.0)), (1, ("beat", 1, end, -1, None, None))]
    pieces = [both[:120], both[120:], beats, beats]

    def run():
        a, p = (J.with_watermark(J.file_source(spark, f"{root}/in/{n}", s), "3600 seconds")
                for n, s in (("a", schemas.ACTUATOR), ("p", schemas.PRESENCE)))
        return ST._drained(legacy_stream(a, p, WIDTH_S, LOOK_BACK_S), root)

    for n, piece in enumerate(pieces):
        a, p = frames(spark, [r for s, r in piece if s == 0], [r for s, r in piece if s == 1])
        a.coalesce(1).write.mode("append").parquet(f"{root}/in/a")
        p.coalesce(1).write.mode("append").parquet(f"{root}/in/p")
        if n in (0, 3):
            got = run()
    got = sorted(tuple(r) for r in got.select("sensor_key", "start_ts", "finish_ts").collect())
    assert got == batch(spark, act, pre)


@pytest.mark.parametrize("disorder,late", [(5, ["beyond"]), (1, ["beyond", "within"]), (60, [])])
def test_late_rows_follow_the_watermark(spark, disorder, late):
    ship_package(spark)
    root = scratch_path(spark, "test-late-split")
    at = lambda s: START + dt.timedelta(seconds=s)
    for rows in ([("first", 1, 1, at(100))],
                 [("within", 1, 2, at(97)), ("beyond", 1, 3, at(90)), ("next", 1, 4, at(130)), ("same", 1, 5, at(110))]):
        spark.createDataFrame(rows, "key string, src int, id bigint, ts timestamp_ntz").coalesce(1) \
            .write.mode("append").parquet(f"{root}/in")
    src = J.file_source(spark, f"{root}/in", "key string, src int, id bigint, ts timestamp_ntz")
    got = ST._drained(J.split_late(J.with_watermark(src, f"{disorder} seconds")), root).collect()
    assert sorted(r.key for r in got) == ["beyond", "first", "next", "same", "within"]
    assert sorted(r.key for r in got if r.late) == late
