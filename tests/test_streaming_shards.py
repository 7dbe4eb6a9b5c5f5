"""Live runs that keep the states of many sensors in one group, and the hand-over with late rows dropped."""

import datetime as dt
import random

from lampwatch import schemas
from lampwatch.operators import episodes as E
from lampwatch.operators import legacy as LG
from lampwatch.plans import fixture as fx
from lampwatch.plans import streams as ST
from lampwatch.session import scratch_path, ship_package
from lampwatch.streaming import job as J
from lampwatch.streaming.legacy import legacy_stream
from tests.test_streaming_state import add, readings, seen

SAT = dt.datetime(2024, 1, 6)


def test_handover_that_drops_late_rows(spark):
    """The seeds' event time reaches the operator, so it must be one that pandas holds."""
    ship_package(spark)
    rules = fx.rules(spark, ["time_only"])
    rk = spark.createDataFrame([("time_only", "k"), ("time_only", "z")], "rule_id string, key string")
    d = spark.createDataFrame([("k", 100.0), ("z", 50.0)], "_key string, power double")
    root = scratch_path(spark, "test-seeded-drop")
    a0, p0 = readings(spark, [("k", 8, 80.0)]), readings(spark, [("z", 1)], "p")
    J.write_seeds(J.handover_state(a0, p0, rk, rules), f"{root}/seeds")
    add(spark, root, [("k", 10, 0.0), ("z", 9, 80.0)])
    assert seen(ST._run_stream(spark, root, rules, rk, d, f"{root}/seeds", "drop")) == \
        [("k", True, 10), ("z", False, 9)]


def many(spark, root, act, pre):
    for name, rows, schema in (("actuator", act, schemas.ACTUATOR), ("presence", pre, schemas.PRESENCE)):
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(f"{root}/in/{name}")


def groups(spark, checkpoint):
    return spark.read.format("statestore").load(checkpoint).count()


def test_sensors_share_groups_and_states(spark):
    """Two groups for 40 sensors of two rules, seeded and restarted: as one batch run over all readings."""
    ship_package(spark)
    rules = fx.rules(spark, ["time_only", "sensor_only"])
    keys = [f"k{i}" for i in range(40)]
    rk = spark.createDataFrame([(r, k) for i, k in enumerate(keys) for r in ("time_only", "sensor_only")
                                if r == "time_only" or i % 3], "rule_id string, key string")
    d = spark.createDataFrame([(k, 100.0) for k in keys], "_key string, power double")
    root, rnd, big = scratch_path(spark, "test-shards"), random.Random(3), 2 ** 60
    # ids beyond a double's 53 bits
    act = [(rnd.choice(keys), 1, SAT + dt.timedelta(minutes=m), big + m, rnd.choice([0.0, 80.0, 80.0, None]))
           for m in range(1200)]
    pre = [(rnd.choice(keys), 1, SAT + dt.timedelta(minutes=m), big + m, rnd.choice([True, False, False, None]), 1.0)
           for m in range(1200)]
    parts = [([r for r in act if lo <= r[3] - big < hi], [r for r in pre if lo <= r[3] - big < hi])
             for lo, hi in ((0, 400), (400, 800), (800, 1200))]
    frames = [(spark.createDataFrame(a, schemas.ACTUATOR), spark.createDataFrame(p, schemas.PRESENCE))
              for a, p in [*parts, (act, pre)]]
    J.write_seeds(J.handover_state(*frames[0], rk, rules), f"{root}/seeds")
    for a, p in parts[1:]:
        many(spark, root, a, p)
        src = [J.with_watermark(J.file_source(spark, f"{root}/in/{n}", s))
               for n, s in (("actuator", schemas.ACTUATOR), ("presence", schemas.PRESENCE))]
        changes = J.episode_changes(*src, rk, rules, J.seed_source(spark, f"{root}/seeds"), shards=2)
        ST._await(J.start(J.episode_records(changes, rules, d, rk), f"{root}/out", f"{root}/ckpt", rules))
    assert groups(spark, f"{root}/ckpt") == 2
    cols = ["rule_id", "sensor_key", "open_ts", "open_id", "is_finish", "row_ts", "duration", "origin_data"]

    def rows(df):
        return [tuple(r) for r in df.select(*cols).collect()]

    before = rows(E.changelog(E.episodes(*frames[0], rk, rules, d)))
    want = rows(E.changelog(E.episodes(*frames[3], rk, rules, d)))
    assert len(want) > len(before) > 10
    assert sorted(before + rows(J.committed(spark, f"{root}/out"))) == sorted(want)
    end = J.handover_state(*frames[3], rk, rules)
    assert sorted(map(tuple, J.live_state(spark, f"{root}/ckpt").collect()), key=str) == \
        sorted(map(tuple, end.collect()), key=str)


def test_legacy_sensors_share_groups(spark):
    ship_package(spark)
    root, rnd = scratch_path(spark, "test-legacy-shards"), random.Random(5)
    keys = [f"k{i}" for i in range(30)]
    at = lambda i: SAT + dt.timedelta(seconds=100 * i)
    act = [(rnd.choice(keys), 1, at(i), i, rnd.choice([0.0, 0.5, 90.0, None])) for i in range(1500)]
    pre = [(rnd.choice(keys), 1, at(i), i, rnd.choice([True, False, False, None]), 1.0) for i in range(1500)]
    beat = SAT + dt.timedelta(days=4)
    for lo, hi in ((0, 700), (700, 1500), (1500, 1500), (1500, 1500)):
        end = hi == lo
        many(spark, root, act[lo:hi] + [("beat", 1, beat, -1, 0.0)] * end,
             pre[lo:hi] + [("beat", 1, beat, -1, None, None)] * end)
    a, p = (J.with_watermark(J.file_source(spark, f"{root}/in/{n}", s))
            for n, s in (("actuator", schemas.ACTUATOR), ("presence", schemas.PRESENCE)))
    got = ST._drained(legacy_stream(a, p, 600, 1200, shards=2), root)
    want = LG.legacy_episodes(spark.createDataFrame(act, schemas.ACTUATOR), spark.createDataFrame(pre, schemas.PRESENCE),
                              "600 seconds", 1200)
    cols = ["sensor_key", "start_ts", "finish_ts"]
    assert want.count() > 10
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert groups(spark, f"{root}/ckpt") == 2
