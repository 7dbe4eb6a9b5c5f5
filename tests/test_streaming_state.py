"""States in and out of live runs (T6), raw messages (S2, P1-P3), manifests."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lampwatch import schemas
from lampwatch.operators import episodes as E
from lampwatch.plans import fixture as fx
from lampwatch.plans import streams as ST
from lampwatch.session import scratch_path, ship_package
from lampwatch.streaming import job as J
from lampwatch.streaming.processor import INITIAL

SAT = dt.datetime(2024, 1, 6)


@pytest.fixture(scope="module")
def small(spark):
    ship_package(spark)
    rules = fx.rules(spark, ["time_only"])
    rk = spark.createDataFrame([("time_only", "k"), ("time_only", "z")], "rule_id string, key string")
    d = spark.createDataFrame([("k", 100.0), ("z", 50.0)], "_key string, power double")
    return rules, rk, d


def readings(spark, rows, kind="a"):
    if kind == "a":
        return spark.createDataFrame([(k, 1, SAT.replace(hour=h), i, v) for i, (k, h, v) in enumerate(rows)],
                                     schemas.ACTUATOR)
    return spark.createDataFrame([(k, 1, SAT.replace(hour=h), 100 + h, False, 0.0) for k, h in rows],
                                 schemas.PRESENCE)


def add(spark, root, act, pre=(("z", 1),)):
    readings(spark, act).repartition(1).write.mode("append").parquet(f"{root}/in/actuator")
    readings(spark, pre, "p").repartition(1).write.mode("append").parquet(f"{root}/in/presence")


def seen(df):
    return sorted((r.sensor_key, r.is_finish, r.row_ts.hour)
                  for r in df.select("sensor_key", "is_finish", "row_ts").collect())


def test_silent_sensor_survives_a_restart(spark, small):
    """Open in the backfill, silent in the first live run, finished after the restart."""
    rules, rk, d = small
    root = scratch_path(spark, "test-silent")
    a0, p0 = readings(spark, [("k", 8, 80.0)]), readings(spark, [("z", 1)], "p")
    J.write_seeds(J.handover_state(a0, p0, rk, rules), f"{root}/seeds")
    add(spark, root, [("z", 9, 80.0)])
    assert seen(ST._run_stream(spark, root, rules, rk, d, f"{root}/seeds")) == [("z", False, 9)]
    state = {r.key: r for r in J.live_state(spark, f"{root}/ckpt").collect()}
    assert state["k"].open_ts is not None and state["z"].open_ts is not None
    add(spark, root, [("k", 10, 0.0)])
    assert seen(ST._run_stream(spark, root, rules, rk, d, f"{root}/seeds")) == [("k", True, 10), ("z", False, 9)]
    # the seeds were read once: they don't come back
    add(spark, root, [("k", 11, 0.0)])
    assert len(seen(ST._run_stream(spark, root, rules, rk, d, f"{root}/seeds"))) == 2


def test_restart_without_its_seeds_is_refused(spark, small):
    rules, rk, d = small
    root = scratch_path(spark, "test-unseeded")
    a0, p0 = readings(spark, [("k", 8, 80.0)]), readings(spark, [("z", 1)], "p")
    J.write_seeds(J.handover_state(a0, p0, rk, rules), f"{root}/seeds")
    add(spark, root, [("z", 9, 80.0)])
    ST._run_stream(spark, root, rules, rk, d, f"{root}/seeds")
    add(spark, root, [("k", 10, 0.0)])
    with pytest.raises(Exception):
        ST._run_stream(spark, root, rules, rk, d)


@pytest.mark.parametrize("rows_per_chunk", [None, 5])
def test_batch_goes_on_from_a_state(spark, rows_per_chunk):
    """Cut anywhere, two batch runs give the rows of one; also with hot sensors cut into pieces."""
    from tests.conftest import SF_SMALL as sf
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    rules, rk, d = fx.rules(spark), fx.rule_keys(spark, sf), fx.dimension(spark, sf)
    cut = F.lit("2024-01-04 07:00:00").cast("timestamp_ntz")
    first = [x.where(F.col("ts") < cut) for x in (act, pre)]
    last = [x.where(F.col("ts") >= cut) for x in (act, pre)]
    path = scratch_path(spark, "test-state")
    J.handover_state(*first, rk, rules, rows_per_chunk).write.parquet(path)
    state = spark.read.schema(INITIAL).parquet(path)
    cols = ["rule_id", "sensor_key", "open_ts", "is_finish", "row_ts", "duration", "carbon_emissions",
            "origin_data"]

    def rows(df):
        return [tuple(r) for r in df.select(*cols).collect()]

    got = (rows(E.changelog(E.episodes(*first, rk, rules, d, rows_per_chunk)))
           + rows(E.changelog(E.episodes(*last, rk, rules, d, rows_per_chunk, initial_state=state))))
    assert sorted(got) == sorted(rows(E.changelog(E.episodes(act, pre, rk, rules, d))))
    # the state at the end is that of one run
    end = J.handover_state(*last, rk, rules, rows_per_chunk, initial_state=state)
    want = J.handover_state(act, pre, rk, rules)
    assert sorted(map(tuple, end.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_missing_sensor_stops_every_selection(spark, small):
    """Whichever columns are asked for, and for open episodes too."""
    rules, rk, d = small
    a, p = readings(spark, [("k", 8, 80.0)]), readings(spark, [("z", 1)], "p")
    for columns in (["time"], ["rule_id", "sensor_key", "carbon_emissions"]):
        with pytest.raises(ValueError, match="missing in the dimension: 'z'"):
            E.episodes(a, p, rk, rules, d.where("_key = 'k'")).select(*columns).collect()
    with pytest.raises(ValueError, match="missing in the dimension"):
        J.episode_records(spark.createDataFrame([], J.OUTPUT), rules, d.where("false"), rk)


def test_half_written_micro_batch_is_not_seen(spark, small, monkeypatch):
    """A run that ends between two outputs leaves no half batch to readers."""
    rules, rk, d = small
    root = scratch_path(spark, "test-half")
    eps = E.episodes(readings(spark, [("k", 8, 80.0), ("k", 9, 0.0)]), readings(spark, [("z", 1)], "p"), rk, rules, d)
    batch = E.changelog(eps)
    sink = J.batch_sink(f"{root}/out", rules)
    sink(batch, 0)

    def broken(*a):
        raise RuntimeError("lost")
    monkeypatch.setattr(J.S, "alert_outbox", broken)
    with pytest.raises(RuntimeError):
        sink(batch, 1)
    monkeypatch.undo()
    assert spark.read.parquet(f"{root}/out/changelog").count() == 4
    for output, fmt, n in (("changelog", "parquet", 2), ("table", "parquet", 1), ("publish", "json", 2)):
        assert J.committed(spark, f"{root}/out", output, fmt).count() == n
    sink(batch, 1)  # the replay
    assert J.committed(spark, f"{root}/out").count() == 4
    J.compact(spark, f"{root}/out", "changelog", f"{root}/compact")
    assert spark.read.parquet(f"{root}/compact").count() == 4


def test_messages_are_parsed_and_shuffled_once(spark):
    """Dead letters leave through the operator of the readings: one scan of each input."""
    from tests.test_plans import _plan
    from tests.conftest import SF_SMALL as sf
    root = scratch_path(spark, "test-messages")
    for name, messages in (("a", fx.actuator_messages), ("p", fx.presence_messages)):
        messages(spark, sf).write.json(f"{root}/{name}")
    raw = [J.file_source(spark, f"{root}/{n}", "msg_id bigint, value string", "json") for n in "ap"]
    plan = _plan(J.message_changes(*raw, fx.rule_keys(spark, sf), fx.rules(spark)))
    assert plan.count("from_json(") == 2 and plan.count("StreamingRelation") == 4  # listed, and in detail
