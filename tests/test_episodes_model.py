"""Model check: the set-based episode plan equals the sequential state
machine on seeded random inputs with equal timestamps, chunked and not."""

import datetime as dt
import random

import pytest

from lampwatch import labels as L
from lampwatch import schemas
from lampwatch.operators import episodes as E
from lampwatch.sources import rules as R
from tests.model import Rule, run

BASE = dt.datetime(2024, 1, 5, 0, 0)  # a Friday; the data spans a weekend


def random_events(seed: int, n: int = 400, keys=("a", "b", "c")):
    rnd = random.Random(seed)
    # few distinct minutes -> many equal timestamps across and within inputs
    minutes = sorted(rnd.sample(range(0, 4 * 24 * 60), 150))
    out = []
    for i in range(n):
        ts = BASE + dt.timedelta(minutes=rnd.choice(minutes))
        src = rnd.randint(0, 1)
        out.append(dict(key=rnd.choice(keys), ts=ts, src=src, id=i,
                        level=rnd.choice([0.0, 3.0, 5.0, 7.5, 80.0]) if src == 0 else None,
                        occupied=rnd.random() < 0.3 if src == 1 else None))
    return out


def frames(spark, events):
    act = spark.createDataFrame(
        [(e["key"], 1, e["ts"], e["id"], e["level"]) for e in events if e["src"] == 0],
        schemas.ACTUATOR)
    pre = spark.createDataFrame(
        [(e["key"], 1, e["ts"], e["id"], e["occupied"], 1.0) for e in events if e["src"] == 1],
        schemas.PRESENCE)
    return act, pre


def spark_rules(spark, rule: Rule, rid: str):
    row = dict(rule_id=rid, project_id=1, strategy=rule.strategy, hour_start=rule.hour_start,
               minute_start=rule.minute_start, hour_end=rule.hour_end,
               minute_end=rule.minute_end, keys=["a", "b", "c"], factor=0.6,
               template_id="t", receivers=[], table_id="x", program_start=rule.program_start,
               on_level=rule.on_level, quiet_s=rule.quiet_s, settle_s=rule.settle_s,
               warmup_s=rule.warmup_s)
    return R.from_config(spark, [row])


CASES = [
    Rule(L.TIME_ONLY),
    Rule(L.SENSOR_ONLY, quiet_s=1200, settle_s=60, warmup_s=1200),
    Rule(L.SENSOR_ONLY, quiet_s=6 * 3600, settle_s=1800, warmup_s=3600),
    Rule(L.SENSOR_AND_TIME, quiet_s=1200, settle_s=60, warmup_s=1200),
    Rule(L.SENSOR_AND_TIME, quiet_s=3 * 3600, settle_s=600, warmup_s=0),
]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("case", range(len(CASES)))
@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 9])
def test_episodes_equal_state_machine(spark, seed, case, rows_per_chunk):
    rule = CASES[case]
    events = random_events(seed)
    expected = sorted((e["key"], e["open_ts"], e["start_ts"], e["finish_ts"])
                      for e in run(events, rule))
    act, pre = frames(spark, events)
    rules = spark_rules(spark, rule, "r")
    rk = R.explode_keys(rules)
    dim = spark.createDataFrame([(k, 100.0) for k in "abc"], "_key string, power double")
    eps = E.episodes(act, pre, rk, rules, dim, rows_per_chunk=rows_per_chunk)
    got = sorted((r.sensor_key, r.open_ts, r.start_ts, r.finish_ts)
                 for r in eps.select("sensor_key", "open_ts", "start_ts", "finish_ts").collect())
    assert got == expected
    assert len(expected) > 0


def test_changelog_two_rows_per_finished(spark):
    events = random_events(3)
    act, pre = frames(spark, events)
    rules = spark_rules(spark, CASES[0], "r")
    dim = spark.createDataFrame([(k, 100.0) for k in "abc"], "_key string, power double")
    eps = E.episodes(act, pre, R.explode_keys(rules), rules, dim)
    log = E.changelog(eps)
    n_eps = eps.count()
    n_fin = eps.where("is_finish").count()
    assert log.count() == n_eps + n_fin
    assert log.where("route = 'alert'").count() == n_eps
    fin = log.where("is_finish").select("carbon_unit").distinct().collect()
    assert [r.carbon_unit for r in fin] in ([L.CARBON_UNIT], [])
