import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lampwatch.functions import decode as D
from lampwatch.functions import timefns as tf
from lampwatch.operators.suppress import greedy_keep
from tests.model import Rule, in_schedule, next_start_gap_s


def _one(spark, col, ts):
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    return df.select(col.alias("v")).first()["v"]


def test_schedule_edges(spark):
    r = Rule("time_only")
    mon = dt.datetime(2024, 1, 8)
    cases = [mon.replace(hour=8), mon.replace(hour=18), mon.replace(hour=18, microsecond=1),
             mon.replace(hour=7, minute=59, second=59), dt.datetime(2024, 1, 6, 12),
             dt.datetime(2024, 1, 7, 12)]
    for ts in cases:
        got = _one(spark, tf.in_schedule("ts", 8, 0, 18, 0), ts)
        assert got == in_schedule(ts, r), ts
    # overnight schedules are never in schedule
    assert _one(spark, tf.in_schedule("ts", 22, 0, 6, 0), mon.replace(hour=23)) is False


def test_next_start_gap(spark):
    r = Rule("time_only")
    mon = dt.datetime(2024, 1, 8)
    for ts in [mon.replace(hour=8), mon.replace(hour=7, minute=59, second=59, microsecond=5),
               mon.replace(hour=18, minute=30), mon.replace(hour=0)]:
        assert _one(spark, tf.next_start_gap_s("ts", 8, 0), ts) == next_start_gap_s(ts, r)
    assert _one(spark, tf.next_start_gap_s("ts", 8, 0), mon.replace(hour=8)) == 86400


def _java_week(d: dt.date) -> int:
    # week of year, Sunday first, one minimal day: the week with 1 January is
    # week 1 -- also for the last days of December
    sat = d + dt.timedelta(days=(5 - d.weekday()) % 7)
    return (sat.timetuple().tm_yday + 6) // 7


def test_week_and_weekday(spark):
    days = [dt.date(2019, 12, 20) + dt.timedelta(days=i) for i in range(0, 3000, 7)]
    days += [dt.date(y, 12, d) for y in range(2019, 2030) for d in (28, 29, 30, 31)]
    days += [dt.date(y, 1, d) for y in range(2019, 2030) for d in (1, 2, 3, 7)]
    df = spark.createDataFrame([(dt.datetime.combine(d, dt.time(12)),) for d in days],
                               "ts timestamp_ntz")
    rows = df.select("ts", tf.week_of_year("ts").alias("w"),
                     tf.weekday_sun0("ts").alias("wd")).collect()
    for r in rows:
        d = r.ts.date()
        assert r.w == _java_week(d), d
        assert r.wd == (d.isoweekday() % 7)


def test_parse_time(spark):
    df = spark.createDataFrame(
        [("2024-01-01 08:00:00",), ("2024-01-01 08:00:00.123",), ("2024-13-40 08:00:00",),
         ("2024-1-1 8:0:0",), ("",), (None,), ("2024-01-01 08:00:00x",)], "t string")
    got = [r.v for r in df.select(tf.parse_time("t").alias("v")).collect()]
    ok = dt.datetime(2024, 1, 1, 8)
    assert got == [ok, ok, None, None, None, None, None]


def test_epoch_ms(spark):
    df = spark.createDataFrame([(1704240000,), (1704240000123,)], "x bigint")
    assert [r.v for r in df.select(tf.epoch_ms("x").alias("v")).collect()] == [
        1704240000000, 1704240000123]


def test_decode_rejects_and_types(spark):
    msgs = [
        (1, '{"item":{"value":{"sensor_4":"k1","_projectId":1,"lux":12.5,"occupancy":1,'
            '"time":"2024-01-01 08:00:00"}}}'),
        (2, '{"value":{"sensor_4":"k1"}}'),
        (3, '{"item":{}}'),
        (4, '{"item":{"value":{"_projectId":1,"time":"2024-01-01 08:00:00"}}}'),
        (5, '{"item":{"value":{"sensor_4":null,"time":"2024-01-01 08:00:00"}}}'),
        (6, "not json"),
        (7, '{"item":null}'),
        (8, '{"item":{"value":{"sensor_4":"k1","lux":"7","occupancy":true}}}'),
        (9, '{"item":{"value":{"sensor_4":"k1","lux":"7","occupancy":true,'
            '"time":"2024-01-01 08:00:00.5"}}}'),
        (10, '{"item":{"value":{"sensor_4":"k1","occupancy":0.5,"time":"2024-01-01 08:00:00"}}}'),
        (11, '{"item":{"value":{"sensor_4":"k1","time":"2024-01-01 8:00:00"}}}'),
    ]
    raw = spark.createDataFrame(msgs, "msg_id bigint, value string")
    good, bad = D.decode_presence(raw)
    reasons = {r.msg_id: r.reason for r in bad.collect()}
    assert reasons == {2: "no_item", 3: "no_value", 4: "no_key", 5: "no_key", 6: "not_json",
                       7: "no_value", 8: "bad_time", 11: "bad_time"}
    g = {r.msg_id: r for r in good.collect()}
    assert set(g) == {1, 9, 10}
    assert g[1].occupied is True and g[1].lux == 12.5 and g[1].project_id == 1
    assert g[9].occupied is False and g[9].lux == 0.0      # text and boolean read as absent
    assert g[10].occupied is True                           # nonzero fraction is presence
    assert g[1].ts == dt.datetime(2024, 1, 1, 8)


def test_valid_flat(spark):
    raw = spark.createDataFrame(
        [(1, '{"value":{"sensor_4":"k"}}'), (2, '{"value":{"sensor_4":null}}'),
         (3, '{"value":{"x":1}}'), (4, '{"other":{}}'), (5, "garbage")],
        "msg_id bigint, value string")
    assert sorted(r.msg_id for r in D.valid_flat(raw, "sensor_4").collect()) == [1, 2]


def _greedy_loop(ts, gap):
    keep, last = [], None
    for t in ts:
        if last is None or last + gap < t:
            keep.append(True)
            last = t
        else:
            keep.append(False)
    return keep


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10_000), max_size=60), st.integers(1, 500))
def test_greedy_keep_equals_loop(xs, gap):
    ts = np.array(sorted(xs), dtype=np.int64)
    assert list(greedy_keep(ts, gap)) == _greedy_loop(list(ts), gap)


def test_rule_validation():
    import datetime as dt

    import pytest

    from lampwatch.sources import rules as R

    good = dict(rule_id="r", strategy="time_only", hour_start=8, minute_start=0, hour_end=18,
                minute_end=0, factor=0.6, program_start=dt.datetime(2024, 1, 1))
    R.validate_rows([good])
    for bad in (dict(good, strategy="nope"), dict(good, hour_end=24), dict(good, factor=None),
                dict(good, minute_start=61)):
        with pytest.raises(R.RuleError):
            R.validate_rows([bad])
    with pytest.raises(R.RuleError):
        R.validate_rows([good, good])


def test_rule_problems_table(spark):
    import datetime as dt

    from lampwatch.sources import rules as R

    rows = [dict(rule_id="a", strategy="sensor_only", hour_start=8, minute_start=0,
                 hour_end=18, minute_end=0, factor=0.6, program_start=dt.datetime(2024, 1, 1)),
            dict(rule_id="b", strategy="weird", hour_start=8, minute_start=0, hour_end=30,
                 minute_end=0, factor=0.6, program_start=dt.datetime(2024, 1, 1))]
    got = {(r.rule_id, r.problem)
           for r in R.problems(R.normalize(R.rules_from_rows(spark, rows))).collect()}
    assert got == {("b", "unknown strategy"), ("b", "bad hour")}


def test_dimension_completeness(spark):
    import pytest

    from lampwatch.sources import dimension as dim

    d = spark.createDataFrame([("a", 10.0), ("b", None), ("b", 3.0)], "_key string, power double")
    rk = spark.createDataFrame([("r", "a"), ("r", "c"), ("r", "a"), ("r", "b")],
                               "rule_id string, key string")
    got = {(r.key, r.reason) for r in dim.missing_keys(dim.sensor_power(d), rk).collect()}
    assert got == {("c", "missing"), ("a", "duplicate in rule")}
    with pytest.raises(ValueError):
        dim.require_complete(dim.sensor_power(d), rk)
    power = {r._key: r.power for r in dim.sensor_power(d).collect()}
    assert power == {"a": 10.0, "b": 3.0}  # one row per key


def test_parse_time_reads_the_whole_text(spark):
    good = "2024-01-01 08:00:00"
    cases = {good: True, good + ".5": True, good + "." + "1" * 400: True, good + ".": False,
             good + ".1JUNK": False, good + "." + "1" * 199 + "JUNK": False, good + "\n": False,
             "2024-13-40 08:00:00": False, "2024-01-01 08:00": False}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.v for r in df.select("t", tf.parse_time("t").alias("v")).collect()}
    assert {k: v is not None for k, v in got.items()} == cases
    assert got[good + ".5"] == dt.datetime(2024, 1, 1, 8)


def test_wall_time_in_a_zone_with_daylight_saving(spark):
    """No zone rule of the session touches wall times."""
    old = spark.conf.get("spark.sql.session.timeZone")
    a, b = dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 30)
    try:
        for zone in ("America/New_York", "UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
            r = df.select(tf.duration_s("a", "b").alias("s"), tf.format_time("a").alias("t"),
                          tf.parse_time(tf.format_time("a")).alias("p"),
                          tf.wall_time(tf.micros("a")).alias("w"),
                          tf.local_time(F.lit(1704067200123), "Asia/Shanghai").alias("z")).first()
            assert (r.s, r.t, r.p, r.w) == (3600, "2024-03-10 02:30:00", a, a)
            assert r.z == dt.datetime(2024, 1, 1, 8, 0, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dimension_repeats_and_gaps(spark):
    """Repeated dimension rows are one sensor; a sensor without a row fails."""
    import pytest

    from lampwatch.plans import catalog
    from lampwatch.plans import fixture as fx
    from lampwatch.operators import episodes as E
    from tests.conftest import SF_SMALL as sf

    d = fx.dimension(spark, sf)
    args = (fx.actuator(spark, sf), fx.presence(spark, sf), fx.rule_keys(spark, sf, ["time_only"]),
            fx.rules(spark, ["time_only"]))
    once = E.episodes(*args, d).agg(F.count("*"), F.round(F.sum("carbon_emissions"), 6)).first()
    twice = E.episodes(*args, d.unionByName(d)).agg(F.count("*"), F.round(F.sum("carbon_emissions"), 6)).first()
    assert once == twice
    with pytest.raises(Exception, match="missing in the dimension"):
        E.episodes(*args, d.where("false")).select("carbon_emissions").collect()


def test_checkpoint_root_fails_on_a_cluster():
    import pytest

    from lampwatch.session import checkpoint_root

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_overnight_rule_is_warned_about(spark):
    import warnings

    import pytest

    from lampwatch.plans import fixture as fx
    from lampwatch.sources import rules as R

    day, night = fx.RULES["time_only"], dict(fx.RULES["time_only"], hour_start=22, hour_end=6)
    with pytest.warns(UserWarning, match="never in schedule"):
        R.validated(R.rules_from_rows(spark, [night]))
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        R.validated(R.rules_from_rows(spark, [day]))
