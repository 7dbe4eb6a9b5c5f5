"""The chunked (hot-sensor) plans give the oracle's answers: with the
chunk threshold forced down to a few rows every sensor is cut into time
chunks and every running scan goes through the carry rows."""

import datetime as dt
from collections import Counter

import pytest

from lampwatch.operators import joins, scan
from tests.verify import compare, duck
from tests.conftest import SF_SMALL

CHUNKED = ["asof_actuator", "quiet_lookback", "episodes_by_rule", "episode_changelog",
           "legacy_episodes", "stream_handover"]


@pytest.fixture(scope="module")
def results(spark):
    old = scan.ROWS_PER_CHUNK
    scan.ROWS_PER_CHUNK = 5
    try:
        return compare(spark, SF_SMALL, CHUNKED, con=duck(SF_SMALL))
    finally:
        scan.ROWS_PER_CHUNK = old


@pytest.mark.parametrize("name", CHUNKED)
def test_chunked_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r.get("error")
    assert r["rows"] == r["oracle_rows"] and r["values_match"], r


@pytest.mark.parametrize("depth", [2200, 120])
def test_fold_is_exact_at_any_depth(spark, monkeypatch, depth):
    """To the last bit that of the sequential fold, also for groups longer
    than the depth that is folded; nulls and non-finite readings at any depth."""
    import math
    import random

    from lampwatch.operators import presence as A

    monkeypatch.setattr(A, "DEPTH", depth)
    pick = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows, want = [], {}
    inf, nan = float("inf"), float("nan")
    for key, n, odd in (("a", 1, {}), ("b", 2, {}), ("c", 50, {}), ("d", 5000, {}), ("e", 5000, {3: 1e300 if depth > 1100 else 1e10}),
                        ("f", 5000, {0: inf}), ("g", 5000, {0: nan}), ("h", 5000, {7: None}), ("i", 3, {2: None}),
                        ("j", 300, {1: inf, 2: -inf}), ("k", 9, {8: -inf})):
        lux = [pick.uniform(0, 500) for _ in range(n)]
        for i, x in odd.items():
            lux[i] = x
        acc = lux[0]
        for x in lux[1:]:
            acc = None if x is None or acc is None else (x + acc) / 2
        want[key] = ("nan" if acc is not None and math.isnan(acc) else acc, n)
        rows += [(key, t0 + dt.timedelta(milliseconds=100 * i), i, False, x) for i, x in enumerate(lux)]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, occupied boolean, lux double")
    got = {r.key: ("nan" if r.lux is not None and math.isnan(r.lux) else r.lux, r.n)
           for r in A.tumbling(df, "1 day").collect()}
    assert got == want


def test_fold_that_may_overflow_is_not_guessed(spark):
    """Two early readings whose sum overflows: exact in a short group, refused in a long one."""
    from lampwatch.operators import presence as A

    t0 = dt.datetime(2024, 1, 1)

    def fold(n):
        rows = [("k", t0 + dt.timedelta(milliseconds=i), i, False, -1.5e308 if i < 2 else 1.0) for i in range(n)]
        df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long, occupied boolean, lux double")
        return A.tumbling(df, "1 day").first()["lux"]
    assert fold(2000) == float("-inf")
    with pytest.raises(Exception, match="beyond its depth"):
        fold(2300)


def _burst(spark):
    """10,000 rows of one key, all but two within ten seconds; a cold key."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0, 0), ("hot", t0 + dt.timedelta(days=30), 1)]
    rows += [("hot", t0 + dt.timedelta(days=3, milliseconds=i), 2 + i) for i in range(9998)]
    rows += [("cold", t0, -1)]
    return spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long")


def test_burst_is_cut(spark):
    out, cut = scan.assign_chunks(_burst(spark), "key", "ts", 100)
    assert cut
    rows = sorted((r.key, r.ts, r.chunk) for r in out.collect())
    assert [c for k, _, c in rows if k == "cold"] == [0]
    hot = [c for k, _, c in rows if k == "hot"]
    assert hot == sorted(hot)                       # numbers rise in time
    assert max(Counter(hot).values()) <= 200


def test_one_timestamp_stays_whole(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k", t0, i) for i in range(500)] + [("k", t0 + dt.timedelta(seconds=1), 900)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id long")
    out, _ = scan.assign_chunks(df, "key", "ts", 10)
    assert sorted(Counter(r.chunk for r in out.collect()).values()) == [1, 500]


def test_hot_question_is_asked_anew(spark, tmp_path):
    """A table that grows under the same path is seen by the next call."""
    t0 = dt.datetime(2024, 1, 1)
    path = str(tmp_path / "t")
    for n, hot in ((5, False), (500, True)):
        spark.createDataFrame([("k", t0 + dt.timedelta(seconds=i), i) for i in range(n)],
                              "key string, ts timestamp_ntz, id long").write.mode("append").parquet(path)
        df = spark.read.parquet(path)
        assert scan.assign_chunks(df, "key", "ts", 10)[1] == hot
        assert joins.fits_broadcast(df, 100) != hot


def test_hot_sensor_behind_a_large_key_list(spark, monkeypatch):
    """Beyond the broadcast bound the key list is joined before the rows are
    dealt by (sensor, chunk); answers stay the same."""
    from lampwatch.plans import catalog

    want = sorted(map(str, catalog.episodes_by_rule(spark, SF_SMALL).collect()))
    monkeypatch.setattr(scan, "ROWS_PER_CHUNK", 5)
    monkeypatch.setattr("lampwatch.operators.episodes.fits_broadcast", lambda *a: False)
    df = catalog.episodes_by_rule(spark, SF_SMALL)
    assert sorted(map(str, df.collect())) == want
