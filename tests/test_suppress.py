"""K5: the greedy chain by pointer doubling against the sequential one."""

import random

import numpy as np
import pytest

from lampwatch.operators import suppress as SUP

DAY = 86_400_000


def chain(rows, start):
    out = []
    for key in {k for k, _ in rows}:
        ts = np.unique(np.array([t for k, t in rows if k == key and t >= start]))
        out += [(key, int(t)) for t in ts[SUP.greedy_keep(ts, DAY)]] if len(ts) else []
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [0, 100, 10_000])
def test_equals_the_sequential_chain(spark, monkeypatch, most):
    """Folded, jumped, and some of each."""
    monkeypatch.setattr(SUP, "FOLDED", most)
    rnd = random.Random(3)
    start = 1_704_240_000_000
    rows = []
    for key in ("a", "b", "c", None):
        t = start - 2 * DAY
        for _ in range(rnd.randint(30, 300)):
            t += rnd.choice([0, 1, 1000, DAY // 64, DAY // 3, DAY, DAY + 1, 3 * DAY])
            rows.append((key, t))
    rows += [("exact", start + i * DAY) for i in range(20)] + [("late", start + i * (DAY + 1)) for i in range(20)]
    rows += [("before", start - 1), ("one", start)]
    df = spark.createDataFrame(rows, "key string, time_stamp long").repartition(5)
    got = sorted(map(tuple, SUP.suppress(df, start // 1000).collect()), key=str)
    assert got == chain(rows, start)
    assert SUP.suppress(df.where("false"), start).collect() == []


def test_one_sensor_with_most_alerts(spark):
    """300,000 alerts of one sensor over 90 days, dealt by time: no task has many of them."""
    from pyspark.sql import functions as F

    start = 1_704_240_000_000
    assert 300_000 > SUP.FOLDED
    t = F.lit(start) + (F.col("id") * 25_919).cast("long")
    df = spark.range(300_000).select(F.lit("hot").alias("key"), t.alias("time_stamp"))
    got = sorted(r.time_stamp for r in SUP.suppress(df, start).collect())
    ts = start + np.arange(300_000, dtype=np.int64) * 25_919
    assert got == ts[SUP.greedy_keep(ts, DAY)].tolist()
    links = SUP.followers(df.select("key", F.col("time_stamp").alias("t")), DAY)
    most = (links.select(F.floor(F.col("t") / (DAY // SUP.BUCKETS + 1)).alias("b")).groupBy("b").count()
            .agg(F.max("count")).first()[0])
    assert most < 300_000 / 1000
