"""K5: alert suppression -- per sensor at most one alert per 24 h after the
last *sent* one (strictly later than sent + 24 h), nothing before the
start time; the output is the sent alerts ``(key, time_stamp)``.

The sent set is a greedy chain (each sent alert decides the next), not a
fixed window, and a sensor's history may be long.  Batch: the alerts of a
sensor with at most ``FOLDED`` are folded in order, one sensor per row.  Of
the others, if there are any, every alert points
to the one that would follow if it were sent -- the first more than the gap
later -- and the chain from a sensor's first alert is found by pointer
jumping: a round makes the pointers reach four times as far, and the part of
the chain that is known four times as long, so there are as many rounds as the
longest chain has digits in base four.
All joins are on (sensor, time), so a sensor with most of the alerts is spread
like any other rows; no array holds more than ``FOLDED`` alerts.  Either way
the answer is the same.  ``greedy_keep`` is the
same chain in numpy for the streaming operator (``streaming/suppress.py``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import timefns as tf
from lampwatch.session import staged


def greedy_keep(times_ms: np.ndarray, gap_ms: int, last_sent: int | None = None) -> np.ndarray:
    """Boolean mask of the alerts sent, for ascending ``times_ms``."""
    keep = np.zeros(len(times_ms), dtype=bool)
    i = 0
    if last_sent is not None:
        i = int(np.searchsorted(times_ms, last_sent + gap_ms, side="right"))
    while i < len(times_ms):
        keep[i] = True
        i = int(np.searchsorted(times_ms, times_ms[i] + gap_ms, side="right"))
    return keep


#: most alerts of a sensor that are folded in one row
FOLDED = 10_000
#: buckets of a gap in which an alert's follower is looked for
BUCKETS = 64


def followers(alerts: DataFrame, gap_ms: int) -> DataFrame:
    """``key, t, next``: for each alert the first one of its sensor that is more
    than the gap later, where there is one.  Looked for in the bucket of time
    that the gap ends in, else it is the first alert of the next bucket that
    has any: a task sorts one bucket of a sensor, or one row per bucket."""
    width = gap_ms // BUCKETS + 1
    ends = F.col("t") + gap_ms

    def bucket(t):
        return F.floor(t / width).cast("bigint").alias("b")

    rows = (alerts.select("key", bucket(F.col("t")), F.col("t").alias("at"), F.lit(None).cast("bigint").alias("t"))
            .unionByName(alerts.select("key", bucket(ends), ends.alias("at"), "t")))
    alert = F.when(F.col("t").isNull(), F.col("at"))
    # later rows first, and of equal times the ends: an alert at the very end of a gap is not later
    later = (Window.partitionBy("key", "b").orderBy(F.desc("at"), F.col("t").isNull())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = rows.select("key", "b", "t", F.min(alert).over(later).alias("own")).where("t IS NOT NULL")
    beyond = Window.partitionBy("key").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    first = (rows.groupBy("key", "b").agg(F.min(alert).alias("m"))
             .select(F.col("key").alias("_k"), F.col("b").alias("_b"), F.min("m").over(beyond).alias("beyond")))
    both = own.join(first, F.col("key").eqNullSafe(F.col("_k")) & (F.col("b") == F.col("_b")))
    return both.select("key", "t", F.coalesce("own", "beyond").alias("next")).where("next IS NOT NULL")


def suppress(alerts: DataFrame, start, key: str = "key", ts_ms: str = "time_stamp",
             gap_s: int = L.ALERT_GAP_S) -> DataFrame:
    """``(key, time_stamp)`` of the sent alerts.  ``start`` and ``ts_ms``
    are epoch numbers, seconds or milliseconds (F9 normalises both).  Alerts
    of a sensor at the same time are one; null sensors are one sensor."""
    start_ms = start * 1000 if start < L.EPOCH_SECONDS_LIMIT else start
    norm = staged(alerts.select(F.col(key).alias("key"), tf.epoch_ms(ts_ms).alias("t"))
                  .where(F.col("t") >= F.lit(start_ms)).distinct(), "alerts")
    long = (norm.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FOLDED)
            .select(F.col("key").alias("_k"), F.lit(True).alias("_long")))
    if long.isEmpty():
        sent = folded(norm, gap_s * 1000)
    else:
        marked = norm.join(long, F.col("key").eqNullSafe(F.col("_k")), "left").select("key", "t", "_long")
        sent = folded(marked.where("_long IS NULL").drop("_long"), gap_s * 1000).unionByName(
            jumped(staged(marked.where("_long").drop("_long"), "alerts-long"), gap_s * 1000))
    return sent.select("key", F.col("t").alias(ts_ms))


def folded(alerts: DataFrame, gap_ms: int) -> DataFrame:
    """``key, t`` of the chain, by a fold over each sensor's sorted times."""
    times = alerts.groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    zero = F.struct(F.lit(None).cast("bigint").alias("last"),
                    F.array().cast("array<bigint>").alias("sent"))

    def visit(acc, t):
        send = acc.getField("last").isNull() | (acc.getField("last") + gap_ms < t)
        return F.when(send, F.struct(t.alias("last"),
                                     F.concat(acc.getField("sent"), F.array(t)).alias("sent"))
                      ).otherwise(acc)

    return times.select("key", F.explode(F.aggregate("ts", zero, visit).getField("sent")).alias("t"))


def jumped(alerts: DataFrame, gap_ms: int) -> DataFrame:
    """``key, t`` of the chain, by pointer jumping."""
    links = staged(followers(alerts, gap_ms), "alert-links")
    sent = alerts.groupBy("key").agg(F.min("t").alias("t"))

    def followed(rows: DataFrame, at: str) -> DataFrame:
        """``rows`` with their column ``at`` moved along the links."""
        step = links.select(F.col("key").alias("_k"), F.col("t").alias("_t"), "next")
        on = F.col("key").eqNullSafe(F.col("_k")) & (F.col(at) == F.col("_t"))
        return rows.join(step, on).select(*[F.col("next").alias(c) if c == at else F.col(c) for c in rows.columns])

    while True:
        once = followed(sent, "t")
        twice = followed(once, "t")
        more = staged(once.unionByName(twice).unionByName(followed(twice, "t")), "alerts-sent")
        if more.isEmpty():
            return sent
        sent = sent.unionByName(more)
        far = links.select("key", "t", F.col("next").alias("far"))
        for _ in range(3):
            far = followed(far, "far")
        links = staged(far.withColumnRenamed("far", "next"), "alert-links")
