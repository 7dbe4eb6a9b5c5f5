"""Presence aggregations of the windowed (legacy) rule: A1-A4, F12.

A1 reduce: latest time, occupied = OR, lux = order-dependent halving mean
(``acc = (x + acc) / 2`` over readings in time order, starting from the
first reading) -- not an average.  A2 applies A1 per key and tumbling
window; A3 is a rolling look-back over A2's window results; A4 folds one
window of both inputs into a summary row.

The fold rounds at every step, so it is done in order -- but over the last
``DEPTH`` readings of a group only, which is what bounds its array.  What came
before lies between the group's least and largest reading, and a step
``(x + acc) / 2`` never falls when ``acc`` rises: folding from both ends of
that range brackets the true result, and where both arrive at the same double
it *is* the result, to the last bit.  They always do after so many halvings;
if they did not (readings beyond half the range of a double, whose sum may
overflow, in a longer group), the job stops rather than give a near value.  A null
reading makes the fold null, a NaN makes it NaN, and an infinity stays, at any
depth, as in the fold over all readings.

A3 runs over window results, at most ``span / width`` rows per key.  A4's
message join is by definition one string holding every message of the
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import timefns as tf


#: readings of a group that are folded one by one
DEPTH = 2200
#: beyond it, the sum of two readings may overflow
HALF_RANGE = 2.0 ** 1023


def halving_fold(grouped: DataFrame, by: list[str]) -> DataFrame:
    """A1's lux fold of the readings ``(*by, ts, id, lux)`` of each group."""
    lux = F.col("lux")
    whole = grouped.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.count("lux").alias("_set"), F.min("lux").alias("_least"),
        F.max("lux").alias("_most"), F.bool_or(F.isnan("lux")).alias("_nan"),
        F.bool_or(lux == float("inf")).alias("_up"), F.bool_or(lux == float("-inf")).alias("_down"))
    back = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("ts"), F.desc("id")))
    last = (grouped.select(*by, "lux", back.alias("_back")).where(F.col("_back") <= DEPTH)
            .groupBy(*by).agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), "lux"))).alias("_r")))
    short = F.col("_n") <= DEPTH
    steps = F.when(short, F.slice("_r", 2, DEPTH)).otherwise(F.col("_r"))

    def folded(bound: str) -> Column:
        first = F.when(short, F.col("_r")[0]["lux"]).otherwise(F.col(bound))
        return F.aggregate(steps, first, lambda acc, r: (r["lux"] + acc) / 2)

    infinite = F.lit(float("inf"))
    whole = (whole.withColumn("_low", F.when(F.col("_least") < -HALF_RANGE, -infinite).otherwise(F.col("_least")))
             .withColumn("_high", F.when(F.col("_most") > HALF_RANGE, infinite).otherwise(F.col("_most"))))
    low, high = folded("_low"), folded("_high")
    value = (F.when(F.col("_set") < F.col("_n"), F.lit(None).cast("double"))
             .when(F.col("_nan") | (F.col("_up") & F.col("_down")), F.lit(float("nan")))
             .when(F.col("_up"), F.lit(float("inf"))).when(F.col("_down"), F.lit(float("-inf")))
             .when(low == high, low)
             .otherwise(F.raise_error(F.lit("a fold depends on readings beyond its depth")).cast("double")))
    return whole.join(last, by).select(*by, value.alias("lux"))


def tumbling(presence: DataFrame, width: str) -> DataFrame:
    """A2: A1 per key and tumbling window of ``width`` (e.g. ``1 hour``)."""
    base = presence.select("key", "ts", "id", "occupied", "lux", F.window("ts", width).alias("w"))
    whole = base.groupBy("key", "w").agg(
        F.max("ts").alias("ts"), F.bool_or("occupied").alias("occupied"),
        F.count(F.lit(1)).alias("n"))
    return whole.join(halving_fold(base, ["key", "w"]), ["key", "w"]).select(
        "key", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "ts", "occupied", "lux", "n")


def rolling(items: DataFrame, look_back_s: int = L.QUIET_S) -> DataFrame:
    """A3: per item, over the items of its key younger than ``look_back_s``
    (one exactly that old is evicted): occupied = OR, lux = mean."""
    w = (Window.partitionBy("key").orderBy(tf.micros("ts"))
         .rangeBetween(-(look_back_s * tf.US - 1), 0))
    return items.select(
        "*",
        F.bool_or("occupied").over(w).alias("occupied_roll"),
        F.avg("lux").over(w).alias("lux_roll"))


#: columns by which rows may set a summary's fields; the last one set counts
SETTERS = {"set_warning": "boolean", "set_first_open": "bigint", "set_strategy": "string"}


def window_summary(rows: DataFrame, width: str) -> DataFrame:
    """A4 + F12: one summary per key and tumbling window over readings of
    both inputs ``(key, ts, id, src, level, occupied, lux, message)``
    (``src`` 0 = actuator, 1 = presence).

    name = first non-empty key; time_stamp = latest time (epoch ms);
    opening_aperture = last actuator level; sensor_occ = OR of presence;
    sensor_lux = A1 fold; message = row messages joined by ``|`` in time
    order.  The warning flag, the first-open time (epoch ms) and the strategy
    are what rows set them to: of the columns ``SETTERS`` that the rows have,
    the last value in time order that is not null.  Where nothing is set they
    are derived: first_open_time = first actuator time on by the legacy
    threshold (0 if none); is_warning = last level on (legacy) and nobody
    present; strategy = the legacy one."""
    for name, kind in SETTERS.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    act = F.when(F.col("src") == 0, F.struct("ts", "id", "level"))
    rows = rows.withColumn("w", F.window("ts", width))
    agg = rows.groupBy("key", "w").agg(
        F.max("ts").alias("_ts"),
        F.max(act).getField("level").alias("opening_aperture"),
        F.bool_or(F.when(F.col("src") == 1, F.col("occupied"))).alias("sensor_occ"),
        F.array_sort(F.collect_list(F.when(F.col("message") != "",
                                           F.struct("ts", "id", "message")))).alias("_msgs"),
        F.min(F.when((F.col("src") == 0) & (F.col("level") > L.LEGACY_ON_LEVEL),
                     F.col("ts"))).alias("_first_open"),
        F.min(F.when(F.col("key") != "", F.struct("ts", "id", "key"))).getField("key").alias("name"),
        *[F.max(F.when(F.col(c).isNotNull(), F.struct("ts", "id", c))).getField(c).alias(c) for c in SETTERS])
    lux = halving_fold(rows.where(F.col("src") == 1), ["key", "w"]).withColumnRenamed("lux", "sensor_lux")
    g = agg.join(lux, ["key", "w"], "left")
    warn = (F.coalesce(F.col("opening_aperture") > L.LEGACY_ON_LEVEL, F.lit(False))
            & ~F.coalesce(F.col("sensor_occ"), F.lit(False)))
    return g.select(
        "key",
        F.col("w.start").alias("window_start"),
        "name",
        tf.wall_ms("_ts").alias("time_stamp"),
        tf.format_time("_ts").alias("time_str"),
        F.coalesce("set_warning", warn).alias("is_warning"),
        "opening_aperture", "sensor_occ", "sensor_lux",
        F.to_json(F.struct(F.col("opening_aperture").alias("OpeningAperture"),
                           F.col("sensor_occ").alias("SensorOCC"),
                           F.col("sensor_lux").alias("SensorLUX"))).alias("original_data"),
        F.array_join(F.transform("_msgs", lambda m: m.getField("message")), "|").alias("message"),
        F.coalesce("set_first_open", tf.wall_ms("_first_open"),
                   F.lit(0).cast("bigint")).alias("first_open_time"),
        F.coalesce("set_strategy", F.lit(L.LEGACY_STRATEGY)).alias("strategy"),
    )
