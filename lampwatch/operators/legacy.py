"""Legacy windowed rule: T7 open by overwrite, T8 close, P12 warnings.

T7: when a presence window of a sensor closes (A2 window result, then A3
rolling look-back), if the sensor's latest actuator level before the
window end is on by the legacy threshold (P7) and nobody was present in
the look-back, the sensor's open episode is set -- overwriting any open
one -- with start = that actuator reading's time.  Nothing is emitted.
T8: an actuator reading that is off (P7) finishes the open episode, if
any: one finished row, flat 1 kg emission.

Set-based form per sensor in time order (window fires sort before an
actuator reading at the same instant, which therefore is not "before the
window end"): label fires ``O`` / off readings ``C``; a ``C`` emits iff the
latest ``O`` before it is later than the latest ``C`` before it, and that
``O`` (the last overwrite) gives the start.  All three look-ups are
chunked running scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import predicates as P
from lampwatch.functions import timefns as tf
from lampwatch.operators.presence import rolling, tumbling
from lampwatch.operators.scan import Scan, cut_chunks, carry_scan

KEYS = ["key"]
ORDER = ["t", "kind", "id"]
FIRE, READING = 0, 1


def legacy_episodes(actuator: DataFrame, presence: DataFrame, width: str,
                    look_back_s: int = L.QUIET_S, strategy: str = "legacy",
                    rows_per_chunk: int | None = None) -> DataFrame:
    items = rolling(tumbling(presence, width), look_back_s)
    fires = items.select(
        "key", F.col("window_end").alias("t"), F.lit(FIRE).alias("kind"),
        F.lit(0).cast("bigint").alias("id"), F.lit(None).cast("double").alias("level"),
        F.col("occupied_roll"))
    reads = actuator.select(
        F.col("key").cast("string").alias("key"), F.col("ts").alias("t"),
        F.lit(READING).alias("kind"), F.col("id").cast("bigint").alias("id"),
        F.coalesce(F.col("level").cast("double"), F.lit(0.0)).alias("level"),
        F.lit(None).cast("boolean").alias("occupied_roll"))
    rows, chunked = cut_chunks(fires.unionByName(reads), "key", "t", rows_per_chunk)

    st = carry_scan(rows, KEYS, "chunk", ORDER, [
        Scan("a", "last", F.when(F.col("kind") == READING,
                                 F.struct(F.col("t").alias("ts"), F.col("level").alias("level"))))],
                    chunked)
    a = F.col("a")
    lab = (F.when((F.col("kind") == FIRE)
                  & F.coalesce(P.is_on_legacy(a.getField("level")), F.lit(False))
                  & ~F.coalesce(F.col("occupied_roll"), F.lit(False)), "O")
           .when((F.col("kind") == READING) & ~P.is_on_legacy("level"), "C"))
    labeled = (st.select(*KEYS, "chunk", *ORDER, lab.alias("lab"),
                         a.getField("ts").alias("start_ts"))
               .where(F.col("lab").isNotNull()))
    pairs = carry_scan(labeled, KEYS, "chunk", ORDER, [
        Scan("last_o", "last", F.when(F.col("lab") == "O",
                                      F.struct(F.col("t").alias("t"),
                                               F.col("start_ts").alias("start_ts"))),
             inclusive=False),
        Scan("last_c", "max", F.when(F.col("lab") == "C", F.col("t")), inclusive=False),
    ], chunked)
    closes = pairs.where(
        (F.col("lab") == "C") & F.col("last_o").isNotNull()
        & (F.col("last_c").isNull() | (F.col("last_o.t") > F.col("last_c"))))
    return closes.select(*closed_columns(F.col("key"), F.col("last_o.start_ts"), F.col("t"), strategy))


def closed_columns(key: Column, start: Column, finish: Column, strategy: str) -> list[Column]:
    """The row of a finished episode."""
    return [
        key.alias("sensor_key"),
        start.alias("start_ts"),
        finish.alias("finish_ts"),
        F.lit(True).alias("is_finish"),
        tf.duration_s(start, finish).alias("duration"),
        F.lit(L.LEGACY_EMISSION_KG).alias("carbon_emissions"),
        F.lit(L.CARBON_UNIT).alias("carbon_unit"),
        F.lit(L.TYPE_LEGACY_WINDOW).alias("type"),
        F.lit(L.SYSTEM).alias("system"),
        F.lit(strategy).alias("strategy"),
        F.lit("").alias("message"),
        F.lit(L.MEASURE).alias("measure"),
        tf.format_time(start).alias("time"),
    ]


def legacy_warnings(summaries: DataFrame) -> DataFrame:
    """Window summaries flagged as warnings become open episode rows."""
    w = summaries.where(F.col("is_warning"))
    start = tf.wall_time(F.col("time_stamp") * 1000)
    return w.select(
        F.col("name").alias("sensor_key"),
        start.alias("start_ts"),
        F.lit(False).alias("is_finish"),
        F.lit(L.TYPE_LEGACY_WARNING).alias("type"),
        F.lit(L.SYSTEM).alias("system"),
        F.lit(L.LEGACY_STRATEGY).alias("strategy"),
        F.col("message"),
        F.lit(L.MEASURE).alias("measure"),
        tf.format_time(start).alias("time"),
        F.col("original_data").alias("origin_data"),
    )
