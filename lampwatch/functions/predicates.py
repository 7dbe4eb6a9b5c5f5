"""P5-P7, P9-P11 as Column builders and small DataFrame steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import timefns as tf
from lampwatch.operators.joins import small_join


def is_on(level: Column | str, on_level=L.ON_LEVEL) -> Column:
    """On iff level >= on_level."""
    return tf.col(level) >= (on_level if isinstance(on_level, Column) else F.lit(on_level))


def is_on_legacy(level: Column | str, on_level=L.LEGACY_ON_LEVEL) -> Column:
    """Legacy rule, on iff level > 0.5."""
    return tf.col(level) > (on_level if isinstance(on_level, Column) else F.lit(on_level))


def whitelisted(readings: DataFrame, keys: DataFrame, key: str = "key",
                list_key: str = "_key") -> DataFrame:
    """P5: readings whose key is listed (semi join; the list is broadcast
    when its size allows)."""
    listed = keys.select(F.col(list_key).cast("string").alias(key)).distinct()
    return small_join(readings, listed, on=key, how="left_semi")


def quiet(last_occupied: Column | str, ts: Column | str, quiet_s) -> Column:
    """No occupied reading in the look-back; one exactly ``quiet_s``
    old still counts as presence."""
    q = quiet_s if isinstance(quiet_s, Column) else F.lit(quiet_s)
    lo = tf.col(last_occupied)
    return lo.isNull() | (tf.micros(lo) + q.cast("bigint") * tf.US < tf.micros(ts))


def settled(last_actuator_ts: Column | str, ts: Column | str, settle_s) -> Column:
    """P10: the last actuator report is more than ``settle_s`` older."""
    s = settle_s if isinstance(settle_s, Column) else F.lit(settle_s)
    return F.coalesce(tf.micros(last_actuator_ts) + s.cast("bigint") * tf.US < tf.micros(ts),
                      F.lit(False))


def warmed_up(program_start: Column | str, ts: Column | str, warmup_s) -> Column:
    """More than ``warmup_s`` after the program start."""
    w = warmup_s if isinstance(warmup_s, Column) else F.lit(warmup_s)
    return tf.micros(program_start) + w.cast("bigint") * tf.US < tf.micros(ts)
