"""Sensor dimension (power per lamp) and its completeness check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampwatch.operators.joins import small_join


def sensor_power(dim: DataFrame, key: str = "_key", power: str = "power") -> DataFrame:
    """S3: ``(_key, power)``, one row per key as in a map (of repeated keys the
    largest power counts); missing power counts as 0 W."""
    return (dim.groupBy(F.col(key).cast("string").alias("_key"))
            .agg(F.coalesce(F.max(F.col(power).cast("double")), F.lit(0.0)).alias("power")))


def restrict(dim: DataFrame, rule_keys: DataFrame) -> DataFrame:
    """Only sensors some rule lists (semi join, rule keys broadcast when
    their size allows)."""
    keys = rule_keys.select(F.col("key").alias("_key")).distinct()
    return small_join(dim, keys, on="_key", how="left_semi")


def missing_keys(dim: DataFrame, rule_keys: DataFrame) -> DataFrame:
    """S4 check: ``(rule_id, key, reason)`` for every listed key without a
    dimension row, and every key listed twice by the same rule.  A key that
    repeats in the dimension is no problem: ``sensor_power`` keeps one row."""
    listed = rule_keys.select("rule_id", "key")
    dims = dim.select(F.col("_key").alias("key"))
    absent = (listed.join(dims, on="key", how="left_anti")
              .select("rule_id", "key", F.lit("missing").alias("reason")))
    twice = (listed.groupBy("rule_id", "key").count().where(F.col("count") > 1)
             .select("rule_id", "key", F.lit("duplicate in rule").alias("reason")))
    return absent.unionByName(twice)


def require_complete(dim: DataFrame, rule_keys: DataFrame) -> None:
    """Fail fast when the dimension does not cover the rules' key lists."""
    bad = missing_keys(dim, rule_keys).limit(1).collect()
    if bad:
        b = bad[0]
        raise ValueError(f"rule {b['rule_id']!r}: sensor {b['key']!r} {b['reason']}")


def require_known(dim: DataFrame, rule_keys: DataFrame) -> None:
    """S4 as a barrier: fail unless the dimension holds every listed sensor.
    An action of its own, so no pruning can take it away; one anti join of
    the key lists, which ends at the first row."""
    listed = rule_keys.select(F.col("key").cast("string").alias("_key"))
    bad = small_join(listed, dim.select("_key"), on="_key", how="left_anti").limit(1).collect()
    if bad:
        raise ValueError(f"sensor missing in the dimension: {bad[0]['_key']!r}")
