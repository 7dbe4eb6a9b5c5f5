"""Rule configuration as a table; T4 validation.

Rules are data: one row per rule, so one Spark job evaluates many rules.
The key list of a rule may arrive as an array (``keys``) and is exploded
into ``rule_keys(rule_id, key)``; at scale give ``rule_keys`` as its own
table instead.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch import schemas


class RuleError(ValueError):
    """A rule or its sensor list is inconsistent; raised before any job."""


def read_rules(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Rules from JSON lines or parquet, with the declared schema."""
    return spark.read.format(fmt).schema(schemas.RULES).load(path)


def rules_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in schemas.RULES.fields) for r in rows],
        schemas.RULES)


def normalize(rules: DataFrame) -> DataFrame:
    """Defaults for the optional gates.  The warm-up defaults to the quiet
    look-back length (both are 20 minutes in the original rule set)."""
    r = rules
    for name, default in (("on_level", L.ON_LEVEL), ("quiet_s", L.QUIET_S),
                          ("settle_s", L.SETTLE_S)):
        r = r.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    r = r.withColumn("warmup_s", F.coalesce(F.col("warmup_s"), F.col("quiet_s")))
    r = r.withColumn("strategy", F.lower(F.trim(F.col("strategy"))))
    return r


def problems(rules: DataFrame) -> DataFrame:
    """One row per rule problem: ``(rule_id, problem)``."""
    checks = [
        (~F.col("strategy").isin(*L.STRATEGIES) | F.col("strategy").isNull(),
         "unknown strategy"),
        (F.col("rule_id").isNull(), "missing rule_id"),
        (F.col("factor").isNull(), "missing factor"),
        (F.col("program_start").isNull(), "missing program_start"),
        (~F.col("hour_start").between(0, 23) | ~F.col("hour_end").between(0, 23)
         | F.col("hour_start").isNull() | F.col("hour_end").isNull(), "bad hour"),
        (~F.col("minute_start").between(0, 59) | ~F.col("minute_end").between(0, 59)
         | F.col("minute_start").isNull() | F.col("minute_end").isNull(), "bad minute"),
    ]
    per = [rules.where(cond).select("rule_id", F.lit(msg).alias("problem"))
           for cond, msg in checks]
    dup = (rules.groupBy("rule_id").count().where(F.col("count") > 1)
           .select("rule_id", F.lit("duplicate rule_id").alias("problem")))
    out = dup
    for p in per:
        out = out.unionByName(p)
    return out


def overnight(rules: DataFrame) -> DataFrame:
    """Rules whose schedule starts after it ends: never in schedule (a
    warning, not an error, as in the original rule engine)."""
    return rules.where(
        F.col("hour_start") * 60 + F.col("minute_start")
        > F.col("hour_end") * 60 + F.col("minute_end")).select("rule_id")


def validated(rules: DataFrame) -> DataFrame:
    """Normalized rules; raises :class:`RuleError` on the first problem and
    warns of overnight schedules.  Rules are configuration-sized, so the
    checks read a row each."""
    r = normalize(rules)
    bad = problems(r).limit(1).collect()
    if bad:
        raise RuleError(f"rule {bad[0]['rule_id']!r}: {bad[0]['problem']}")
    night = overnight(r).limit(1).collect()
    if night:
        warnings.warn(f"rule {night[0]['rule_id']!r}: a schedule that starts after it ends is "
                      "never in schedule", stacklevel=2)
    return r


def validate_rows(rows: list[dict]) -> None:
    """The same checks as :func:`problems` for rules held by the driver
    (a configuration list), without a Spark job."""
    seen = set()
    for r in rows:
        rid = r.get("rule_id")
        strategy = (r.get("strategy") or "").strip().lower()
        if rid is None:
            raise RuleError("rule None: missing rule_id")
        if rid in seen:
            raise RuleError(f"rule {rid!r}: duplicate rule_id")
        seen.add(rid)
        if strategy not in L.STRATEGIES:
            raise RuleError(f"rule {rid!r}: unknown strategy")
        for f in ("factor", "program_start"):
            if r.get(f) is None:
                raise RuleError(f"rule {rid!r}: missing {f}")
        for f, hi in (("hour_start", 23), ("hour_end", 23), ("minute_start", 59),
                      ("minute_end", 59)):
            v = r.get(f)
            if v is None or not 0 <= v <= hi:
                raise RuleError(f"rule {rid!r}: bad {f.split('_')[0]}")


def from_config(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Validated, normalized rules from a driver-side configuration list."""
    validate_rows(rows)
    return normalize(rules_from_rows(spark, rows))


def explode_keys(rules: DataFrame) -> DataFrame:
    """``rule_keys(rule_id, key)`` from the ``keys`` array of each rule."""
    return rules.select("rule_id", F.explode("keys").alias("key"))
