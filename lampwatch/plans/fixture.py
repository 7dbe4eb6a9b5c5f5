"""Fixture views over the driver tables.

The driver's ``events`` table stands in for the two sensor streams and
``part`` for the sensor dimension:

* actuator  = events of type view/click: key = user_id, level = value
* presence  = events of type purchase/signup/error: lux = value,
  occupied = (type = purchase)
* dimension = part: _key = p_partkey, power = p_retailprice
* whitelist = part with p_size <= 40 (leaves some sensors unlisted)

Everything is read lazily; Catalyst pushes the type filters and the column
selection into the parquet scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions.timefns import format_time, micros, wall_ms, wall_time
from lampwatch.sources import rules as R

PROJECT_ID = 1
ACTUATOR_TYPES = ("view", "click")
PRESENCE_TYPES = ("purchase", "signup", "error")
OCCUPIED_TYPE = "purchase"
WHITELIST_MAX_SIZE = 40
PROGRAM_START = dt.datetime(2024, 1, 1, 0, 0, 0)

RECEIVERS = [
    {"type": "user", "id": 7, "name": "facility desk"},
    {"type": "group", "id": 3, "name": "night shift"},
]


def _rule(rule_id: str, strategy: str, **over) -> dict:
    base = dict(
        rule_id=rule_id, project_id=PROJECT_ID, strategy=strategy,
        hour_start=8, minute_start=0, hour_end=18, minute_end=0,
        keys=None, factor=0.6, template_id="42", receivers=RECEIVERS,
        table_id="lighting_episodes", program_start=PROGRAM_START,
        on_level=L.ON_LEVEL, quiet_s=L.QUIET_S, settle_s=L.SETTLE_S, warmup_s=None,
    )
    base.update(over)
    return base


# Mon-Fri 08:00-18:00, factor 0.6, program start 2024-01-01 00:00:00.
# The wide variants (12 h quiet look-back, 1 h settle) make the presence
# gates bind on the fixture, whose median gap per sensor is ~7 h.
RULES = {
    "time_only": _rule("time_only", L.TIME_ONLY),
    "sensor_only": _rule("sensor_only", L.SENSOR_ONLY),
    "sensor_and_time": _rule("sensor_and_time", L.SENSOR_AND_TIME),
    "sensor_only_wide": _rule("sensor_only_wide", L.SENSOR_ONLY, quiet_s=43200, settle_s=3600),
    "sensor_and_time_wide": _rule("sensor_and_time_wide", L.SENSOR_AND_TIME,
                                  quiet_s=43200, settle_s=3600),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table; files are listed anew, so a changed folder is seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_with_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both inputs from one scan of ``events``, tagged (``src`` 0 = actuator,
    1 = presence), with the event type as the row's message."""
    ev = table(spark, sf_dir, "events")
    act = F.col("event_type").isin(*ACTUATOR_TYPES)
    pre = F.col("event_type").isin(*PRESENCE_TYPES)
    return ev.where(act | pre).select(
        F.col("user_id").cast("string").alias("key"), "ts", F.col("event_id").alias("id"),
        F.when(act, 0).otherwise(1).alias("src"),
        F.when(act, F.col("value")).alias("level"),
        F.when(pre, F.col("event_type") == OCCUPIED_TYPE).alias("occupied"),
        F.when(pre, F.col("value")).alias("lux"),
        F.col("event_type").alias("message"))


# rows that set fields of a window summary, by event id: every SET_WARNING[0]-th the flag (to
# whether SET_WARNING[1] divides the id), every SET_FIRST_OPEN-th the first-open time, every
# SET_STRATEGY-th the strategy
SET_WARNING, SET_FIRST_OPEN, SET_STRATEGY = (3, 2), 7, 5


def readings_with_setters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings_with_type`` with rows that set fields of their window's summary."""
    return readings_with_type(spark, sf_dir).select(
        "*", F.when(_m(SET_WARNING[0]), _m(SET_WARNING[1])).alias("set_warning"),
        F.when(_m(SET_FIRST_OPEN), wall_ms("ts")).alias("set_first_open"),
        F.when(_m(SET_STRATEGY), F.concat(F.lit("rule "), F.col("message"))).alias("set_strategy"))


def actuator(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type").isin(*ACTUATOR_TYPES)).select(
        F.col("user_id").cast("string").alias("key"),
        F.lit(PROJECT_ID).alias("project_id"),
        "ts",
        F.col("event_id").alias("id"),
        F.col("value").alias("level"))


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type").isin(*PRESENCE_TYPES)).select(
        F.col("user_id").cast("string").alias("key"),
        F.lit(PROJECT_ID).alias("project_id"),
        "ts",
        F.col("event_id").alias("id"),
        (F.col("event_type") == OCCUPIED_TYPE).alias("occupied"),
        F.col("value").alias("lux"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("_key"),
                    F.col("p_retailprice").alias("power"))


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.where(F.col("p_size") <= WHITELIST_MAX_SIZE)
            .select(F.col("p_partkey").cast("string").alias("_key")))


_RULES: dict[tuple, DataFrame] = {}


def rules(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The fixture rules (all, or the named ones), one DataFrame per session
    and selection so that plans built from it are recognised as equal."""
    key = (spark.sparkContext.applicationId, tuple(names or RULES))
    if key not in _RULES:
        _RULES[key] = R.from_config(spark, [RULES[n] for n in key[1]])
    return _RULES[key]


def rule_keys(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """``rule_id, key``: every rule (or the named ones) lists every
    whitelisted sensor."""
    ids = F.array(*[F.lit(RULES[n]["rule_id"]) for n in names or RULES])
    return whitelist(spark, sf_dir).select(F.explode(ids).alias("rule_id"),
                                           F.col("_key").alias("key"))


def rules_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture rules as a rule file holds them: each with its sensors in
    the ``keys`` array."""
    listed = rule_keys(spark, sf_dir).groupBy("rule_id").agg(
        F.array_sort(F.collect_list("key")).alias("keys"))
    own = rules(spark)
    return own.drop("keys").join(listed, "rule_id").select(*own.columns)


# --- raw JSON messages built from the fixture rows ---------------------------
# Breakage by event id, first match wins (an oracle recomputes the expected
# good and rejected rows from the same columns):
#   % 31 non-JSON text        % 17 no "item"        % 19 "item" without "value"
#   % 41 "item": null          % 23 no key field     % 29 malformed time
# Type variations on good rows: % 7 number sent as text (reads 0),
# % 11 occupancy as boolean (reads absent), % 13 occupancy as a fraction /
# level absent, % 37 time with a fractional tail (tolerated).
BREAK_NOT_JSON, BREAK_NO_ITEM, BREAK_NO_VALUE, BREAK_NULL_ITEM = 31, 17, 19, 41
BREAK_NO_KEY, BREAK_BAD_TIME = 23, 29
VARY_TEXT_NUMBER, VARY_BOOL_OCC, VARY_FRACTION, VARY_TIME_TAIL = 7, 11, 13, 37
BAD_TIME_TEXT = "2024-13-40 08:00:00"


def _m(n: int):
    return (F.col("id") % n) == 0


def _json_str(c) -> "F.Column":
    return F.concat(F.lit('"'), c, F.lit('"'))


def _envelope(value_obj, key_field: str):
    return (F.when(_m(BREAK_NOT_JSON), F.concat(F.lit("garbage-"), F.col("id").cast("string")))
            .when(_m(BREAK_NO_ITEM), F.concat(F.lit('{"other":'), value_obj, F.lit("}")))
            .when(_m(BREAK_NO_VALUE), F.lit('{"item":{"other":1}}'))
            .when(_m(BREAK_NULL_ITEM), F.lit('{"item":null}'))
            .otherwise(F.concat(F.lit('{"item":{"value":'), value_obj, F.lit("}}"))))


def _time_text():
    return (F.when(_m(BREAK_BAD_TIME), F.lit(BAD_TIME_TEXT))
            .when(_m(VARY_TIME_TAIL), F.concat(format_time("ts"), F.lit(".123")))
            .otherwise(format_time("ts")))


def _key_part(key_field: str):
    return F.when(_m(BREAK_NO_KEY), F.lit("")).otherwise(
        F.concat(F.lit(f'"{key_field}":'), _json_str(F.col("key")), F.lit(",")))


def presence_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(msg_id, value)``: presence readings as pub/sub JSON messages."""
    p = presence(spark, sf_dir)
    lux = F.when(_m(VARY_TEXT_NUMBER), _json_str(F.col("lux").cast("string"))).otherwise(
        F.col("lux").cast("string"))
    occ = (F.when(_m(VARY_BOOL_OCC), F.when(F.col("occupied"), "true").otherwise("false"))
           .when(_m(VARY_FRACTION), F.when(F.col("occupied"), "0.5").otherwise("0.0"))
           .otherwise(F.when(F.col("occupied"), "1").otherwise("0")))
    value_obj = F.concat(F.lit("{"), _key_part(L.PRESENCE_KEY_FIELD),
                         F.lit(f'"_projectId":{PROJECT_ID},"lux":'), lux,
                         F.lit(',"occupancy":'), occ,
                         F.lit(',"time":'), _json_str(_time_text()), F.lit("}"))
    return p.select(F.col("id").alias("msg_id"),
                    _envelope(value_obj, L.PRESENCE_KEY_FIELD).alias("value"))


def actuator_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(msg_id, value)``: actuator readings as pub/sub JSON messages."""
    a = actuator(spark, sf_dir)
    level = (F.when(_m(VARY_TEXT_NUMBER), F.concat(F.lit(',"value":'),
                                                   _json_str(F.col("level").cast("string"))))
             .when(_m(VARY_FRACTION), F.lit(""))
             .otherwise(F.concat(F.lit(',"value":'), F.col("level").cast("string"))))
    value_obj = F.concat(F.lit("{"), _key_part(L.ACTUATOR_KEY_FIELD),
                         F.lit(f'"_projectId":{PROJECT_ID}'), level,
                         F.lit(',"time":'), _json_str(_time_text()), F.lit("}"))
    return a.select(F.col("id").alias("msg_id"),
                    _envelope(value_obj, L.ACTUATOR_KEY_FIELD).alias("value"))


LOG_SCHEMA = "sensor_4 string, lux double, ts_ms bigint"


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(msg_id, value, ts)``: presence readings as log messages with an
    epoch-milliseconds time; % 31 is non-JSON text, % 29 has no time."""
    p = presence(spark, sf_dir)
    time = F.when(_m(BREAK_BAD_TIME), F.lit("")).otherwise(
        F.concat(F.lit(',"ts_ms":'), wall_ms("ts").cast("string")))
    msg = F.concat(F.lit(f'{{"{L.PRESENCE_KEY_FIELD}":'), _json_str(F.col("key")), F.lit(',"lux":'),
                   F.col("lux").cast("string"), time, F.lit("}"))
    return p.select(F.col("id").alias("msg_id"), "ts",
                    F.when(_m(BREAK_NOT_JSON), F.concat(F.lit("garbage-"), F.col("id").cast("string")))
                    .otherwise(msg).alias("value"))


# readings of a fast clock: a second of theirs is FAST seconds of the fixture's
FAST = 1000
SHORT_LAG_S, LONG_LAG_S = 3, 20
SHORT_LAG_EVERY, LONG_LAG_EVERY = 2, 5
LAG_SLICES = 12


def lagged_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, src, id, ts, arrival)``: presence readings of a fast clock;
    % 5 arrive 20 s behind their time, of the others % 2 arrive 3 s behind."""
    at = F.floor(micros("ts") / FAST).cast("bigint")
    lag = (F.when(_m(LONG_LAG_EVERY), LONG_LAG_S).when(_m(SHORT_LAG_EVERY), SHORT_LAG_S).otherwise(0)
           .cast("bigint") * 1_000_000)
    return presence(spark, sf_dir).select(
        "key", F.lit(1).alias("src"), "id", wall_time(at).alias("ts"), wall_time(at + lag).alias("arrival"))


def flat_presence_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat log messages ``{"value": {...}}`` (the log-source shape): % 17
    has no ``value``, % 23 no key field, % 19 a NULL key (still present)."""
    p = presence(spark, sf_dir)
    key_part = (F.when(_m(BREAK_NO_KEY), F.lit(""))
                .when(_m(BREAK_NO_VALUE), F.lit(f'"{L.PRESENCE_KEY_FIELD}":null,'))
                .otherwise(F.concat(F.lit(f'"{L.PRESENCE_KEY_FIELD}":'),
                                    _json_str(F.col("key")), F.lit(","))))
    value_obj = F.concat(F.lit("{"), key_part, F.lit('"lux":'), F.col("lux").cast("string"),
                         F.lit(',"ts_ms":'),
                         wall_ms("ts").cast("string"), F.lit("}"))
    msg = F.when(_m(BREAK_NO_ITEM), F.concat(F.lit('{"other":'), value_obj, F.lit("}"))).otherwise(
        F.concat(F.lit('{"value":'), value_obj, F.lit("}")))
    return p.select(F.col("id").alias("msg_id"), msg.alias("value"))
