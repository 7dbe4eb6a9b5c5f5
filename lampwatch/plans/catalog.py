"""Named queries over the fixture views: one per operator of the survey
inventory.  Each takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of the matching oracle SQL (``plans/oracle.py``).
All queries read the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampwatch import labels as L
from lampwatch.functions import decode as D
from lampwatch.functions import predicates as P
from lampwatch.functions import timefns as tf
from lampwatch.functions import shapes as S
from lampwatch.operators import episodes as E
from lampwatch.operators import legacy as LG
from lampwatch.operators import presence as A
from lampwatch.operators import suppress as SUP
from lampwatch.plans import fixture as fx
from lampwatch.plans import streams as ST
from lampwatch.session import scratch_path
from lampwatch.sources import dimension as dim
from lampwatch.sources import rules as R
from lampwatch.sources import snapshot as snap
from lampwatch.streaming import job as J

Query = Callable[[SparkSession, str], DataFrame]
SNAPSHOT_CUT = "2024-01-15 00:00:00"
WINDOW_WIDTH = "1 hour"     # tumbling presence window of the legacy rule
FOLD_WIDTH = "1 day"        # A1 fold per sensor and day
ALERT_START_S = 1704240000  # 2024-01-03 00:00:00 UTC, epoch seconds (F9 scales it)

EPISODE_COLUMNS = ["rule_id", "sensor_key", "strategy", "open_ts", "start_ts", "finish_ts",
                   "is_finish", "duration", "carbon_emissions", "carbon_unit", "type",
                   "system", "message", "measure", "time", "origin_data"]


# --- S1 S3 S4 S5 --------------------------------------------------------------

def snapshot_latest(spark, sf):
    return snap.latest_per_key(fx.actuator(spark, sf).select("key", "ts", "id", "level"))


def snapshot_then_changes(spark, sf):
    return snap.snapshot_then_changes(
        fx.actuator(spark, sf).select("key", "ts", "id", "level"), SNAPSHOT_CUT)


def dim_power(spark, sf):
    rules = fx.rules(spark, ["time_only"])
    return dim.restrict(dim.sensor_power(fx.dimension(spark, sf)),
                        fx.rule_keys(spark, sf, ["time_only"]))


def dim_missing_keys(spark, sf):
    """Rule ``inventory`` lists every sensor that reports, rule ``doubled``
    every tenth known sensor twice; the dimension holds only the whitelisted
    sensors, every row twice (repeated rows are one sensor)."""
    d = fx.dimension(spark, sf).join(fx.whitelist(spark, sf), "_key", "left_semi")
    d = dim.sensor_power(d.unionByName(d))
    tenth = d.where(F.col("_key").cast("bigint") % 10 == 0).select(
        F.lit("doubled").alias("rule_id"), F.col("_key").alias("key"))
    listed = (fx.actuator(spark, sf).select("key").distinct()
              .select(F.lit("inventory").alias("rule_id"), "key"))
    return dim.missing_keys(d, listed.unionByName(tenth).unionByName(tenth))


def rules_exploded(spark, sf):
    rules = fx.rules(spark)
    rk = fx.rule_keys(spark, sf)
    power = dim.sensor_power(fx.dimension(spark, sf)).withColumnRenamed("_key", "key")
    return (rk.join(F.broadcast(rules.select("rule_id", "strategy", "factor")), "rule_id")
            .join(power, "key", "left")
            .select("rule_id", "strategy", "key", "power", "factor"))


# --- P1-P4 F5 -------------------------------------------------------------------

def decode_presence(spark, sf):
    good, _ = D.decode_presence(fx.presence_messages(spark, sf))
    return good


def decode_actuator(spark, sf):
    good, _ = D.decode_actuator(fx.actuator_messages(spark, sf))
    return good


def decode_rejects(spark, sf):
    _, bad_p = D.decode_presence(fx.presence_messages(spark, sf))
    _, bad_a = D.decode_actuator(fx.actuator_messages(spark, sf))
    return (bad_p.select(F.lit("presence").alias("source"), "msg_id", "reason")
            .unionByName(bad_a.select(F.lit("actuator").alias("source"), "msg_id", "reason")))


def valid_flat(spark, sf):
    return D.valid_flat(fx.flat_presence_messages(spark, sf), L.PRESENCE_KEY_FIELD).select("msg_id")


def log_decode(spark, sf):
    """Good and rejected log messages."""
    good, bad = J.decode_log(fx.log_messages(spark, sf).drop("ts"), fx.LOG_SCHEMA, "ts_ms", zone="UTC",
                             keep=("msg_id",))
    none = F.lit(None)
    return good.select("msg_id", F.col("sensor_4").alias("key"), "lux", "ts",
                       none.cast("string").alias("reason")).unionByName(
        bad.select("msg_id", none.cast("string").alias("key"), none.cast("double").alias("lux"),
                   none.cast("timestamp_ntz").alias("ts"), "reason"))


# --- P5-P11 F2 ------------------------------------------------------------------

def whitelist(spark, sf):
    return P.whitelisted(fx.actuator(spark, sf), fx.whitelist(spark, sf)).select(
        "key", "ts", "id", "level")


def threshold_flags(spark, sf):
    return fx.actuator(spark, sf).select(
        "key", "id", "ts", "level",
        P.is_on("level").alias("is_on"),
        P.is_on_legacy("level").alias("legacy_on"))


def in_schedule(spark, sf):
    r = fx.RULES["time_only"]
    return fx.actuator(spark, sf).select(
        "key", "id", "ts",
        tf.in_schedule("ts", r["hour_start"], r["minute_start"], r["hour_end"],
                       r["minute_end"]).alias("in_schedule"))


def next_start_gap(spark, sf):
    r = fx.RULES["time_only"]
    return fx.actuator(spark, sf).select(
        "key", "id", "ts",
        tf.next_start_gap_s("ts", r["hour_start"], r["minute_start"]).alias("gap_s"))


def _presence_state(spark, sf, rule: str) -> DataFrame:
    rules = fx.rules(spark, [rule])
    st, _ = E.state(fx.actuator(spark, sf), fx.presence(spark, sf),
                    fx.rule_keys(spark, sf, [rule]), rules)
    return st.where(F.col("src") == E.SRC_PRESENCE).join(
        F.broadcast(rules.select(*E.PARAMS).drop("strategy")), "rule_id")


def asof_actuator(spark, sf):
    st = _presence_state(spark, sf, "sensor_only")
    return st.select("key", "id", "ts",
                     F.col("a.ts").alias("a_ts"), F.col("a.id").alias("a_id"),
                     F.col("a.level").alias("a_level"))


def quiet_lookback(spark, sf):
    st = _presence_state(spark, sf, "sensor_only")
    return st.select("key", "id", "ts", F.col("o").alias("last_occupied_ts"),
                     P.quiet("o", "ts", F.col("quiet_s")).alias("quiet"))


def settle_warmup(spark, sf):
    st = _presence_state(spark, sf, "sensor_only_wide")
    return st.select("key", "id", "ts",
                     P.settled(F.col("a.ts"), "ts", F.col("settle_s")).alias("settled"),
                     P.warmed_up("program_start", "ts", F.col("warmup_s")).alias("warm"))


# --- T1-T5 ----------------------------------------------------------------------

def episodes_for(spark, sf, names: list[str] | None = None) -> DataFrame:
    rules = fx.rules(spark, names)
    return E.episodes(fx.actuator(spark, sf), fx.presence(spark, sf),
                      fx.rule_keys(spark, sf, names), rules,
                      fx.dimension(spark, sf))


def _episodes_query(name: str) -> Query:
    def q(spark, sf):
        return episodes_for(spark, sf, [name]).select(*EPISODE_COLUMNS)
    q.__name__ = f"episodes_{name}"
    return q


def episodes_by_rule(spark, sf):
    return episodes_for(spark, sf).select(*EPISODE_COLUMNS)


def episodes_from_rule_file(spark, sf):
    """S5 end to end: rules with their key arrays written as a JSON rule
    file, read back, validated, exploded and evaluated."""
    path = scratch_path(spark, "rules")
    fx.rules_with_keys(spark, sf).write.json(path)
    rules = R.validated(R.read_rules(spark, path))
    return E.episodes(fx.actuator(spark, sf), fx.presence(spark, sf), R.explode_keys(rules), rules,
                      fx.dimension(spark, sf)).select(*EPISODE_COLUMNS)


def episode_changelog(spark, sf):
    return E.changelog(episodes_for(spark, sf)).select(
        "rule_id", "sensor_key", "open_ts", "is_finish", "row_ts", "route", "duration",
        "carbon_emissions")


def episode_calendar(spark, sf):
    return episodes_for(spark, sf).select(
        "rule_id", "sensor_key", "open_ts", "time", *tf.calendar_parts("start_ts"))


# --- F10 F11 K2-K4 ---------------------------------------------------------------

CALENDAR = ["time_year", "time_month", "time_day", "time_hour", "time_minute", "time_second",
            "time_week", "time_weekday"]


def cube_rows(spark, sf):
    rows = S.cube_rows(episodes_for(spark, sf))
    fields = [f for f in rows.schema.fields if f.name in S.CUBE_FIELDS]
    again = F.from_json("cube_json", T.StructType(fields))  # the JSON holds every field of the row
    return rows.select(
        "rule_id", "open_ts", "_key", "time", *CALENDAR, "type", "system", "sensor_key",
        "strategy", "carbon_emissions", "origin_data", "message", "duration", "measure",
        (F.struct(*[F.col(f.name) for f in fields]) == again).alias("json_equal"))


_VALUE = ", ".join(
    f"{f}: " + ("int" if f in CALENDAR else "bigint" if f == "duration"
                else "double" if f == "carbon_emissions" else "string") for f in S.CUBE_FIELDS)
ENVELOPE = (f"item struct<key: string, sourceId: string, value: struct<{_VALUE}>, timestamp: bigint>, "
            "key string, time string")


def publish_envelope(spark, sf):
    rules = fx.rules(spark)
    records = E.changelog(episodes_for(spark, sf)).join(
        F.broadcast(rules.select("rule_id", "table_id")), "rule_id")
    env = S.publish_envelope(records, "table_id")
    # parsed once, behind a generator (see functions/decode.py), every field read back
    e = env.select("rule_id", "sensor_key", "open_ts", "is_finish",
                   F.inline(F.array(F.struct(F.from_json("value", ENVELOPE).alias("e")))))
    return e.select(
        "rule_id", "sensor_key", "open_ts", "is_finish",
        F.col("e.key").alias("env_key"), F.col("e.time").alias("env_time"),
        F.col("e.item.key").alias("item_key"), F.col("e.item.sourceId").alias("source_id"),
        F.col("e.item.timestamp").alias("ts_ms"),
        *[F.col(f"e.item.value.{f}").alias(f"value_{f.lstrip('_')}") for f in S.CUBE_FIELDS])


def alert_outbox(spark, sf):
    rules = fx.rules(spark)
    out = S.alert_outbox(episodes_for(spark, sf), rules)
    b = F.col("body")
    return out.select(
        "rule_id", "sensor_key", "open_ts", "template_id",
        F.get_json_object(b, "$.priority").alias("priority"),
        F.get_json_object(b, "$.sender.name").alias("sender_name"),
        F.get_json_object(b, "$.parameters.message").alias("message"),
        F.get_json_object(b, "$.parameters.datetime").alias("datetime"),
        F.get_json_object(b, "$.receivers").alias("receivers"),
        F.get_json_object(b, "$.sender.type").alias("sender_type"),
        F.get_json_object(b, "$.sender.id").alias("sender_id"),
        F.get_json_object(b, "$.parameters.name").alias("alert_name"))


# --- A1-A4 F12 T7 T8 P12 K5 --------------------------------------------------------

def _readings_with_message(spark, sf) -> DataFrame:
    return fx.readings_with_type(spark, sf)


def presence_fold(spark, sf):
    return A.tumbling(fx.presence(spark, sf), FOLD_WIDTH).select(
        "key", "window_start", "ts", "occupied", "lux", "n")


def presence_tumbling(spark, sf):
    return A.tumbling(fx.presence(spark, sf), WINDOW_WIDTH)


def presence_rolling(spark, sf):
    return A.rolling(A.tumbling(fx.presence(spark, sf), WINDOW_WIDTH), L.QUIET_S).select(
        "key", "window_start", "ts", "occupied_roll", "lux_roll")


SUMMARY_COLUMNS = ["key", "window_start", "name", "time_stamp", "time_str", "is_warning",
                   "opening_aperture", "sensor_occ", "sensor_lux", "message",
                   "first_open_time", "strategy"]


def _summaries(spark, sf) -> DataFrame:
    return A.window_summary(_readings_with_message(spark, sf), WINDOW_WIDTH)


def _original(json: str) -> list:
    """The fields of an evidence JSON, read back."""
    kinds = {"OpeningAperture": ("opening", "double"), "SensorOCC": ("occ", "boolean"),
             "SensorLUX": ("lux", "double")}
    return [F.get_json_object(json, f"$.{f}").cast(kind).alias(f"original_{name}")
            for f, (name, kind) in kinds.items()]


def window_summary(spark, sf):
    return _summaries(spark, sf).select(*SUMMARY_COLUMNS, *_original("original_data"))


def window_setters(spark, sf):
    """A4 as setters: rows set the flag, the first-open time and the strategy."""
    return A.window_summary(fx.readings_with_setters(spark, sf), WINDOW_WIDTH).select(
        "key", "window_start", "name", "is_warning", "first_open_time", "strategy", *_original("original_data"))


LEGACY_COLUMNS = ["sensor_key", "start_ts", "finish_ts", "is_finish", "duration",
                  "carbon_emissions", "carbon_unit", "type", "system", "strategy", "message",
                  "measure", "time"]


def legacy_episodes(spark, sf):
    return LG.legacy_episodes(fx.actuator(spark, sf), fx.presence(spark, sf), WINDOW_WIDTH,
                              L.QUIET_S).select(*LEGACY_COLUMNS)


def legacy_warnings(spark, sf):
    return LG.legacy_warnings(_summaries(spark, sf)).select(
        "sensor_key", "start_ts", "is_finish", "type", "system", "strategy", "message",
        "measure", "time", *_original("origin_data"))


def alert_suppressed(spark, sf):
    warn = _summaries(spark, sf).where(F.col("is_warning")).select(
        F.col("name").alias("key"), "time_stamp")
    sent = SUP.suppress(warn, ALERT_START_S)
    return suppressed_alerts(spark, sent)


def suppressed_alerts(spark, sent: DataFrame) -> DataFrame:
    """Sent alerts with the notification body that each posts (K3), read back."""
    dt_text = tf.format_time(tf.wall_time(F.col("time_stamp") * 1000))
    receivers = fx.rules(spark, ["time_only"]).select("receivers")  # one row of configuration
    out = sent.join(F.broadcast(receivers)).select(
        "key", "time_stamp", dt_text.alias("datetime"), S.alert_text("key").alias("message"),
        S.alert_body("key", dt_text, "receivers").alias("b"))
    fields = {"priority": "priority", "sender_name": "sender.name", "sender_type": "sender.type",
              "sender_id": "sender.id", "alert_name": "parameters.name", "body_message": "parameters.message",
              "body_datetime": "parameters.datetime", "receivers": "receivers"}
    return out.select("key", "time_stamp", "datetime", "message",
                      *[F.get_json_object("b", f"$.{path}").alias(name) for name, path in fields.items()])


QUERIES: dict[str, Query] = {
    "snapshot_latest": snapshot_latest,
    "snapshot_then_changes": snapshot_then_changes,
    "dim_power": dim_power,
    "dim_missing_keys": dim_missing_keys,
    "rules_exploded": rules_exploded,
    "decode_presence": decode_presence,
    "decode_actuator": decode_actuator,
    "decode_rejects": decode_rejects,
    "valid_flat": valid_flat,
    "log_decode": log_decode,
    "whitelist": whitelist,
    "threshold_flags": threshold_flags,
    "in_schedule": in_schedule,
    "next_start_gap": next_start_gap,
    "asof_actuator": asof_actuator,
    "quiet_lookback": quiet_lookback,
    "settle_warmup": settle_warmup,
    **{f"episodes_{n}": _episodes_query(n) for n in fx.RULES},
    "episodes_by_rule": episodes_by_rule,
    "episodes_from_rule_file": episodes_from_rule_file,
    "episode_changelog": episode_changelog,
    "episode_calendar": episode_calendar,
    "cube_rows": cube_rows,
    "publish_envelope": publish_envelope,
    "alert_outbox": alert_outbox,
    "presence_fold": presence_fold,
    "presence_tumbling": presence_tumbling,
    "presence_rolling": presence_rolling,
    "window_summary": window_summary,
    "window_setters": window_setters,
    "legacy_episodes": legacy_episodes,
    "legacy_warnings": legacy_warnings,
    "alert_suppressed": alert_suppressed,
    "stream_episodes_by_rule": ST.stream_episodes_by_rule,
    "stream_handover": ST.stream_handover,
    "stream_handover_drop": ST.stream_handover_drop,
    "stream_handover_restart": ST.stream_handover_restart,
    "stream_round_trip": ST.stream_round_trip,
    "stream_messages": ST.stream_messages,
    "stream_snapshot_seeded": ST.stream_snapshot_seeded,
    "stream_log": ST.stream_log,
    "stream_legacy_episodes": ST.stream_legacy_episodes,
    "stream_late": ST.stream_late,
    "stream_alert_suppressed": ST.stream_alert_suppressed,
}
