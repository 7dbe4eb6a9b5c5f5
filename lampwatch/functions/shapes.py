"""Row shapes of the outputs (F10, F11, K2-K4), all as DataFrame columns
built with ``to_json(struct(...))`` -- testable before any sink exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import timefns as tf

CUBE_FIELDS = ["_key", "time", "time_year", "time_month", "time_day", "time_hour",
               "time_minute", "time_second", "time_week", "time_weekday", "type", "system",
               "sensor_key", "strategy", "carbon_emissions", "origin_data", "message",
               "duration", "measure"]


def cube_struct(eps: DataFrame) -> Column:
    """the table row of an episode, calendar parts of its start."""
    cal = tf.calendar_parts("start_ts")
    return F.struct(
        F.col("sensor_key").alias("_key"), F.col("time"), *cal,
        F.col("type"), F.col("system"), F.col("sensor_key"), F.col("strategy"),
        F.col("carbon_emissions"), F.col("origin_data"), F.col("message"),
        F.coalesce(F.col("duration"), F.lit(0).cast("bigint")).alias("duration"),
        F.col("measure"))


def cube_rows(eps: DataFrame) -> DataFrame:
    """K2: finished episodes as table rows (columns plus ``cube_json``)."""
    done = eps.where(F.col("is_finish"))
    return done.select("rule_id", "open_ts", "project_id", cube_struct(done).alias("_c")).select(
        "rule_id", "open_ts", "project_id", "_c.*", F.to_json("_c").alias("cube_json"))


def channel(db: int | str, cube_id: Column | str, project_id: Column | str) -> Column:
    """Publish channel of a rule's records: ``{db}-RT-{cube}-{project}-records``."""
    return F.concat(F.lit(f"{db}-RT-"), tf.col(cube_id), F.lit("-"),
                    tf.col(project_id).cast("string"), F.lit(L.CHANNEL_SUFFIX))


def publish_envelope(records: DataFrame, source_id: Column | str,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """K4: every record (open and finished) as
    ``{item:{key,sourceId,value,timestamp},key,time}``; ``timestamp`` is the
    episode start in epoch milliseconds.  ``keep`` names columns of the
    records to carry along."""
    src = F.col(source_id) if isinstance(source_id, str) else source_id
    item = F.struct(F.col("sensor_key").alias("key"), src.alias("sourceId"),
                    cube_struct(records).alias("value"),
                    tf.wall_ms("start_ts").alias("timestamp"))
    env = F.struct(item.alias("item"), F.col("sensor_key").alias("key"), F.col("time"))
    return records.select("rule_id", "sensor_key", "open_ts", "is_finish", *keep,
                          F.to_json(env).alias("value"))


def alert_text(key: Column | str) -> Column:
    """the warning sentence of a sensor."""
    return F.concat(F.lit(L.ALERT_TEXT_PREFIX), tf.col(key), F.lit(L.ALERT_TEXT_SUFFIX))


def alert_body(key: Column | str, datetime_text: Column | str, receivers: Column | str) -> Column:
    """K3 / K6: notification body for one alert (JSON text)."""
    sender = F.struct(F.lit(L.SENDER_TYPE).alias("type"), F.lit(L.SENDER_ID).alias("id"),
                      F.lit(L.SENDER_NAME).alias("name"))
    params = F.struct(F.lit(L.ALERT_NAME).alias("name"), alert_text(key).alias("message"),
                      tf.col(datetime_text).alias("datetime"))
    return F.to_json(F.struct(sender.alias("sender"), tf.col(receivers).alias("receivers"),
                              F.lit(L.PRIORITY).alias("priority"), params.alias("parameters")))


def alert_outbox(opens: DataFrame, rules: DataFrame) -> DataFrame:
    """K3: one alert per opened episode, addressed by the rule's template
    and receivers (rules are configuration-sized: broadcast)."""
    r = rules.select("rule_id", "template_id", "receivers")
    j = opens.join(F.broadcast(r), "rule_id")
    return j.select("rule_id", "sensor_key", "open_ts", "template_id",
                    alert_body("sensor_key", "time", "receivers").alias("body"))
