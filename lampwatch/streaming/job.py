"""Streaming episodes: sources (S2, W1, W2), the stateful operator (J1,
T1-T3, T6), sinks (K1-K4 via ``foreachBatch``) and the checkpoint and
trigger settings (W3).

A run reads typed readings, or raw messages that it decodes itself (P1-P3);
the messages that cannot be decoded leave through the same operator and the
same commit as the changes.  A hand-over (T6) is one more stream: its rows
fill the state store in the first micro-batch, whether their sensors report
or not, and :func:`live_state` takes the states out of a checkpoint again.

Plan: two reading streams -> tag + union (J1) -> the sensor's list of rules
(static) -> ``groupBy(shard)`` stateful function -> static power dimension ->
episode columns -> ``foreachBatch``.  One shuffle of each reading, by a hash
of its sensor; state is one row per shard of sensors, whether a run starts
empty, from a hand-over or drops late rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lampwatch import labels as L
from lampwatch import schemas
from lampwatch.functions import decode as D
from lampwatch.functions import shapes as S
from lampwatch.functions import timefns as tf
from lampwatch.operators import episodes as E
from lampwatch.operators.joins import fits_broadcast, small_join
from lampwatch.sources import snapshot as snap
from lampwatch.sources.dimension import require_known
from lampwatch.session import staged
from lampwatch.streaming.processor import (INITIAL, OUTPUT, REJECT_COLUMNS, REJECTS, RULE_SEP,
                                           SENSOR_COLUMNS, SHARD_STATE, SHARDS, STATE, rule_params,
                                           shard_fn)

# Trigger and checkpoint cadence of a live run
LIVE_TRIGGER = "10 seconds"
# groups that undecodable messages are dealt to
DEAD_GROUPS = 64
# event time of seed rows: theirs must not hold back the watermark of the inputs; within pandas' years (to 2262)
SEED_TIME = "2262-01-01 00:00:00"


# --- sources -------------------------------------------------------------------

def file_source(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_trigger: int | None = 1) -> DataFrame:
    """Testable twin of the log source: files appear in a folder, oldest
    first; ``files_per_trigger`` bounds a micro-batch."""
    r = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


def log_source(spark: SparkSession, servers: str, topic: str, group: str | None = None,
               offsets_per_trigger: int = 1_000_000) -> DataFrame:
    """Raw messages (``value``) of a Kafka topic from the earliest offset;
    ``offsets_per_trigger`` bounds each micro-batch, the first one too.  Needs
    the Kafka connector on the classpath; ``file_source`` is its twin."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest")
         .option("maxOffsetsPerTrigger", offsets_per_trigger))
    if group:
        r = r.option("kafka.group.id", group)
    return r.load()


def decode_log(raw: DataFrame, value_schema, ts_field: str, zone: str = L.ZONE,
               keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """JSON messages (``value``) of any source, batch or streaming, as
    ``(good, rejected)``.  Good rows hold the fields of ``value_schema`` and
    ``ts``, the wall time in ``zone`` of the epoch-milliseconds field
    ``ts_field``; rejected rows hold the raw message and a reason
    (``not_json``: no JSON object; ``no_time``: the time field is missing or
    no number).  ``keep`` names columns of ``raw`` to carry along."""
    parsed = raw.select(*keep, F.col("value").cast("string").alias("_raw")).select(
        "*", F.inline(F.array(F.struct(F.from_json("_raw", value_schema).alias("_v"),
                                       F.json_object_keys("_raw").isNotNull().alias("_json")))))
    reason = (F.when(~F.col("_json"), "not_json")
              .when(F.col("_v").getField(ts_field).isNull(), "no_time"))
    judged = parsed.withColumn("_reason", reason)
    good = judged.where(F.col("_reason").isNull()).select(
        *keep, "_v.*", tf.local_time(F.col("_v").getField(ts_field), zone).alias("ts"))
    bad = judged.where(F.col("_reason").isNotNull()).select(
        *keep, F.col("_raw").alias("value"), F.col("_reason").alias("reason"))
    return good, bad


def log_readings(raw: DataFrame, value_schema, ts_field: str, zone: str = L.ZONE,
                 disorder: str = f"{L.DISORDER_S} seconds") -> DataFrame:
    """S2 + W2: the good rows of a log with the bounded-disorder watermark."""
    return with_watermark(decode_log(raw, value_schema, ts_field, zone)[0], disorder)


def with_watermark(df: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Ascending event time per input (a delay of 0), on ``event_time``
    (watermarks need TIMESTAMP; readings keep their wall-clock ``ts``).
    With the processor in time mode ``None`` nothing is dropped as late:
    rows apply in arrival order (W4 ``apply``)."""
    return (df.withColumn("event_time", F.timestamp_micros(tf.micros("ts")))
            .withWatermark("event_time", delay))


LATE = T.StructType([T.StructField("key", T.StringType()), T.StructField("src", T.IntegerType()),
                     T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                     T.StructField("late", T.BooleanType())])


def split_late(rows: DataFrame, groups: int = DEAD_GROUPS) -> DataFrame:
    """Readings ``(key, src, id, ts, event_time)`` of a watermarked
    stream, each with ``late``: whether its event time lies before the
    watermark of its micro-batch, that is more than the allowed disorder
    before the latest event time of the micro-batches before.

    An event-time operator drops such rows without a trace.  Here they are
    seen, because an operator without a timeout gets every row and can still
    read the watermark.  Readings are dealt over ``groups`` by id, so a hot
    sensor is no hot group; a group's state counts its late readings."""
    dealt = rows.select("key", F.col("src").cast("int").alias("src"), F.col("id").cast("bigint").alias("id"), "ts",
                        F.unix_micros("event_time").alias("at"), "event_time",
                        F.pmod(F.xxhash64("src", "id"), F.lit(groups)).alias("deal"))

    def judge(_, frames, state):
        passed = state.getCurrentWatermarkMs() * 1000
        count = state.get[0] if state.exists else 0
        for f in frames:
            late = f["at"] < passed
            count += int(late.sum())
            yield f.assign(late=late)[["key", "src", "id", "ts", "late"]]
        state.update((count,))

    return dealt.groupBy("deal").applyInPandasWithState(
        judge, outputStructType=LATE, stateStructType="late bigint", outputMode="append", timeoutConf="NoTimeout")


# --- operator ------------------------------------------------------------------

def episode_changes(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
                    rules: DataFrame, seeds: DataFrame | None = None,
                    late_policy: str = "apply", shards: int = SHARDS) -> DataFrame:
    """Output rows of the stateful function (one per open, one per finish).

    Grouped by shard, a hash of the sensor: a reading is shuffled once, with
    the list of the rules that read its sensor (as many as there are rules at
    most); one call serves all rules and sensors of a shard.  A restart names
    the same number of ``shards``.

    T6 ``seeds`` (:func:`seed_source`): the hand-over's states, one row per
    sensor, read once and kept in the state store from then on.  A restart
    names the same seeds, whose files the checkpoint knows as read; without
    them Spark refuses the checkpoint (it has another number of sources), so
    a hand-over is never lost in silence.

    W4 ``late_policy``: ``apply`` (default) applies every row in arrival
    order, as the original operator did; ``drop`` sets an event-time timeout,
    under which rows older than the previous micro-batch's watermark
    (``with_watermark`` on the inputs) are dropped before they reach the
    state."""
    if late_policy not in ("apply", "drop"):
        raise ValueError(f"late_policy must be 'apply' or 'drop', not {late_policy!r}")
    keep = ("event_time",) if late_policy == "drop" else ()
    rows = E.readings(actuator, presence, keep).withColumn("dead", F.lit(False))
    return _changes(rows, rule_keys, rules, seeds, keep, shards=shards)


def message_changes(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
                    rules: DataFrame, seeds: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """S2, P1-P3, J1 and T1-T3 in one pass over raw messages ``(msg_id,
    value)`` of both inputs: the rows of :func:`episode_changes` and, with
    ``msg_id, source, reason, value`` set, the messages that could not be
    decoded.  A message is parsed and shuffled once, whichever way it goes;
    rows apply in arrival order (W4 ``apply``)."""
    none = F.lit(None)

    def tagged(judged: DataFrame, source: str, src: int, level, occupied, lux) -> DataFrame:
        dead = F.col("reason").isNotNull()
        group = F.pmod(F.xxhash64("msg_id"), F.lit(DEAD_GROUPS)).cast("string")
        return judged.select(
            F.when(dead, group).otherwise(F.col("key").cast("string")).alias("key"), dead.alias("dead"), "ts",
            F.col("msg_id").cast("bigint").alias("id"), F.lit(src).alias("src"),
            level.cast("double").alias("level"), occupied.cast("boolean").alias("occupied"),
            lux.cast("double").alias("lux"), F.lit(source).alias("source"), "reason",
            F.when(dead, F.col("value")).alias("value"))

    rows = tagged(D.judged_actuator(actuator), "actuator", E.SRC_ACTUATOR, F.col("level"), none, none).unionByName(
        tagged(D.judged_presence(presence), "presence", E.SRC_PRESENCE, none, F.col("occupied"), F.col("lux")))
    return _changes(rows, rule_keys, rules, seeds, (), rejects=True, shards=shards)


def _changes(rows: DataFrame, rule_keys: DataFrame, rules: DataFrame, seeds: DataFrame | None,
             keep: tuple[str, ...], rejects: bool = False, shards: int = SHARDS) -> DataFrame:
    params = rule_params(rules)   # rules are configuration: shipped as a dict
    # grouped once for all micro-batches
    listed = staged(rule_keys.select(F.col("key").cast("string").alias("key"), "rule_id")
              .join(F.broadcast(rules.select("rule_id")), "rule_id").distinct()
              .groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("rule_id")), RULE_SEP)
                                  .alias("rules"))
              .withColumn("dead", F.lit(False)), "rule-lists")
    out = T.StructType([*OUTPUT.fields, *(REJECTS.fields if rejects else [])])
    cols = [*SENSOR_COLUMNS, *(REJECT_COLUMNS if rejects else []), *keep]
    bound = (small_join(rows, listed, ["key", "dead"], "left")
             .where(F.col("rules").isNotNull() | F.col("dead"))
             .withColumn("seed", F.lit(None).cast("string")).select(cols))
    if seeds is not None:
        # (a number: a missing one would make the column of all rows a column of doubles)
        given = {"key": F.col("key"), "seed": F.col("seed"), "dead": F.lit(False), "id": F.lit(0).cast("bigint"),
                 "src": F.lit(E.SRC_STATE), "event_time": F.col("event_time")}
        bound = bound.unionByName(seeds.select(
            [given[c].alias(c) if c in given else F.lit(None).cast(bound.schema[c].dataType).alias(c)
             for c in cols]))
    dealt = bound.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard", "dead").applyInPandasWithState(
        shard_fn(params, rejects), outputStructType=out, stateStructType=SHARD_STATE,
        outputMode="append", timeoutConf="EventTimeTimeout" if keep else "NoTimeout")


def episode_records(changes: DataFrame, rules: DataFrame, dim: DataFrame,
                    rule_keys: DataFrame | None = None) -> DataFrame:
    """Episode rows of the changes (the batch ``finish`` columns) plus
    ``row_ts``, the time of the reading that emitted the row.  S4: given the
    ``rule_keys``, fails unless the dimension holds every listed sensor."""
    if rule_keys is not None:
        require_known(dim, rule_keys)
    shaped = changes.select(
        "rule_id", "key", F.col("open_ts").alias("ts"), F.col("open_id").alias("id"),
        "start_ts", "finish_ts",
        F.struct(F.col("a_ts").alias("ts"), F.lit(None).cast("bigint").alias("id"),
                 F.col("a_level").alias("level")).alias("a"),
        "lux", "occupied")
    eps = E.finish(shaped.join(F.broadcast(rules.select(*E.PARAMS)), "rule_id"), dim)
    return eps.withColumn("row_ts", F.coalesce("finish_ts", "open_ts"))


# --- states in and out of a run (T6) --------------------------------------------

SEED_SCHEMA = "key string, seed string"


def write_seeds(state: DataFrame, path: str) -> None:
    """The states of a hand-over (``INITIAL`` rows) as a folder that
    :func:`seed_source` reads: one row per sensor, with the states of all
    rules that list it."""
    one = F.struct("rule_id", *STATE.fieldNames())
    (state.groupBy("key").agg(F.to_json(F.collect_list(one)).alias("seed"))
     .write.mode("overwrite").parquet(path))


def seed_source(spark: SparkSession, path: str) -> DataFrame:
    """The hand-over as a stream: all of it in the first micro-batch."""
    rows = file_source(spark, path, SEED_SCHEMA, files_per_trigger=None)
    return (rows.withColumn("event_time", F.lit(SEED_TIME).cast("timestamp"))
            .withWatermark("event_time", "0 seconds"))


def live_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The states that a live run left in its checkpoint (after its last
    committed micro-batch), as ``INITIAL`` rows: what a batch run
    (``episodes(initial_state=...)``) or another live run goes on from."""
    held = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
    rows = held.select("keys", F.inline(F.arrays_zip("at", "rule_id", *STATE.fieldNames())))
    rows = rows.withColumn("key", F.element_at("keys", F.col("at") + 1))
    return rows.select([F.col(f.name).cast(f.dataType) for f in INITIAL.fields])


def handover_state(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
                   rules: DataFrame, rows_per_chunk: int | None = None,
                   initial_state: DataFrame | None = None) -> DataFrame:
    """The states at the end of a batch run (which may itself have begun
    from ``initial_state``), as ``INITIAL`` rows -- so a live run continues
    open episodes instead of alerting twice."""
    lab, chunked = E.labeled(actuator, presence, rule_keys, rules, rows_per_chunk, initial_state)
    opens = E.opened(E.transitions(lab, chunked)).where(F.col("finish_ts").isNull())
    st = E.bind_rules(E.readings(actuator, presence), rule_keys, rules)  # no scan: plain maxima
    us = tf.micros
    last = st.groupBy("rule_id", "key").agg(
        F.max(F.when(F.col("src") == E.SRC_ACTUATOR,
                     F.struct("ts", "id", "level"))).alias("la"),
        F.max(F.when((F.col("src") == E.SRC_PRESENCE) & F.col("occupied"),
                     F.col("ts"))).alias("lo"))
    last = last.select("rule_id", "key", us(F.col("la.ts")).alias("a_ts"), F.col("la.id").alias("a_id"),
                       F.col("la.level").alias("a_level"), us("lo").alias("o_ts"))
    if initial_state is not None:
        names = ["a_ts", "a_id", "a_level", "o_ts"]
        before = initial_state.select("rule_id", "key", *[F.col(c).alias(f"_{c}") for c in names])
        known = F.col("a_ts").isNotNull()
        last = last.join(before, ["rule_id", "key"], "full").select(
            "rule_id", "key", *[F.when(known, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in names[:3]],
            F.greatest("o_ts", "_o_ts").alias("o_ts"))
    open_cols = opens.select(
        "rule_id", "key", us("ts").alias("open_ts"), F.col("id").alias("open_id"),
        us("start_ts").alias("start_ts"), us(F.col("a.ts")).alias("ev_a_ts"),
        F.col("a.level").alias("ev_a_level"), F.col("lux").alias("ev_lux"),
        F.col("occupied").alias("ev_occupied"))
    out = last.join(open_cols, ["rule_id", "key"], "left")
    return out.select([F.col(f.name).cast(f.dataType) for f in INITIAL.fields])


def seed_from_snapshot(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
                       rules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S1, streaming form: the snapshot (the latest row per sensor) of each
    input, and the state that they leave, for a live run to start from."""
    a, p = snap.latest_per_key(actuator), snap.latest_per_key(presence)
    return a, p, handover_state(a, p, rule_keys, rules)


# --- sinks ---------------------------------------------------------------------

def batch_sink(out_dir: str, rules: DataFrame, db: int = 0):
    """K1-K4 in one ``foreachBatch`` function.  Each output of micro-batch
    ``b`` goes to ``.../batch_id=b`` with overwrite, so a replayed batch
    (restart after a failure) rewrites the same files: idempotent.

    * ``changelog``: every record;
    * ``table`` (K2): finished episodes as table rows, by project and date;
    * ``alerts`` (K3): one alert per opened episode;
    * ``publish`` (K4): every record as a publish envelope with its
      channel (a Kafka sink takes ``channel`` as topic, ``key``, ``value``);
    * ``commits``, last: the micro-batch's manifest.  :func:`committed` reads
      the outputs of the batches that have one, so a reader never sees half a
      batch, also when the run ends between two writes."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            part = f"batch_id={batch_id}"
            batch.write.mode("overwrite").parquet(f"{out_dir}/changelog/{part}")
            done = batch.where(F.col("is_finish"))
            (S.cube_rows(done).withColumn("date", F.substring("time", 1, 10))
             .write.mode("overwrite").partitionBy("project_id", "date")
             .parquet(f"{out_dir}/table/{part}"))
            S.alert_outbox(batch.where(~F.col("is_finish")), rules).write.mode(
                "overwrite").parquet(f"{out_dir}/alerts/{part}")
            r = rules.select("rule_id", "table_id",
                             S.channel(db, "table_id", "project_id").alias("channel"))
            env = S.publish_envelope(batch.join(F.broadcast(r), "rule_id"), "table_id", ("channel",))
            env.select("channel", F.col("sensor_key").alias("key"), "value").write.mode(
                "overwrite").json(f"{out_dir}/publish/{part}")
            _commit(batch.sparkSession, out_dir, batch_id)
        finally:
            batch.unpersist()
    return sink


def message_sink(out_dir: str, rules: DataFrame, dim: DataFrame, db: int = 0):
    """The sink of :func:`message_changes`: dead letters to ``rejects``, the
    changes to the outputs of :func:`batch_sink`, all under one manifest."""
    write = batch_sink(out_dir, rules, db)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            (batch.where(F.col("reason").isNotNull()).select(*REJECTS.fieldNames())
             .write.mode("overwrite").parquet(f"{out_dir}/rejects/batch_id={batch_id}"))
            write(episode_records(batch.where(F.col("reason").isNull()), rules, dim), batch_id)
        finally:
            batch.unpersist()
    return sink


def _commit(spark: SparkSession, out_dir: str, batch_id: int) -> None:
    (spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
     .write.mode("overwrite").parquet(f"{out_dir}/commits/batch_id={batch_id}"))


def committed(spark: SparkSession, out_dir: str, output: str = "changelog", fmt: str = "parquet") -> DataFrame:
    """An output's rows of the micro-batches that were committed whole."""
    done = spark.read.parquet(f"{out_dir}/commits").select("batch_id")
    rows = spark.read.format(fmt).option("basePath", f"{out_dir}/{output}").load(f"{out_dir}/{output}")
    return rows.join(F.broadcast(done) if fits_broadcast(done) else done, "batch_id", "left_semi")


def compact(spark: SparkSession, out_dir: str, output: str, target: str, files: int = 1,
            fmt: str = "parquet") -> None:
    """The committed rows of an output as a few files in a new folder (the
    micro-batches' own small files stay until nobody reads them)."""
    rows = committed(spark, out_dir, output, fmt).withColumnRenamed("batch_id", "batch")
    rows.repartition(files).write.mode("overwrite").format(fmt).save(target)


def _started(rows: DataFrame, sink, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=LIVE_TRIGGER)
    return w.start()


def start(records: DataFrame, out_dir: str, checkpoint: str, rules: DataFrame,
          available_now: bool = True) -> StreamingQuery:
    """Checkpointed query; ``availableNow`` drains what is there (tests,
    backfills), otherwise a 10 s processing-time trigger."""
    return _started(records, batch_sink(out_dir, rules), checkpoint, available_now)


def start_messages(changes: DataFrame, out_dir: str, checkpoint: str, rules: DataFrame, dim: DataFrame,
                   rule_keys: DataFrame, available_now: bool = True) -> StreamingQuery:
    """W3 for :func:`message_changes`, behind the S4 barrier."""
    require_known(dim, rule_keys)
    return _started(changes, message_sink(out_dir, rules, dim), checkpoint, available_now)


ACTUATOR_FILE_SCHEMA = schemas.ACTUATOR
PRESENCE_FILE_SCHEMA = schemas.PRESENCE
