"""Streaming queries over the fixture: the readings are written as files,
oldest first, ``FILES`` files per time slice and input, and drained with
``availableNow`` at that many files per trigger -- so a micro-batch holds one
time slice of both inputs.  The result must equal the batch changelog.

The files go to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch import schemas
from lampwatch.operators import episodes as E
from lampwatch.plans import fixture as fx
from lampwatch.session import scratch_path
from lampwatch.streaming import job as J

N_SLICES = 6
FILES = 4                   # files of a slice
WINDOW_S = 3600             # the legacy rule's window, C.WINDOW_WIDTH in seconds
HANDOVER_CUT = "2024-01-15 00:00:00"
CHANGELOG_COLUMNS = ["rule_id", "sensor_key", "open_ts", "is_finish", "row_ts", "route",
                     "duration", "carbon_emissions"]


def _ntz(v: dt.datetime):
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def write_slices(df: DataFrame, path: str, edges: list, deal: str = "id", fmt: str = "parquet",
                 drop: tuple[str, ...] = ()) -> None:
    """``FILES`` files per time slice ``[edges[i], edges[i+1])``, written in
    time order (rising modification times), rows dealt by hash of ``deal``;
    a micro-batch takes ``FILES`` files, so one slice.  ``drop`` names columns
    that only the slicing reads."""
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = df.where((F.col("ts") >= _ntz(lo)) & (F.col("ts") < _ntz(hi)))
        file = F.pmod(F.xxhash64(deal), F.lit(FILES)).cast("int")
        part.repartitionById(FILES, file).drop(*drop).write.mode("append").format(fmt).save(path)


def _edges(df: DataFrame, n: int) -> list:
    """``n`` equal time slices covering ``df.ts`` (one small aggregate)."""
    b = df.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = b["lo"], b["hi"] + dt.timedelta(microseconds=1)
    step = (hi - lo) / n
    return [lo + step * i for i in range(n)] + [hi]


def _with_route(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "route", F.when(F.col("is_finish"), F.lit("table")).otherwise(F.lit("alert")))


def _await(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _run_stream(spark, root: str, rules, rk, dim_df, seeds: str | None = None,
                late_policy: str = "apply") -> DataFrame:
    """Drain the readings below ``root/in``; the changelog of all runs on
    this root so far (a second call restarts from the checkpoint)."""
    a = J.with_watermark(J.file_source(spark, f"{root}/in/actuator", schemas.ACTUATOR, files_per_trigger=FILES))
    p = J.with_watermark(J.file_source(spark, f"{root}/in/presence", schemas.PRESENCE, files_per_trigger=FILES))
    given = J.seed_source(spark, seeds) if seeds else None
    changes = J.episode_changes(a, p, rk, rules, given, late_policy)
    _await(J.start(J.episode_records(changes, rules, dim_df, rk), f"{root}/out", f"{root}/ckpt", rules))
    return J.committed(spark, f"{root}/out")


def _write_inputs(act: DataFrame, pre: DataFrame, root: str, edges: list) -> None:
    write_slices(act, f"{root}/in/actuator", edges)
    write_slices(pre, f"{root}/in/presence", edges)


def _all_edges(act: DataFrame, pre: DataFrame, n: int = N_SLICES) -> list:
    return _edges(act.select("ts").unionByName(pre.select("ts")), n)


def stream_episodes_by_rule(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stream-by-rule")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    _write_inputs(act, pre, root, _all_edges(act, pre))
    out = _run_stream(spark, root, fx.rules(spark), fx.rule_keys(spark, sf), fx.dimension(spark, sf))
    return _with_route(out).select(*CHANGELOG_COLUMNS)


def stream_handover(spark: SparkSession, sf: str, late_policy: str = "apply",
                    snapshot: bool = False, restart: bool = False) -> DataFrame:
    """Batch backfill up to the cut, its final state handed to a live
    stream over the rest; backfill changelog + stream output.  With
    ``snapshot`` only the latest row per sensor and input is known of the
    time before the cut (S1).  With ``restart`` the live run ends after a
    sixth of the rest and is started again from its checkpoint: most sensors
    with an open episode have not reported by then."""
    root = scratch_path(spark, "stream-handover")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    cut = F.lit(HANDOVER_CUT).cast("timestamp_ntz")
    a0, p0 = act.where(F.col("ts") < cut), pre.where(F.col("ts") < cut)
    a1, p1 = act.where(F.col("ts") >= cut), pre.where(F.col("ts") >= cut)
    rules = fx.rules(spark)
    rk = fx.rule_keys(spark, sf)
    dim_df = fx.dimension(spark, sf)

    if snapshot:
        a0, p0, state = J.seed_from_snapshot(a0, p0, rk, rules)
    else:
        state = J.handover_state(a0, p0, rk, rules)
    backfill = E.changelog(E.episodes(a0, p0, rk, rules, dim_df))
    J.write_seeds(state, f"{root}/seeds")   # cut lineage: the live run reads a table
    edges = _all_edges(a1, p1)
    if restart:
        _write_inputs(a1, p1, root, edges[:2])
        _run_stream(spark, root, rules, rk, dim_df, f"{root}/seeds", late_policy)
        edges = edges[1:]
    _write_inputs(a1, p1, root, edges)
    live = _run_stream(spark, root, rules, rk, dim_df, f"{root}/seeds", late_policy)
    return (_with_route(backfill).select(*CHANGELOG_COLUMNS)
            .unionByName(_with_route(live).select(*CHANGELOG_COLUMNS)))


def stream_handover_drop(spark: SparkSession, sf: str) -> DataFrame:
    """W4 + T6: the hand-over into a live run that drops late rows; the
    readings come in time order, so the answer is the same."""
    return stream_handover(spark, sf, "drop")


def stream_handover_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The hand-over survives a restart, also for silent sensors."""
    return stream_handover(spark, sf, restart=True)


def stream_snapshot_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """S1, streaming form: a live run seeded by the snapshot at the cut."""
    return stream_handover(spark, sf, snapshot=True)


def stream_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """T6 both ways: a live run over the first third of the time, its states
    taken out of the checkpoint, a batch run over the second third that goes
    on from them, and a live run over the rest that goes on from the batch."""
    root = scratch_path(spark, "stream-round-trip")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    rules, rk, dim_df = fx.rules(spark), fx.rule_keys(spark, sf), fx.dimension(spark, sf)
    edges = _all_edges(act, pre)
    two = len(edges) // 3

    _write_inputs(act, pre, f"{root}/first", edges[:two + 1])
    first = _run_stream(spark, f"{root}/first", rules, rk, dim_df)

    def between(df: DataFrame) -> DataFrame:
        return df.where((F.col("ts") >= _ntz(edges[two])) & (F.col("ts") < _ntz(edges[2 * two])))

    J.live_state(spark, f"{root}/first/ckpt").write.parquet(f"{root}/state")
    state = spark.read.parquet(f"{root}/state")
    second = E.changelog(E.episodes(between(act), between(pre), rk, rules, dim_df, initial_state=state))
    J.write_seeds(J.handover_state(between(act), between(pre), rk, rules, initial_state=state), f"{root}/seeds")

    _write_inputs(act, pre, f"{root}/last", edges[2 * two:])
    last = _run_stream(spark, f"{root}/last", rules, rk, dim_df, f"{root}/seeds")
    return (_with_route(first).select(*CHANGELOG_COLUMNS)
            .unionByName(_with_route(second).select(*CHANGELOG_COLUMNS))
            .unionByName(_with_route(last).select(*CHANGELOG_COLUMNS)))


MESSAGE_COLUMNS = [*CHANGELOG_COLUMNS, "source", "msg_id", "reason"]


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    """S2, P1-P3, J1, T1-T3 live from raw messages: JSON files of both inputs,
    decoded, split and evaluated in one pass; the changelog, and the dead
    letters (``msg_id`` set) that were committed with it."""
    root = scratch_path(spark, "stream-messages")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    # texts hold whole seconds: cut there, so that a second is in one slice
    edges = [e.replace(microsecond=0) for e in _all_edges(act, pre)]
    edges[-1] += dt.timedelta(seconds=1)
    for name, rows, messages in (("actuator", act, fx.actuator_messages), ("presence", pre, fx.presence_messages)):
        timed = messages(spark, sf).join(rows.select(F.col("id").alias("msg_id"), "ts"), "msg_id")
        write_slices(timed, f"{root}/in/{name}", edges, "msg_id", "json", ("ts",))
    raw = [J.file_source(spark, f"{root}/in/{name}", "msg_id bigint, value string", "json", FILES)
           for name in ("actuator", "presence")]
    rules, rk, dim_df = fx.rules(spark), fx.rule_keys(spark, sf), fx.dimension(spark, sf)
    _await(J.start_messages(J.message_changes(*raw, rk, rules), f"{root}/out", f"{root}/ckpt", rules, dim_df, rk))
    changes = _with_route(J.committed(spark, f"{root}/out"))
    letters = J.committed(spark, f"{root}/out", "rejects")
    none = {f.name: f.dataType for f in [*changes.schema.fields, *letters.schema.fields]}
    return changes.select(*CHANGELOG_COLUMNS, *[F.lit(None).cast(none[c]).alias(c) for c in MESSAGE_COLUMNS[-3:]]) \
        .unionByName(letters.select(*[F.lit(None).cast(none.get(c, "string")).alias(c) for c in CHANGELOG_COLUMNS],
                                    *MESSAGE_COLUMNS[-3:]))


def stream_log(spark: SparkSession, sf: str) -> DataFrame:
    """S2 + W2: log messages as files, out of order within the allowed
    disorder, decoded and watermarked on the fly; the rows that come out."""
    root = scratch_path(spark, "stream-log")
    write_slices(fx.log_messages(spark, sf).withColumn("id", F.col("msg_id")), f"{root}/in",
                 _edges(fx.presence(spark, sf), N_SLICES))
    raw = J.file_source(spark, f"{root}/in", "msg_id bigint, value string", files_per_trigger=FILES)
    rows = J.log_readings(raw, fx.LOG_SCHEMA, "ts_ms", zone="UTC")
    q = (rows.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.parquet(f"{root}/out").select(F.col("sensor_4").alias("key"), "lux", "ts")


def _drained(rows: DataFrame, root: str) -> DataFrame:
    """The rows of a stream, drained into a folder below ``root``."""
    _await(rows.writeStream.format("parquet").option("path", f"{root}/out")
           .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    return rows.sparkSession.read.parquet(f"{root}/out")


def _heartbeats(df: DataFrame, path: str, at: dt.datetime) -> None:
    """Two micro-batches of readings of a sensor of their own, long after the
    last one: the first moves the watermark over all readings, in the second
    the operators act on it."""
    given = {"key": F.lit("heartbeat"), "ts": _ntz(at), "id": F.col("n"), "level": F.lit(0.0)}
    beat = df.sparkSession.range(FILES).withColumnRenamed("id", "n").select(
        "n", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    for _ in range(2):
        beat.repartitionById(FILES, F.col("n").cast("int")).drop("n").write.mode("append").parquet(path)


def stream_legacy_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """A2, A3, T7, T8 live: the windowed rule as one event-time
    operator; the finished episodes equal the batch form's."""
    from lampwatch.plans import catalog as C
    from lampwatch.streaming.legacy import legacy_stream

    root = scratch_path(spark, "stream-legacy")
    act, pre = fx.actuator(spark, sf), fx.presence(spark, sf)
    edges = _all_edges(act, pre)
    _write_inputs(act, pre, root, edges)
    _heartbeats(act, f"{root}/in/actuator", edges[-1] + dt.timedelta(days=2))
    _heartbeats(pre, f"{root}/in/presence", edges[-1] + dt.timedelta(days=2))
    a = J.with_watermark(J.file_source(spark, f"{root}/in/actuator", schemas.ACTUATOR, files_per_trigger=FILES))
    p = J.with_watermark(J.file_source(spark, f"{root}/in/presence", schemas.PRESENCE, files_per_trigger=FILES))
    return _drained(legacy_stream(a, p, WINDOW_S), root).select(*C.LEGACY_COLUMNS)


def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Presence readings of a fast clock that arrive up to
    ``fx.LONG_LAG_S`` behind their event time, under the 5 s disorder bound;
    which of them came too late."""
    root = scratch_path(spark, "stream-late")
    rows = fx.lagged_readings(spark, sf)
    # ``ts`` is what the slices are cut by: the arrival
    arriving = rows.withColumnRenamed("ts", "reading_ts").withColumnRenamed("arrival", "ts")
    write_slices(arriving, f"{root}/in", _edges(arriving, fx.LAG_SLICES), drop=("ts",))
    src = J.file_source(spark, f"{root}/in", "key string, src int, id bigint, reading_ts timestamp_ntz",
                        files_per_trigger=FILES)
    judged = J.split_late(J.with_watermark(src.withColumnRenamed("reading_ts", "ts"), f"{L.DISORDER_S} seconds"))
    return _drained(judged, root).select("key", "id", "ts", "late")


def stream_alert_suppressed(spark: SparkSession, sf: str) -> DataFrame:
    """K5 live: window warnings (derived from the readings) arrive as files
    in time order; the suppression state carries across micro-batches."""
    from lampwatch.functions import timefns as tf
    from lampwatch.plans import catalog as C
    from lampwatch.streaming.suppress import suppress_stream

    root = scratch_path(spark, "stream-suppress")
    warn = (C._summaries(spark, sf).where(F.col("is_warning"))
            .select(F.col("name").alias("key"), "time_stamp",
                    tf.wall_time(F.col("time_stamp") * 1000).alias("ts")))
    write_slices(warn, f"{root}/in/warnings", _edges(warn, N_SLICES), deal="key")
    src = J.file_source(spark, f"{root}/in/warnings",
                        "key string, time_stamp bigint, ts timestamp_ntz", files_per_trigger=FILES)
    sent = suppress_stream(src, C.ALERT_START_S)
    q = (sent.writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return C.suppressed_alerts(spark, spark.read.parquet(f"{root}/out"))
