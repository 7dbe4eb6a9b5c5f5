"""Batch episode detection: T1 time_only, T2 sensor_only, T3
sensor_and_time (T4 dispatch by the rule's ``strategy`` column), T5 open /
finish changelog, with J1 (two keyed inputs), J2 (as-of actuator value) and
J3 (power lookup).

Set-based form of the per-sensor state machine.  Per ``(rule_id, key)`` in
the order ``(ts, src, id)`` (actuator before presence at equal time):

1. scan state: latest actuator reading (J2) and latest occupied presence
   time (P9) at or before each row;
2. label each row ``O`` (the strategy's open condition holds), ``C`` (close
   condition) or nothing; the open condition never depends on the open
   flag except "none open", so labels are row-local;
3. a row changes state iff its label differs from the previous non-null
   label (start: closed), so kept rows alternate O, C, O, ...;
4. each kept ``O`` is an episode; the next kept row (a ``C``) closes it.

Steps 1 and 3 are running scans done by :func:`carry_scan`, chunked so
that a hot sensor is spread over many tasks.  No UDF, no collect.

A run may go on from the state that an earlier one left (``initial_state``,
T6): the state is one more row per sensor, before all readings, which gives
the scans their first values and stands for the open episode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lampwatch import labels as L
from lampwatch.functions import predicates as P
from lampwatch.functions import timefns as tf
from lampwatch.functions.emission import emission_kg
from lampwatch.operators.joins import fits_broadcast
from lampwatch.sources.dimension import require_known, sensor_power
from lampwatch.operators.scan import Scan, cut_chunks, carry_scan, join_chunks

SRC_ACTUATOR = 0
SRC_PRESENCE = 1
SRC_STATE = -1
KEYS = ["rule_id", "key"]
ORDER = ["ts", "src", "id"]


def readings(actuator: DataFrame, presence: DataFrame, keep: tuple[str, ...] = ()
             ) -> DataFrame:
    """Both inputs as one tagged row set (actuator ``src=0``); ``keep``
    names extra columns both inputs carry (e.g. a watermarked event time)."""
    act = actuator.select(
        F.col("key").cast("string").alias("key"), "ts", F.col("id").cast("bigint").alias("id"),
        F.lit(SRC_ACTUATOR).alias("src"),
        F.coalesce(F.col("level").cast("double"), F.lit(0.0)).alias("level"),
        F.lit(None).cast("boolean").alias("occupied"),
        F.lit(None).cast("double").alias("lux"), *keep)
    pre = presence.select(
        F.col("key").cast("string").alias("key"), "ts", F.col("id").cast("bigint").alias("id"),
        F.lit(SRC_PRESENCE).alias("src"),
        F.lit(None).cast("double").alias("level"),
        F.coalesce(F.col("occupied"), F.lit(False)).alias("occupied"),
        F.coalesce(F.col("lux").cast("double"), F.lit(0.0)).alias("lux"), *keep)
    return (act.unionByName(pre)
            .where(F.col("key").isNotNull() & F.col("ts").isNotNull()
                   & F.col("id").isNotNull()))


def bind_rules(rows: DataFrame, rule_keys: DataFrame, rules: DataFrame,
               broadcast: bool | None = None) -> DataFrame:
    """P5 + J1: one copy of a reading per rule that lists its key; presence
    readings only for rules that read presence.  ``broadcast`` says whether
    the key list is sent to all tasks (None: if its count is in bounds)."""
    rk = (rule_keys.select("rule_id", F.col("key").cast("string").alias("key"))
          .join(F.broadcast(rules.select("rule_id", "strategy")), "rule_id")
          .select("rule_id", "key",
                  (F.col("strategy") != L.TIME_ONLY).alias("_reads_presence")))
    if broadcast is None:
        broadcast = fits_broadcast(rule_keys)
    bound = rows.join(F.broadcast(rk) if broadcast else rk, on="key", how="inner")
    return (bound.where((F.col("src") != SRC_PRESENCE) | F.col("_reads_presence"))
            .drop("_reads_presence"))


def with_state(rows: DataFrame, initial_state: DataFrame) -> DataFrame:
    """``rows`` and, before each sensor's first, a row with the states that an
    earlier run left for it (``states``, one per rule)."""
    names = [c for c in initial_state.columns if c != "key"]
    kept = initial_state.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("states"))
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields}
    first = kept.select(
        *[{"key": F.col("key"), "src": F.lit(SRC_STATE).alias("src"),
           "chunk": F.lit(0).cast("bigint").alias("chunk")}.get(c, none[c]) for c in rows.columns], "states")
    return rows.withColumn("states", F.lit(None).cast(first.schema["states"].dataType)).unionByName(first)


def own_state(bound: DataFrame) -> DataFrame:
    """The state of a row's rule, if it is a state row; sensors whose earlier
    run did not know the rule start from nothing."""
    own = F.try_element_at(F.filter("states", lambda s: s["rule_id"] == F.col("rule_id")), F.lit(1))
    return (bound.withColumn("s", F.when(F.col("src") == SRC_STATE, own)).drop("states")
            .where((F.col("src") != SRC_STATE) | F.col("s").isNotNull()))


def scan_state(bound: DataFrame, chunked: int, copies: int = 1) -> DataFrame:
    """Step 1: ``a`` = latest actuator ``struct(ts, id, level)`` and ``o`` =
    latest occupied presence time, both at or before the row."""
    a = F.when(F.col("src") == SRC_ACTUATOR,
               F.struct(F.col("ts").alias("ts"), F.col("id").alias("id"), F.col("level").alias("level")))
    o = F.when((F.col("src") == SRC_PRESENCE) & F.col("occupied"), F.col("ts"))
    if "s" in bound.columns:
        s = F.col("s")
        a = a.when(s["a_ts"].isNotNull(), F.struct(tf.wall_time(s["a_ts"]).alias("ts"), s["a_id"].alias("id"),
                                                   s["a_level"].alias("level")))
        o = o.when(s["o_ts"].isNotNull(), tf.wall_time(s["o_ts"]))
    return carry_scan(bound, KEYS, "chunk", ORDER, [Scan("a", "last", a), Scan("o", "max", o)],
                      chunked, copies)


def state(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
          rules: DataFrame, rows_per_chunk: int | None = None,
          initial_state: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Readings of every rule with their scan state (J2, P9 inputs), and the
    pieces that hot sensors were cut into, over all rules (0: none is hot)."""
    rows, chunked = cut_chunks(readings(actuator, presence), "key", "ts", rows_per_chunk)
    if initial_state is not None:
        rows = with_state(rows, initial_state)
    # Shuffle the readings once, by sensor (and chunk), before the per-rule
    # copies are made: hash(key, chunk) already clusters every
    # (rule_id, key, chunk) window partition, and the broadcast rule join
    # keeps it -- the shuffle carries each reading once, not once per rule.
    # The partition count is the session's shuffle partitions (sized for the
    # cluster): the sort and windows after it are CPU-bound, so AQE should
    # not coalesce them by bytes into a handful of tasks.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not chunked:
        rows = bind_rules(rows.repartition(n, "key"), rule_keys, rules)
    elif fits_broadcast(rule_keys):
        rows = bind_rules(rows.repartition(n, "key", "chunk"), rule_keys, rules, broadcast=True)
    else:
        # the key list is joined by shuffle, on the sensor (a skewed sensor's
        # rows are split there by AQE), so it comes before the rows are dealt
        # by (sensor, chunk): after it a hot sensor would be whole again
        rows = bind_rules(rows, rule_keys, rules, broadcast=False).repartition(n, "key", "chunk")
    copies = rules.count() if chunked else 1  # configuration
    return scan_state(rows if initial_state is None else own_state(rows), chunked, copies), chunked * copies


def gates(st: DataFrame) -> DataFrame:
    """P6, P8-P11 per row, from the scan state and the rule parameters
    (joined by the caller)."""
    a = F.col("a")
    return st.select(
        "*",
        P.is_on("level", F.col("on_level")).alias("is_on"),
        F.coalesce(P.is_on(a.getField("level"), F.col("on_level")), F.lit(False)).alias("last_on"),
        P.quiet("o", "ts", F.col("quiet_s")).alias("quiet"),
        P.settled(a.getField("ts"), "ts", F.col("settle_s")).alias("settled"),
        P.warmed_up("program_start", "ts", F.col("warmup_s")).alias("warm"),
        tf.in_schedule("ts", F.col("hour_start"), F.col("minute_start"),
                       F.col("hour_end"), F.col("minute_end")).alias("in_schedule"),
    )


def label(g: DataFrame) -> DataFrame:
    """Step 2: ``lab`` in {O, C, NULL} and the episode start time."""
    is_act = F.col("src") == SRC_ACTUATOR
    is_pre = F.col("src") == SRC_PRESENCE
    s = F.col("strategy")
    t1 = (F.when(is_act & F.col("is_on") & ~F.col("in_schedule"), "O")
          .when(is_act & ~F.col("is_on"), "C"))
    close = (is_act & ~F.col("is_on")) | (is_pre & F.col("occupied"))
    open2 = (is_pre & ~F.col("occupied") & F.col("last_on") & F.col("settled")
             & F.col("quiet") & F.col("warm"))
    open3 = open2 & ~F.col("in_schedule")
    lab = (F.when(s == L.TIME_ONLY, t1)
           .when(s == L.SENSOR_ONLY, F.when(close, "C").when(open2, "O"))
           .when(s == L.SENSOR_AND_TIME, F.when(close, "C").when(open3, "O")))
    start = F.when(s == L.SENSOR_ONLY, F.col("a").getField("ts")).otherwise(F.col("ts"))
    if "s" in g.columns:  # an open episode of the state is an open row that was emitted before
        lab = F.when(F.col("src") == SRC_STATE,
                     F.when(F.col("s.open_ts").isNotNull(), F.lit("O"))).otherwise(lab)
    return g.select("*", lab.alias("lab"), start.alias("start_ts"))


def opened(opens: DataFrame) -> DataFrame:
    """Kept opens with what the state knows of those that it opened;
    ``seeded`` marks them."""
    if "s" not in opens.columns:
        return opens
    s, old = F.col("s"), F.col("src") == SRC_STATE
    evidence = F.struct(tf.wall_time(s["ev_a_ts"]).alias("ts"), F.lit(None).cast("bigint").alias("id"),
                        s["ev_a_level"].alias("level"))
    given = {"ts": tf.wall_time(s["open_ts"]), "id": s["open_id"], "start_ts": tf.wall_time(s["start_ts"]),
             "a": evidence, "occupied": s["ev_occupied"], "lux": s["ev_lux"]}
    return opens.select(*[F.when(old, given[c]).otherwise(F.col(c)).alias(c) if c in given else c
                          for c in opens.columns if c != "s"], old.alias("seeded"))


def transitions(labeled: DataFrame, chunked: int) -> DataFrame:
    """Steps 3-4: kept ``O`` rows with ``finish_ts`` (NULL: still open)."""
    lab = labeled.where(F.col("lab").isNotNull())
    prev = carry_scan(lab, KEYS, "chunk", ORDER,
                      [Scan("prev", "last", F.col("lab"), inclusive=False)], chunked)
    kept = prev.where(F.col("lab") != F.coalesce(F.col("prev"), F.lit("C")))
    w = Window.partitionBy(*KEYS, "chunk").orderBy(*ORDER)
    opens = (kept.withColumn("_next", F.lead("ts").over(w))
             .where(F.col("lab") == "O"))
    if not chunked:
        return opens.withColumnRenamed("_next", "finish_ts").drop("prev")
    # an open that is last in its chunk closes at the first C of a later chunk
    first_c = lab.groupBy(*KEYS, "chunk").agg(
        F.min(F.when(F.col("lab") == "C", F.col("ts"))).alias("_fc"))
    later = (Window.partitionBy(*KEYS).orderBy(F.col("chunk").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    later_c = first_c.select(*KEYS, "chunk", F.min("_fc").over(later).alias("_later"))
    later_c = later_c.where(F.col("_later").isNotNull())
    return (join_chunks(opens, later_c, [*KEYS, "chunk"], chunked)
            .withColumn("finish_ts", F.coalesce("_next", "_later"))
            .drop("_next", "_later", "prev"))


PARAMS = ["rule_id", "project_id", "strategy", "hour_start", "minute_start", "hour_end",
          "minute_end", "factor", "program_start", "on_level", "quiet_s", "settle_s",
          "warmup_s"]
LABELED = [*KEYS, "chunk", *ORDER, "lab", "start_ts", "a", "occupied", "lux"]


def labeled(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
            rules: DataFrame, rows_per_chunk: int | None = None,
            initial_state: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Steps 1-2 for every rule: rows with their label, narrowed to the
    columns the later steps read; and the pieces of hot sensors (0: none)."""
    params = rules.select(*PARAMS)
    st, chunked = state(actuator, presence, rule_keys, params, rows_per_chunk, initial_state)
    g = gates(st.join(F.broadcast(params), on="rule_id"))
    return label(g).select(*LABELED, *(["s"] if initial_state is not None else [])), chunked


def episodes(actuator: DataFrame, presence: DataFrame, rule_keys: DataFrame,
             rules: DataFrame, dim: DataFrame,
             rows_per_chunk: int | None = None, initial_state: DataFrame | None = None) -> DataFrame:
    """One row per episode of every rule (the columns that ``finish`` builds), plus
    ``open_id`` (id of the triggering reading), ``project_id`` and the
    JSON evidence ``origin_data``.

    S4: a listed sensor that the dimension does not hold stops the job here,
    before any reading is read and whichever columns are asked for.

    T6: with ``initial_state`` (``INITIAL`` rows, the states that an earlier
    run left) open episodes go on; ``seeded`` marks the episodes that the
    earlier run has opened, and so emitted, already."""
    require_known(dim, rule_keys)
    lab, chunked = labeled(actuator, presence, rule_keys, rules, rows_per_chunk, initial_state)
    opens = opened(transitions(lab, chunked))
    return finish(opens.join(F.broadcast(rules.select(*PARAMS)), on="rule_id"), dim)


def finish(opens: DataFrame, dim: DataFrame) -> DataFrame:
    """The episode row from a kept open.  Repeated rows of the
    dimension are one sensor (``sensor_power``, the only grouping of it)."""
    s = F.col("strategy")
    done = F.col("finish_ts").isNotNull()
    seconds = (F.when(s == L.SENSOR_ONLY, F.lit(L.SENSOR_ONLY_EMISSION_S).cast("bigint"))
               .otherwise(tf.next_start_gap_s("finish_ts", F.col("hour_start"),
                                              F.col("minute_start"))))
    typ = F.create_map(*[F.lit(x) for kv in L.TYPE_BY_STRATEGY.items() for x in kv])[s]
    message = F.when(s == L.TIME_ONLY, F.lit("")).otherwise(
        F.concat(F.lit(L.PROGRAM_START_PREFIX),
                 tf.wall_ms("program_start").cast("string")))
    a = F.col("a")
    actuator_evidence = F.struct(
        F.col("key").alias("Key"), tf.format_time(a.getField("ts")).alias("Time"),
        a.getField("level").alias("OpeningAperture"))
    presence_evidence = F.struct(
        F.col("key").alias("Key"), tf.format_time("ts").alias("Time"),
        F.col("occupied").alias("Occupancy"), F.col("lux").alias("Lux"))
    evidence = (F.when(s == L.TIME_ONLY,
                       F.to_json(F.struct(actuator_evidence.alias("OpeningAperture"))))
                .when(s == L.SENSOR_ONLY,
                      F.to_json(F.struct(actuator_evidence.alias("OpeningAperture"),
                                         F.lit("[]").alias("Occupancy"))))
                .otherwise(F.to_json(F.struct(actuator_evidence.alias("OpeningAperture"),
                                              presence_evidence.alias("Occupancy")))))
    power = sensor_power(dim).withColumnRenamed("_key", "key")
    # the rows counted are the dimension's own, which are no fewer
    withp = opens.join(F.broadcast(power) if fits_broadcast(dim) else power, on="key", how="left")
    return withp.select(
        "rule_id",
        F.col("key").alias("sensor_key"),
        "strategy",
        F.col("ts").alias("open_ts"),
        F.col("id").alias("open_id"),
        "start_ts",
        "finish_ts",
        done.alias("is_finish"),
        F.when(done, tf.duration_s("start_ts", "finish_ts")).alias("duration"),
        F.when(done, emission_kg(seconds, F.coalesce(F.col("power"), F.lit(0.0)),
                                 F.col("factor"))).otherwise(F.lit(0.0)).alias("carbon_emissions"),
        F.when(done, F.lit(L.CARBON_UNIT)).alias("carbon_unit"),
        typ.alias("type"),
        F.lit(L.SYSTEM).alias("system"),
        message.alias("message"),
        F.lit(L.MEASURE).alias("measure"),
        tf.format_time("start_ts").alias("time"),
        "project_id",
        evidence.alias("origin_data"), *(["seeded"] if "seeded" in opens.columns else []),
    )


def changelog(eps: DataFrame) -> DataFrame:
    """T5: the rows a live run emits -- one when an episode opens, one more
    when it finishes.  ``row_ts`` is the time of the emitting reading."""
    open_row = F.struct(F.lit(False).alias("is_finish"), F.col("open_ts").alias("row_ts"))
    fin_row = F.struct(F.lit(True).alias("is_finish"), F.col("finish_ts").alias("row_ts"))
    rows = F.when(F.col("finish_ts").isNull(), F.array(open_row)).otherwise(
        F.array(open_row, fin_row))
    if "seeded" in eps.columns:  # the run before has emitted the opening row
        rows = F.when(F.col("seeded"), F.filter(rows, lambda r: r["is_finish"])).otherwise(rows)
    base = eps.drop("is_finish")
    out = base.select("*", F.explode(rows).alias("_r"))
    fin = F.col("_r.is_finish")
    return out.select(
        *[c for c in base.columns if c not in ("duration", "carbon_emissions", "carbon_unit",
                                                 "finish_ts", "seeded")],
        fin.alias("is_finish"),
        F.col("_r.row_ts").alias("row_ts"),
        F.when(fin, F.col("finish_ts")).alias("finish_ts"),
        F.when(fin, F.col("duration")).alias("duration"),
        F.when(fin, F.col("carbon_emissions")).otherwise(F.lit(0.0)).alias("carbon_emissions"),
        F.when(fin, F.col("carbon_unit")).alias("carbon_unit"),
        F.when(fin, F.lit("table")).otherwise(F.lit("alert")).alias("route"),
    )
