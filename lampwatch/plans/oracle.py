"""DuckDB oracle SQL for the catalog queries.

Plain SQL over the driver's tables (views ``events``, ``part``, ...):
whole-partition windows, no chunking -- an independent formulation of the
same semantics.  Column names equal the Spark queries'.
"""

from __future__ import annotations

import json

from lampwatch import labels as L
from lampwatch.plans import fixture as fx

US = 1_000_000


def _types(ts: tuple[str, ...]) -> str:
    return ", ".join(f"'{t}'" for t in ts)


ACT = (f"act AS (SELECT CAST(user_id AS VARCHAR) AS key, {fx.PROJECT_ID} AS project_id, ts, "
       f"event_id AS id, value AS level FROM events "
       f"WHERE event_type IN ({_types(fx.ACTUATOR_TYPES)}))")
PRE = (f"pre AS (SELECT CAST(user_id AS VARCHAR) AS key, {fx.PROJECT_ID} AS project_id, ts, "
       f"event_id AS id, event_type = '{fx.OCCUPIED_TYPE}' AS occupied, value AS lux "
       f"FROM events WHERE event_type IN ({_types(fx.PRESENCE_TYPES)}))")
DIM = ("dim AS (SELECT CAST(p_partkey AS VARCHAR) AS _key, "
       "coalesce(p_retailprice, 0.0) AS power FROM part)")
WL = (f"wl AS (SELECT CAST(p_partkey AS VARCHAR) AS _key FROM part "
      f"WHERE p_size <= {fx.WHITELIST_MAX_SIZE})")
SOD = "(epoch_us(ts) - epoch_us(date_trunc('day', ts)))"


def _ts(v) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


def _rule(name: str) -> dict:
    r = dict(fx.RULES[name])
    if r["warmup_s"] is None:
        r["warmup_s"] = r["quiet_s"]
    return r


def _sched_us(r: dict) -> tuple[int, int]:
    return ((r["hour_start"] * 3600 + r["minute_start"] * 60) * US,
            (r["hour_end"] * 3600 + r["minute_end"] * 60) * US)


# --- S1 S3 S4 S5 --------------------------------------------------------------

CUT = "TIMESTAMP '2024-01-15 00:00:00'"

SNAPSHOT_LATEST = f"""
WITH {ACT}
SELECT key, ts, id, level FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, id DESC) AS rn FROM act)
WHERE rn = 1
"""

SNAPSHOT_THEN_CHANGES = f"""
WITH {ACT},
snap AS (
  SELECT key, ts, id, level FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, id DESC) AS rn
    FROM act WHERE ts < {CUT})
  WHERE rn = 1)
SELECT key, ts, id, level, 'snapshot' AS origin FROM snap
UNION ALL
SELECT key, ts, id, level, 'change' AS origin FROM act WHERE ts >= {CUT}
"""

DIM_POWER = f"""
WITH {DIM}, {WL}
SELECT _key, power FROM dim WHERE _key IN (SELECT _key FROM wl)
"""

DIM_MISSING_KEYS = f"""
WITH {ACT}, {DIM}, {WL},
listed AS (SELECT DISTINCT 'inventory' AS rule_id, key FROM act),
d AS (SELECT _key AS key FROM dim WHERE _key IN (SELECT _key FROM wl))
SELECT rule_id, key, 'missing' AS reason FROM listed
WHERE key NOT IN (SELECT key FROM d)
UNION ALL
SELECT 'doubled' AS rule_id, key, 'duplicate in rule' AS reason FROM d WHERE CAST(key AS BIGINT) % 10 = 0
"""


def _rules_values(names) -> str:
    rows = []
    for n in names:
        r = _rule(n)
        rows.append(f"('{r['rule_id']}', '{r['strategy']}', CAST({r['factor']} AS DOUBLE))")
    return ("rules AS (SELECT * FROM (VALUES " + ", ".join(rows)
            + ") AS t(rule_id, strategy, factor))")


RULES_EXPLODED = f"""
WITH {DIM}, {WL}, {_rules_values(fx.RULES)}
SELECT r.rule_id, r.strategy, wl._key AS key, dim.power, r.factor
FROM rules r JOIN wl ON TRUE LEFT JOIN dim ON dim._key = wl._key
"""

# --- P1-P4 F5 -------------------------------------------------------------------

_BREAKS = (f"event_id % {fx.BREAK_NOT_JSON} <> 0 AND event_id % {fx.BREAK_NO_ITEM} <> 0 "
           f"AND event_id % {fx.BREAK_NO_VALUE} <> 0 AND event_id % {fx.BREAK_NULL_ITEM} <> 0 "
           f"AND event_id % {fx.BREAK_NO_KEY} <> 0 AND event_id % {fx.BREAK_BAD_TIME} <> 0")

DECODE_PRESENCE = f"""
SELECT event_id AS msg_id, CAST(user_id AS VARCHAR) AS key, {fx.PROJECT_ID} AS project_id,
       date_trunc('second', ts) AS ts,
       CASE WHEN event_id % {fx.VARY_TEXT_NUMBER} = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS lux,
       CASE WHEN event_id % {fx.VARY_BOOL_OCC} = 0 THEN false
            ELSE event_type = '{fx.OCCUPIED_TYPE}' END AS occupied
FROM events
WHERE event_type IN ({_types(fx.PRESENCE_TYPES)}) AND {_BREAKS}
"""

DECODE_ACTUATOR = f"""
SELECT event_id AS msg_id, CAST(user_id AS VARCHAR) AS key, {fx.PROJECT_ID} AS project_id,
       date_trunc('second', ts) AS ts,
       CASE WHEN event_id % {fx.VARY_TEXT_NUMBER} = 0 OR event_id % {fx.VARY_FRACTION} = 0
            THEN CAST(0 AS DOUBLE) ELSE value END AS level
FROM events
WHERE event_type IN ({_types(fx.ACTUATOR_TYPES)}) AND {_BREAKS}
"""

_REASON = (f"CASE WHEN event_id % {fx.BREAK_NOT_JSON} = 0 THEN 'not_json' "
           f"WHEN event_id % {fx.BREAK_NO_ITEM} = 0 THEN 'no_item' "
           f"WHEN event_id % {fx.BREAK_NO_VALUE} = 0 OR event_id % {fx.BREAK_NULL_ITEM} = 0 "
           f"THEN 'no_value' "
           f"WHEN event_id % {fx.BREAK_NO_KEY} = 0 THEN 'no_key' "
           f"WHEN event_id % {fx.BREAK_BAD_TIME} = 0 THEN 'bad_time' END")

DECODE_REJECTS = f"""
SELECT source, msg_id, reason FROM (
  SELECT 'presence' AS source, event_id AS msg_id, {_REASON} AS reason FROM events
  WHERE event_type IN ({_types(fx.PRESENCE_TYPES)})
  UNION ALL
  SELECT 'actuator' AS source, event_id AS msg_id, {_REASON} AS reason FROM events
  WHERE event_type IN ({_types(fx.ACTUATOR_TYPES)}))
WHERE reason IS NOT NULL
"""

VALID_FLAT = f"""
SELECT event_id AS msg_id FROM events
WHERE event_type IN ({_types(fx.PRESENCE_TYPES)})
  AND event_id % {fx.BREAK_NO_ITEM} <> 0 AND event_id % {fx.BREAK_NO_KEY} <> 0
"""

# --- P5-P11 F2 ------------------------------------------------------------------

WHITELIST = f"""
WITH {ACT}, {WL}
SELECT key, ts, id, level FROM act WHERE key IN (SELECT _key FROM wl)
"""

THRESHOLD_FLAGS = f"""
WITH {ACT}
SELECT key, id, ts, level, level >= {L.ON_LEVEL} AS is_on, level > {L.LEGACY_ON_LEVEL} AS legacy_on
FROM act
"""


def _in_sched(r: dict, ts: str = "ts") -> str:
    s, e = _sched_us(r)
    sod = SOD.replace("ts", ts)
    return f"((dayofweek({ts}) NOT IN (0, 6)) AND {sod} >= {s} AND {sod} <= {e})"


def _gap(r: dict, ts: str = "ts") -> str:
    s, _ = _sched_us(r)
    sod = SOD.replace("ts", ts)
    return (f"((CASE WHEN {sod} < {s} THEN {s} - {sod} "
            f"ELSE {s} + {86400 * US} - {sod} END) // {US})")


IN_SCHEDULE = f"""
WITH {ACT}
SELECT key, id, ts, {_in_sched(_rule('time_only'))} AS in_schedule FROM act
"""

NEXT_START_GAP = f"""
WITH {ACT}
SELECT key, id, ts, {_gap(_rule('time_only'))} AS gap_s FROM act
"""

def _state(prefix: str = "", presence: bool = True) -> str:
    """CTEs ``{prefix}rd`` (tagged readings of whitelisted keys) and
    ``{prefix}st`` (as-of actuator and last occupied time per row)."""
    return f"""
{prefix}rd AS (
  SELECT key, ts, 0 AS src, id, coalesce(level, 0.0) AS level, CAST(NULL AS BOOLEAN) AS occupied,
         CAST(NULL AS DOUBLE) AS lux
  FROM act WHERE key IN (SELECT _key FROM wl)
  UNION ALL
  SELECT key, ts, 1 AS src, id, CAST(NULL AS DOUBLE) AS level, coalesce(occupied, false),
         coalesce(lux, 0.0)
  FROM pre WHERE key IN (SELECT _key FROM wl) AND {'TRUE' if presence else 'FALSE'}),
{prefix}st AS (
  SELECT *,
    last_value(CASE WHEN src = 0 THEN ts END IGNORE NULLS) OVER w AS a_ts,
    last_value(CASE WHEN src = 0 THEN id END IGNORE NULLS) OVER w AS a_id,
    last_value(CASE WHEN src = 0 THEN level END IGNORE NULLS) OVER w AS a_level,
    max(CASE WHEN src = 1 AND occupied THEN ts END) OVER w AS o_ts
  FROM {prefix}rd
  WINDOW w AS (PARTITION BY key ORDER BY ts, src, id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


ASOF_ACTUATOR = f"""
WITH {ACT}, {PRE}, {WL}, {_state()}
SELECT key, id, ts, a_ts, a_id, a_level FROM st WHERE src = 1
"""

QUIET_LOOKBACK = f"""
WITH {ACT}, {PRE}, {WL}, {_state()}
SELECT key, id, ts, o_ts AS last_occupied_ts,
       (o_ts IS NULL OR epoch_us(o_ts) + {_rule('sensor_only')['quiet_s'] * US} < epoch_us(ts))
       AS quiet
FROM st WHERE src = 1
"""

_W = _rule("sensor_only_wide")
SETTLE_WARMUP = f"""
WITH {ACT}, {PRE}, {WL}, {_state()}
SELECT key, id, ts,
       coalesce(epoch_us(a_ts) + {_W['settle_s'] * US} < epoch_us(ts), false) AS settled,
       epoch_us({_ts(_W['program_start'])}) + {_W['warmup_s'] * US} < epoch_us(ts) AS warm
FROM st WHERE src = 1
"""

# --- T1-T5 ----------------------------------------------------------------------


def _evidence(strategy: str) -> str:
    """The evidence JSON as text, field by field."""
    stamp = "'%Y-%m-%d %H:%M:%S'"
    act = ("'{\"OpeningAperture\":{\"Key\":\"' || e.key || '\",\"Time\":\"' || "
           f"strftime(e.a_ts, {stamp}) || '\",\"OpeningAperture\":' || CAST(e.a_level AS VARCHAR) || '}}'")
    if strategy == L.TIME_ONLY:
        return f"{act} || '}}'"
    if strategy == L.SENSOR_ONLY:
        return f"{act} || ',\"Occupancy\":\"[]\"}}'"
    return (f"{act} || ',\"Occupancy\":{{\"Key\":\"' || e.key || '\",\"Time\":\"' || "
            f"strftime(e.ts, {stamp}) || '\",\"Occupancy\":' || CAST(e.occupied AS VARCHAR) || "
            f"',\"Lux\":' || CAST(e.lux AS VARCHAR) || '}}}}'")


def _episodes_cte(name: str) -> str:
    """CTE body (no WITH) producing the episode rows of one fixture rule."""
    r = _rule(name)
    s = r["strategy"]
    on = r["on_level"]
    quiet = f"(o_ts IS NULL OR epoch_us(o_ts) + {r['quiet_s'] * US} < epoch_us(ts))"
    settled = f"coalesce(epoch_us(a_ts) + {r['settle_s'] * US} < epoch_us(ts), false)"
    warm = f"(epoch_us({_ts(r['program_start'])}) + {r['warmup_s'] * US} < epoch_us(ts))"
    sched = _in_sched(r)
    last_on = f"coalesce(a_level >= {on}, false)"
    if s == L.TIME_ONLY:
        lab = (f"CASE WHEN src = 0 AND level >= {on} AND NOT {sched} THEN 'O' "
               f"WHEN src = 0 AND level < {on} THEN 'C' END")
    else:
        open_ = f"src = 1 AND NOT occupied AND {last_on} AND {settled} AND {quiet} AND {warm}"
        if s == L.SENSOR_AND_TIME:
            open_ += f" AND NOT {sched}"
        lab = (f"CASE WHEN (src = 0 AND level < {on}) OR (src = 1 AND occupied) THEN 'C' "
               f"WHEN {open_} THEN 'O' END")
    start = "a_ts" if s == L.SENSOR_ONLY else "ts"
    if s == L.SENSOR_ONLY:
        secs = f"{L.SENSOR_ONLY_EMISSION_S}"
    else:
        secs = _gap(r, "finish_ts")
    typ = L.TYPE_BY_STRATEGY[s]
    msg = ("''" if s == L.TIME_ONLY else
           f"'{L.PROGRAM_START_PREFIX}' || CAST((epoch_us({_ts(r['program_start'])}) // 1000) AS VARCHAR)")
    return f"""{_state(name + "_", s != L.TIME_ONLY)},
{name}_nn AS (
  SELECT *, {start} AS start_ts FROM (SELECT *, {lab} AS lab FROM {name}_st) WHERE lab IS NOT NULL),
{name}_tr AS (
  SELECT *, lag(lab) OVER (PARTITION BY key ORDER BY ts, src, id) AS prev FROM {name}_nn),
{name}_kept AS (SELECT * FROM {name}_tr WHERE lab <> coalesce(prev, 'C')),
{name}_ep AS (
  SELECT *, lead(ts) OVER (PARTITION BY key ORDER BY ts, src, id) AS finish_ts
  FROM {name}_kept),
{name}_out AS (
  SELECT '{name}' AS rule_id, e.key AS sensor_key, '{s}' AS strategy, e.ts AS open_ts,
         e.start_ts, e.finish_ts, e.finish_ts IS NOT NULL AS is_finish,
         CASE WHEN e.finish_ts IS NOT NULL
              THEN (epoch_us(e.finish_ts) - epoch_us(e.start_ts)) // {US} END AS duration,
         CASE WHEN e.finish_ts IS NOT NULL
              THEN (CAST({secs} AS DOUBLE) / 3600.0) * (coalesce(d.power, 0.0) / 1000.0)
                   * CAST({r['factor']} AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS carbon_emissions,
         CASE WHEN e.finish_ts IS NOT NULL THEN '{L.CARBON_UNIT}' END AS carbon_unit,
         '{typ}' AS type, '{L.SYSTEM}' AS system, {msg} AS message,
         '{L.MEASURE}' AS measure, strftime(e.start_ts, '%Y-%m-%d %H:%M:%S') AS time,
         {_evidence(s)} AS origin_data
  FROM {name}_ep e LEFT JOIN dim d ON d._key = e.key
  WHERE e.lab = 'O')"""


def episodes_sql(names, act: str = ACT, pre: str = PRE) -> str:
    names = list(names)
    body = ",".join(_episodes_cte(n) for n in names)
    union = "\nUNION ALL\n".join(f"SELECT * FROM {n}_out" for n in names)
    return f"WITH {act}, {pre}, {DIM}, {WL},{body}\n{union}\n"


EPISODES_ALL = episodes_sql(fx.RULES)



def _seeded(cte: str) -> str:
    """The input as known from a snapshot at the cut: the latest row per
    sensor before it, all rows from it on."""
    name = cte[:3]
    return (f"{name}_all{cte[3:]}, {name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY key ORDER BY ts DESC, id DESC) AS rn FROM {name}_all WHERE ts < {CUT}) "
            f"WHERE rn = 1 UNION ALL SELECT * FROM {name}_all WHERE ts >= {CUT})")


def changelog_sql(episodes: str) -> str:
    return f"""
WITH eps AS ({episodes})
SELECT rule_id, sensor_key, open_ts, false AS is_finish, open_ts AS row_ts, 'alert' AS route,
       CAST(NULL AS BIGINT) AS duration, CAST(0 AS DOUBLE) AS carbon_emissions FROM eps
UNION ALL
SELECT rule_id, sensor_key, open_ts, true AS is_finish, finish_ts AS row_ts, 'table' AS route,
       duration, carbon_emissions FROM eps WHERE is_finish
"""


EPISODE_CHANGELOG = changelog_sql(EPISODES_ALL)
_MESSAGE_ACT = f"act AS (SELECT key, project_id, ts, msg_id AS id, level FROM ({DECODE_ACTUATOR}))"
_MESSAGE_PRE = f"pre AS (SELECT key, project_id, ts, msg_id AS id, occupied, lux FROM ({DECODE_PRESENCE}))"
STREAM_MESSAGES = f"""
SELECT *, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BIGINT) AS msg_id, CAST(NULL AS VARCHAR) AS reason
FROM ({changelog_sql(episodes_sql(fx.RULES, _MESSAGE_ACT, _MESSAGE_PRE))})
UNION ALL BY NAME
SELECT * FROM ({DECODE_REJECTS})
"""

STREAM_SNAPSHOT_SEEDED = changelog_sql(episodes_sql(fx.RULES, _seeded(ACT), _seeded(PRE)))


def _calendar(ts: str, prefix: str = "time_") -> str:
    sat = f"(CAST({ts} AS DATE) + CAST(6 - dayofweek({ts}) AS INTEGER))"
    return (f"year({ts}) AS {prefix}year, month({ts}) AS {prefix}month, "
            f"day({ts}) AS {prefix}day, hour({ts}) AS {prefix}hour, "
            f"minute({ts}) AS {prefix}minute, second({ts}) AS {prefix}second, "
            f"CAST((dayofyear({sat}) + 6) // 7 AS INTEGER) AS {prefix}week, "
            f"CAST(dayofweek({ts}) AS INTEGER) AS {prefix}weekday")


EPISODE_CALENDAR = f"""
WITH eps AS ({EPISODES_ALL})
SELECT rule_id, sensor_key, open_ts, time, {_calendar('start_ts')} FROM eps
"""

# --- F10 F11 K2-K4 ---------------------------------------------------------------

_SAT = "(CAST(start_ts AS DATE) + CAST(6 - dayofweek(start_ts) AS INTEGER))"

CUBE_ROWS = f"""
WITH eps AS ({EPISODES_ALL})
SELECT rule_id, open_ts, sensor_key AS _key, time, {_calendar('start_ts')}, type, system,
       sensor_key, strategy, carbon_emissions, origin_data, message, duration, measure,
       true AS json_equal
FROM eps WHERE is_finish
"""

PUBLISH_ENVELOPE = f"""
WITH eps AS ({EPISODES_ALL}),
cl AS (
  SELECT * REPLACE (false AS is_finish, CAST(NULL AS BIGINT) AS duration,
                    CAST(0 AS DOUBLE) AS carbon_emissions) FROM eps
  UNION ALL
  SELECT * FROM eps WHERE is_finish)
SELECT rule_id, sensor_key, open_ts, is_finish, sensor_key AS env_key, time AS env_time,
       sensor_key AS item_key, '{fx.RULES['time_only']['table_id']}' AS source_id,
       (epoch_us(start_ts) // 1000) AS ts_ms, sensor_key AS value_key, time AS value_time,
       {_calendar('start_ts', 'value_time_')}, type AS value_type, system AS value_system,
       sensor_key AS value_sensor_key, strategy AS value_strategy,
       carbon_emissions AS value_carbon_emissions, origin_data AS value_origin_data,
       message AS value_message, coalesce(duration, 0) AS value_duration, measure AS value_measure
FROM cl
"""

_RECEIVERS = json.dumps(fx.RECEIVERS, ensure_ascii=False, separators=(",", ":"))

ALERT_OUTBOX = f"""
WITH eps AS ({EPISODES_ALL})
SELECT rule_id, sensor_key, open_ts, '{fx.RULES['time_only']['template_id']}' AS template_id,
       '{L.PRIORITY}' AS priority, '{L.SENDER_NAME}' AS sender_name,
       '{L.ALERT_TEXT_PREFIX}' || sensor_key || '{L.ALERT_TEXT_SUFFIX}' AS message,
       time AS datetime, '{_RECEIVERS}' AS receivers, '{L.SENDER_TYPE}' AS sender_type,
       '{L.SENDER_ID}' AS sender_id, '{L.ALERT_NAME}' AS alert_name
FROM eps
"""

# --- A1-A4 F12 T7 T8 P12 K5 --------------------------------------------------------

_FOLD = "list_reduce(list(lux ORDER BY ts, id), lambda acc, x: (x + acc) / 2)"


def _tumbling(width: str) -> str:
    return f"""
SELECT key, time_bucket(INTERVAL '{width}', ts) AS window_start,
       time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
       max(ts) AS ts, bool_or(occupied) AS occupied, {_FOLD} AS lux, count(*) AS n
FROM pre GROUP BY key, time_bucket(INTERVAL '{width}', ts)"""


PRESENCE_FOLD = f"""
WITH {PRE}
SELECT key, window_start, ts, occupied, lux, n FROM ({_tumbling('1 day')})
"""

PRESENCE_TUMBLING = f"""
WITH {PRE}
{_tumbling('1 hour')}
"""

_ROLL = f"(PARTITION BY key ORDER BY epoch_us(ts) RANGE BETWEEN {L.QUIET_S * US - 1} PRECEDING AND CURRENT ROW)"

PRESENCE_ROLLING = f"""
WITH {PRE}, tb AS ({_tumbling('1 hour')})
SELECT key, window_start, ts, bool_or(occupied) OVER w AS occupied_roll,
       avg(lux) OVER w AS lux_roll
FROM tb WINDOW w AS {_ROLL}
"""

_SUMMARY = f"""
{ACT}, {PRE},
rd AS (
  SELECT a.key, a.ts, a.id, 0 AS src, a.level, CAST(NULL AS BOOLEAN) AS occupied,
         CAST(NULL AS DOUBLE) AS lux, e.event_type AS message
  FROM act a JOIN events e ON e.event_id = a.id
  UNION ALL
  SELECT p.key, p.ts, p.id, 1 AS src, CAST(NULL AS DOUBLE) AS level, p.occupied, p.lux,
         e.event_type AS message
  FROM pre p JOIN events e ON e.event_id = p.id),
g AS (
  SELECT key, time_bucket(INTERVAL '1 hour', ts) AS window_start, max(ts) AS mts,
         (list(level ORDER BY ts DESC, id DESC) FILTER (WHERE src = 0))[1] AS opening_aperture,
         bool_or(occupied) FILTER (WHERE src = 1) AS sensor_occ,
         list_reduce(list(lux ORDER BY ts, id) FILTER (WHERE src = 1),
                     lambda acc, x: (x + acc) / 2) AS sensor_lux,
         string_agg(message, '|' ORDER BY ts, id) FILTER (WHERE message <> '') AS message,
         min(ts) FILTER (WHERE src = 0 AND level > {L.LEGACY_ON_LEVEL}) AS first_open,
         (list(key ORDER BY ts, id) FILTER (WHERE key <> ''))[1] AS name,
         (list(id % {fx.SET_WARNING[1]} = 0 ORDER BY ts DESC, id DESC)
            FILTER (WHERE id % {fx.SET_WARNING[0]} = 0))[1] AS set_warning,
         (list(epoch_us(ts) // 1000 ORDER BY ts DESC, id DESC)
            FILTER (WHERE id % {fx.SET_FIRST_OPEN} = 0))[1] AS set_first_open,
         (list('rule ' || message ORDER BY ts DESC, id DESC)
            FILTER (WHERE id % {fx.SET_STRATEGY} = 0))[1] AS set_strategy
  FROM rd GROUP BY key, time_bucket(INTERVAL '1 hour', ts)),
summary AS (
  SELECT key, window_start, name, (epoch_us(mts) // 1000) AS time_stamp,
         strftime(mts, '%Y-%m-%d %H:%M:%S') AS time_str,
         coalesce(opening_aperture > {L.LEGACY_ON_LEVEL}, false)
           AND NOT coalesce(sensor_occ, false) AS is_warning,
         opening_aperture, sensor_occ, sensor_lux, message,
         coalesce((epoch_us(first_open) // 1000), 0) AS first_open_time, '{L.LEGACY_STRATEGY}' AS strategy,
         set_warning, set_first_open, set_strategy
  FROM g)"""

_ORIGINAL = "opening_aperture AS original_opening, sensor_occ AS original_occ, sensor_lux AS original_lux"
WINDOW_SUMMARY = f"""
WITH {_SUMMARY}
SELECT * EXCLUDE (set_warning, set_first_open, set_strategy), {_ORIGINAL} FROM summary
"""

WINDOW_SETTERS = f"""
WITH {_SUMMARY}
SELECT key, window_start, name, coalesce(set_warning, is_warning) AS is_warning,
       coalesce(set_first_open, first_open_time) AS first_open_time,
       coalesce(set_strategy, strategy) AS strategy, {_ORIGINAL}
FROM summary
"""

LEGACY_EPISODES = f"""
WITH {ACT}, {PRE},
tb AS ({_tumbling('1 hour')}),
roll AS (SELECT *, bool_or(occupied) OVER w AS occ_roll FROM tb WINDOW w AS {_ROLL}),
ev AS (
  SELECT key, window_end AS t, 0 AS kind, CAST(0 AS BIGINT) AS id, CAST(NULL AS DOUBLE) AS level,
         occ_roll FROM roll
  UNION ALL
  SELECT key, ts AS t, 1 AS kind, id, coalesce(level, 0.0) AS level,
         CAST(NULL AS BOOLEAN) AS occ_roll FROM act),
st AS (
  SELECT *,
    last_value(CASE WHEN kind = 1 THEN t END IGNORE NULLS) OVER w AS a_ts,
    last_value(CASE WHEN kind = 1 THEN level END IGNORE NULLS) OVER w AS a_level
  FROM ev WINDOW w AS (PARTITION BY key ORDER BY t, kind, id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
nn AS (
  SELECT * FROM (
    SELECT *, CASE WHEN kind = 0 AND coalesce(a_level > {L.LEGACY_ON_LEVEL}, false)
                        AND NOT coalesce(occ_roll, false) THEN 'O'
                   WHEN kind = 1 AND level <= {L.LEGACY_ON_LEVEL} THEN 'C' END AS lab
    FROM st) WHERE lab IS NOT NULL),
pr AS (
  SELECT *,
    last_value(CASE WHEN lab = 'O' THEN t END IGNORE NULLS) OVER w2 AS o_t,
    last_value(CASE WHEN lab = 'O' THEN a_ts END IGNORE NULLS) OVER w2 AS o_start,
    max(CASE WHEN lab = 'C' THEN t END) OVER w2 AS c_t
  FROM nn WINDOW w2 AS (PARTITION BY key ORDER BY t, kind, id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT key AS sensor_key, o_start AS start_ts, t AS finish_ts, true AS is_finish,
       (epoch_us(t) - epoch_us(o_start)) // {US} AS duration,
       CAST({L.LEGACY_EMISSION_KG} AS DOUBLE) AS carbon_emissions, '{L.CARBON_UNIT}' AS carbon_unit,
       '{L.TYPE_LEGACY_WINDOW}' AS type, '{L.SYSTEM}' AS system, 'legacy' AS strategy,
       '' AS message, '{L.MEASURE}' AS measure,
       strftime(o_start, '%Y-%m-%d %H:%M:%S') AS time
FROM pr WHERE lab = 'C' AND o_t IS NOT NULL AND (c_t IS NULL OR o_t > c_t)
"""

LEGACY_WARNINGS = f"""
WITH {_SUMMARY}
SELECT name AS sensor_key, make_timestamp(time_stamp * 1000) AS start_ts, false AS is_finish,
       '{L.TYPE_LEGACY_WARNING}' AS type, '{L.SYSTEM}' AS system,
       '{L.LEGACY_STRATEGY}' AS strategy, message, '{L.MEASURE}' AS measure,
       strftime(make_timestamp(time_stamp * 1000), '%Y-%m-%d %H:%M:%S') AS time, {_ORIGINAL}
FROM summary WHERE is_warning
"""

ALERT_START_MS = 1704240000 * 1000

ALERT_SUPPRESSED = f"""
WITH RECURSIVE {_SUMMARY},
w AS (SELECT name AS key, time_stamp FROM summary
      WHERE is_warning AND time_stamp >= {ALERT_START_MS}),
chain(key, sent) AS (
  SELECT key, min(time_stamp) FROM w GROUP BY key
  UNION ALL
  SELECT c.key, (SELECT min(w2.time_stamp) FROM w w2
                 WHERE w2.key = c.key AND w2.time_stamp > c.sent + {L.ALERT_GAP_S * 1000})
  FROM chain c WHERE c.sent IS NOT NULL)
SELECT key, sent AS time_stamp,
       strftime(make_timestamp(sent * 1000), '%Y-%m-%d %H:%M:%S') AS datetime,
       '{L.ALERT_TEXT_PREFIX}' || key || '{L.ALERT_TEXT_SUFFIX}' AS message,
       '{L.PRIORITY}' AS priority, '{L.SENDER_NAME}' AS sender_name, '{L.SENDER_TYPE}' AS sender_type,
       '{L.SENDER_ID}' AS sender_id, '{L.ALERT_NAME}' AS alert_name,
       '{L.ALERT_TEXT_PREFIX}' || key || '{L.ALERT_TEXT_SUFFIX}' AS body_message,
       strftime(make_timestamp(sent * 1000), '%Y-%m-%d %H:%M:%S') AS body_datetime,
       '{_RECEIVERS}' AS receivers
FROM chain WHERE sent IS NOT NULL
"""

_LOG = f"""
log AS (
  SELECT event_id AS msg_id, CAST(user_id AS VARCHAR) AS key, value AS lux,
         make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts,
         CASE WHEN event_id % {fx.BREAK_NOT_JSON} = 0 THEN 'not_json'
              WHEN event_id % {fx.BREAK_BAD_TIME} = 0 THEN 'no_time' END AS reason
  FROM events WHERE event_type IN ({_types(fx.PRESENCE_TYPES)}))"""

LOG_DECODE = f"""
WITH {_LOG}
SELECT msg_id, CASE WHEN reason IS NULL THEN key END AS key,
       CASE WHEN reason IS NULL THEN lux END AS lux,
       CASE WHEN reason IS NULL THEN ts END AS ts, reason
FROM log
"""

STREAM_LOG = f"""
WITH {_LOG}
SELECT key, lux, ts FROM log WHERE reason IS NULL
"""

# late: more than the bound before the latest time of the slices before
STREAM_LATE = f"""
WITH {PRE},
fast AS (SELECT key, id, epoch_us(ts) // {fx.FAST} AS us,
                CASE WHEN id % {fx.LONG_LAG_EVERY} = 0 THEN {fx.LONG_LAG_S}
                     WHEN id % {fx.SHORT_LAG_EVERY} = 0 THEN {fx.SHORT_LAG_S} ELSE 0 END * {US} AS behind FROM pre),
span AS (SELECT min(us + behind) AS lo, CAST(round_even(
           (max(us + behind) + 1 - min(us + behind)) / {fx.LAG_SLICES}, 0) AS BIGINT) AS step FROM fast),
cut AS (SELECT fast.*, least((us + behind - lo) // step, {fx.LAG_SLICES} - 1) AS slice FROM fast, span),
marks AS (SELECT slice, max(max(us)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
          FROM cut GROUP BY slice)
SELECT key, id, make_timestamp(us) AS ts,
       coalesce(us < top // 1000 * 1000 - {L.DISORDER_S} * {US}, false) AS late
FROM cut JOIN marks USING (slice)
"""

SQL: dict[str, str] = {
    "snapshot_latest": SNAPSHOT_LATEST,
    "snapshot_then_changes": SNAPSHOT_THEN_CHANGES,
    "dim_power": DIM_POWER,
    "dim_missing_keys": DIM_MISSING_KEYS,
    "rules_exploded": RULES_EXPLODED,
    "decode_presence": DECODE_PRESENCE,
    "decode_actuator": DECODE_ACTUATOR,
    "decode_rejects": DECODE_REJECTS,
    "valid_flat": VALID_FLAT,
    "log_decode": LOG_DECODE,
    "whitelist": WHITELIST,
    "threshold_flags": THRESHOLD_FLAGS,
    "in_schedule": IN_SCHEDULE,
    "next_start_gap": NEXT_START_GAP,
    "asof_actuator": ASOF_ACTUATOR,
    "quiet_lookback": QUIET_LOOKBACK,
    "settle_warmup": SETTLE_WARMUP,
    **{f"episodes_{n}": episodes_sql([n]) for n in fx.RULES},
    "episodes_by_rule": EPISODES_ALL,
    "episodes_from_rule_file": EPISODES_ALL,
    "episode_changelog": EPISODE_CHANGELOG,
    "episode_calendar": EPISODE_CALENDAR,
    "cube_rows": CUBE_ROWS,
    "publish_envelope": PUBLISH_ENVELOPE,
    "alert_outbox": ALERT_OUTBOX,
    "presence_fold": PRESENCE_FOLD,
    "presence_tumbling": PRESENCE_TUMBLING,
    "presence_rolling": PRESENCE_ROLLING,
    "window_summary": WINDOW_SUMMARY,
    "window_setters": WINDOW_SETTERS,
    "legacy_episodes": LEGACY_EPISODES,
    "legacy_warnings": LEGACY_WARNINGS,
    "alert_suppressed": ALERT_SUPPRESSED,
    # streaming runs must equal the batch changelog
    "stream_episodes_by_rule": EPISODE_CHANGELOG,
    "stream_handover": EPISODE_CHANGELOG,
    "stream_handover_drop": EPISODE_CHANGELOG,
    "stream_handover_restart": EPISODE_CHANGELOG,
    "stream_round_trip": EPISODE_CHANGELOG,
    "stream_messages": STREAM_MESSAGES,
    "stream_snapshot_seeded": STREAM_SNAPSHOT_SEEDED,
    "stream_log": STREAM_LOG,
    "stream_legacy_episodes": LEGACY_EPISODES,
    "stream_late": STREAM_LATE,
    "stream_alert_suppressed": ALERT_SUPPRESSED,
}
