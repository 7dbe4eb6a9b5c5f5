"""Fixed values.

These strings, thresholds and formats must equal the ones downstream
consumers already read (episode tables, alert templates); they are kept
here verbatim, together, in their natural order.
"""

# --- fixed values: strategy names ------------------------------------------
TIME_ONLY = "time_only"              # schedule only
SENSOR_ONLY = "sensor_only"          # presence only
SENSOR_AND_TIME = "sensor_and_time"  # presence and schedule
STRATEGIES = (TIME_ONLY, SENSOR_ONLY, SENSOR_AND_TIME)

# --- fixed values: episode labels ------------------------------------------
SYSTEM = "照明系统"
TYPE_TIME_ONLY = "非工作时间开启照明"
TYPE_SENSOR_ONLY = "无人状态下开启照明"
TYPE_SENSOR_AND_TIME = "非工作时间无人状态下开启照明"
TYPE_LEGACY_WINDOW = "无人值守"
TYPE_LEGACY_WARNING = "无人开启照明"
LEGACY_STRATEGY = "策略"
MEASURE = "关闭"
CARBON_UNIT = "kg"

TYPE_BY_STRATEGY = {
    TIME_ONLY: TYPE_TIME_ONLY,
    SENSOR_ONLY: TYPE_SENSOR_ONLY,
    SENSOR_AND_TIME: TYPE_SENSOR_AND_TIME,
}

# --- fixed values: alert body ----------------------------------------------
SENDER_TYPE = "系统"
SENDER_ID = 0
SENDER_NAME = "照明异常检测"
PRIORITY = "高"
ALERT_NAME = "照明异常"
ALERT_TEXT_PREFIX = "照明设备"
ALERT_TEXT_SUFFIX = "存在灯光开启无人值守情况"
PROGRAM_START_PREFIX = "programStartTime:"

# --- fixed values: thresholds, gates, formats ------------------------------
ON_LEVEL = 5.0              # on iff level >= 5
LEGACY_ON_LEVEL = 0.5       # legacy rule: on iff level > 0.5
QUIET_S = 20 * 60           # presence look-back
SETTLE_S = 60               # actuator report must be this much older
WARMUP_S = 20 * 60          # after program start
SENSOR_ONLY_EMISSION_S = 5 * 60 * 60   # flat emission window of sensor_only
LEGACY_EMISSION_KG = 1.0
ALERT_GAP_S = 24 * 60 * 60  # one alert per key per day
EPOCH_SECONDS_LIMIT = 100000000000     # below: seconds, else milliseconds
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ZONE = "Asia/Shanghai"      # wall-clock zone of the original deployment
DISORDER_S = 5              # bounded out-of-orderness of the log source
PRESENCE_KEY_FIELD = "sensor_4"
ACTUATOR_KEY_FIELD = "switch_4"
CHANNEL_SUFFIX = "-records"
