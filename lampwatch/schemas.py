"""Explicit schemas.  Nothing is inferred on streams."""

from pyspark.sql import types as T

ACTUATOR = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("project_id", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("id", T.LongType()),
    T.StructField("level", T.DoubleType()),
])

PRESENCE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("project_id", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("id", T.LongType()),
    T.StructField("occupied", T.BooleanType()),
    T.StructField("lux", T.DoubleType()),
])

RECEIVER = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

RULES = T.StructType([
    T.StructField("rule_id", T.StringType()),
    T.StructField("project_id", T.IntegerType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("hour_start", T.IntegerType()),
    T.StructField("minute_start", T.IntegerType()),
    T.StructField("hour_end", T.IntegerType()),
    T.StructField("minute_end", T.IntegerType()),
    T.StructField("keys", T.ArrayType(T.StringType())),
    T.StructField("factor", T.DoubleType()),
    T.StructField("template_id", T.StringType()),
    T.StructField("receivers", T.ArrayType(RECEIVER)),
    T.StructField("table_id", T.StringType()),
    T.StructField("program_start", T.TimestampNTZType()),
    T.StructField("on_level", T.DoubleType()),
    T.StructField("quiet_s", T.IntegerType()),
    T.StructField("settle_s", T.IntegerType()),
    T.StructField("warmup_s", T.IntegerType()),
])

# decoded JSON payloads; numbers are read as DOUBLE so that a non-number
# decodes to NULL for that field only
PRESENCE_JSON = T.StructType([
    T.StructField("item", T.StructType([
        T.StructField("value", T.StructType([
            T.StructField("sensor_4", T.StringType()),
            T.StructField("_projectId", T.IntegerType()),
            T.StructField("lux", T.DoubleType()),
            T.StructField("occupancy", T.DoubleType()),
            T.StructField("time", T.StringType()),
        ])),
    ])),
])

ACTUATOR_JSON = T.StructType([
    T.StructField("item", T.StructType([
        T.StructField("value", T.StructType([
            T.StructField("switch_4", T.StringType()),
            T.StructField("_projectId", T.IntegerType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("time", T.StringType()),
        ])),
    ])),
])
