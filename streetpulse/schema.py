"""Schemas of the data model and the fixed lookup tables.

Every table here is a plain Spark schema; the fixed tables are tiny literal
DataFrames (a handful of rows, size known in advance) and are the only frames
the library broadcasts without a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- D1: raw reading (long format, one metric per message) -------------------
LOCATION = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("road", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

# Wire form: ``ts`` is ISO-8601 text, parsed by ``sources.streams.parse_messages``.
RAW_MESSAGE = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("location", LOCATION),
])

# Parsed form used by every batch operator. Times are UTC wall-clock values
# kept as TIMESTAMP_NTZ so results never depend on a session time zone.
READING = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("location", LOCATION),
])

# --- D2: sensor_metadata -------------------------------------------------------
SENSOR_METADATA = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("road", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("interval_s", T.IntegerType()),
])


# --- D4: alerts -----------------------------------------------------------------
ALERTS = T.StructType([
    T.StructField("alert_id", T.StringType(), False),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("location", T.MapType(T.StringType(), T.StringType())),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("resolved", T.BooleanType()),
    T.StructField("threshold_type", T.StringType()),
    T.StructField("threshold_value", T.DoubleType()),
])

# --- D5: ai_training_data ---------------------------------------------------------
AI_TRAINING_DATA = T.StructType([
    T.StructField("training_id", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("vehicle_count", T.DoubleType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("wait_time_s", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("is_rush_hour", T.BooleanType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("discovered_pattern", T.StringType()),
    T.StructField("pattern_confidence", T.DoubleType()),
    T.StructField("used_for_training", T.BooleanType()),
])


# --- D7: scoring struct ---------------------------------------------------------------
SCORING = T.StructType([
    T.StructField("ai_traffic_state", T.StringType()),
    T.StructField("ai_confidence", T.DoubleType()),
    T.StructField("ai_severity", T.StringType()),
    T.StructField("ai_predicted_duration", T.StringType()),
    T.StructField("ai_anomaly_detected", T.BooleanType()),
    T.StructField("ai_anomaly_score", T.DoubleType()),
    T.StructField("ai_model_version", T.StringType()),
])

# ---------------------------------------------------------------------------------
# Fixed values. These must equal the reference system's values for equal results.
# ---------------------------------------------------------------------------------

# D8 valid ranges: metric, min, max (inclusive)
VALID_RANGES = [
    ("vehicle_count", 0.0, 100.0),
    ("avg_speed", 0.0, 120.0),
    ("wait_time_s", 0.0, 600.0),
    ("pm25", 0.0, 500.0),
    ("noise_db", 30.0, 120.0),
    ("temp_c", -30.0, 50.0),
]

# D9 alert limits: sensor_type, metric, warning, critical, direction
# ("low": value <= limit breaches, critical tested first; "high": value >= limit)
ALERT_LIMITS = [
    ("traffic_loop", "wait_time_s", 8.0, 12.0, "high"),
    ("traffic_loop", "vehicle_count", 8.0, 12.0, "high"),
    ("traffic_loop", "avg_speed", 55.0, 60.0, "low"),
    ("air_quality", "pm25", 15.0, 20.0, "high"),
    ("air_quality", "co", 5.0, 8.0, "high"),
    ("noise", "noise_db", 50.0, 55.0, "high"),
]

# D10 sensor types by id prefix
SENSOR_TYPE_PREFIXES = [("Loop-", "traffic_loop"), ("Air-", "air_quality"), ("Noise-", "noise")]
# metric fallback when the id has no known prefix
AIR_METRICS = ["pm25", "co", "temp_c"]
NOISE_METRICS = ["noise_db"]

# P9 long metric -> wide column of aggregates_minute
WIDE_COLUMNS = [
    ("vehicle_count", "vehicle_count_per_min"),
    ("avg_speed", "avg_speed_kmh"),
    ("wait_time_s", "avg_wait_time_s"),
    ("pm25", "pm25"),
    ("noise_db", "noise_db"),
    ("temp_c", "temp_c"),
]

CITY = "Prishtina"
COUNTRY = "Kosovo"
# P7 default coordinates (city centre)
DEFAULT_LAT = 42.6629
DEFAULT_LON = 21.1655

RANGE_SCHEMA = "metric string, min_value double, max_value double"
LIMIT_SCHEMA = "sensor_type string, metric string, warning double, critical double, direction string"


def _values(spark: SparkSession, rows, names) -> DataFrame:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def valid_ranges(spark: SparkSession, rows=None) -> DataFrame:
    """D8 as a local relation (a handful of literal rows)."""
    return _values(spark, rows if rows is not None else VALID_RANGES, ["metric", "min_value", "max_value"])


def alert_limits(spark: SparkSession, rows=None) -> DataFrame:
    """D9 as a local relation (a handful of literal rows)."""
    return _values(spark, rows if rows is not None else ALERT_LIMITS,
                   ["sensor_type", "metric", "warning", "critical", "direction"])
