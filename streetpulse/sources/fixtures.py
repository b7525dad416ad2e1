"""Sensor data derived from the driver's ``events`` table.

No sensor table is given, so readings (D1) and sensor metadata (D2) are derived
from ``events`` by a fixed, deterministic mapping (FIXTURES.md). The number of
sensors grows with the number of users, so every query's work grows with the
input. Everything here is a projection or a small aggregation: no collect, no
Python per row.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "events.parquet"))


# The mapping events -> readings, as SQL expressions over ``events`` columns
# (one expression string per column: parsed once on the JVM side).
KIND = "user_id % 3"
NUMBER = "CAST(floor(user_id / 3) + 1 AS INT)"


def padded(number: str) -> str:
    """'%04d' of a number; lpad (cheap) on the usual range, format_string beyond it."""
    return (f"CASE WHEN {number} >= 0 AND {number} < 10000 THEN lpad(CAST({number} AS STRING), 4, '0') "
            f"ELSE format_string('%04d', {number}) END")


SENSOR_ID = (f"concat(CASE {KIND} WHEN 0 THEN 'Loop-' WHEN 1 THEN 'Air-' ELSE 'Noise-' END, "
             f"{padded(NUMBER)})")
SENSOR_TYPE = f"CASE {KIND} WHEN 0 THEN 'traffic_loop' WHEN 1 THEN 'air_quality' ELSE 'noise' END"
# Every event gives the readings of one device at one time: (place, metric, value).
MEASURES = f"""CASE {KIND}
  WHEN 0 THEN array(struct(0 AS k, 'vehicle_count' AS m, value / 4 AS v), struct(1 AS k, 'avg_speed' AS m, 125 - value / 4 AS v),
                    struct(2 AS k, 'wait_time_s' AS m, CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value / 5 END AS v),
                    struct(3 AS k, 'queue_len' AS m, CASE WHEN event_type = 'error' THEN value END AS v))
  WHEN 1 THEN array(struct(0 AS k, 'pm25' AS m, CASE WHEN event_type IN ('click', 'view') THEN value * 2 ELSE value / 10 END AS v),
                    struct(1 AS k, 'temp_c' AS m, value / 8 - 10 AS v),
                    struct(2 AS k, 'co' AS m, CASE WHEN event_type = 'error' THEN value / 10 END AS v))
  ELSE array(struct(0 AS k, 'noise_db' AS m, value / 2 + 25 AS v)) END"""
# Some events are bad in a fixed way, by their number: the first ones of every 101.
BAD = "event_id % 101"


def _road_sql(kind: str, number: str) -> str:
    return (f"CASE {kind} WHEN 0 THEN concat('Road ', {number}) "
            f"WHEN 1 THEN concat('Air Quality Station ', {number}) "
            f"ELSE concat('Noise Monitoring Point ', {number}) END")


def _coord_sql(number: str, base: float, mult: int) -> str:
    # base +- 0.05 computed from the sensor number; null for every 7th sensor
    return (f"CASE WHEN {number} % 7 = 0 THEN CAST(NULL AS DOUBLE) "
            f"ELSE {base}D + CAST(({number} * {mult}) % 101 - 50 AS DOUBLE) / 1000.0D END")


def sensor_type_from_id(sensor_id: Column) -> Column:
    expr = None
    for prefix, kind in schema.SENSOR_TYPE_PREFIXES:
        expr = (F.when(sensor_id.startswith(prefix), kind) if expr is None
                else expr.when(sensor_id.startswith(prefix), kind))
    return expr


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 readings: event_id, sensor_id, ts (UTC, timestamp_ntz), metric, value, location."""
    return readings_from_events(events(spark, sf_dir))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream (S1 over files)."""
    path = os.path.join(sf_dir, "events.parquet")
    schema_ = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema_)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    # a glob keeps the folder as the base path when the table is a single file
    return r.parquet(path[:-1] + "[" + path[-1] + "]")


def readings_from_events(ev: DataFrame) -> DataFrame:
    """Batch or streaming events -> D1 readings (a projection)."""
    loc = (f"named_struct('city', '{schema.CITY}', 'road', {_road_sql(KIND, NUMBER)}, "
           f"'lat', {_coord_sql(NUMBER, 42.6629, 37)}, 'lon', {_coord_sql(NUMBER, 21.1639, 53)})")
    rows = ev.selectExpr("event_id", "user_id", "ts", f"filter({MEASURES}, x -> x.v IS NOT NULL) AS ms").selectExpr(
        "event_id", "user_id", "ts", "explode(ms) AS x")
    return rows.selectExpr(
        "event_id * 4 + x.k AS event_id",
        f"CASE {BAD} WHEN 3 THEN '' WHEN 5 THEN concat('S-', {NUMBER}) ELSE {SENSOR_ID} END AS sensor_id",
        f"CASE WHEN {BAD} = 6 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE ts END AS ts",
        f"CASE WHEN {BAD} = 4 THEN CAST(NULL AS STRING) ELSE x.m END AS metric",
        f"CASE {BAD} WHEN 0 THEN CAST(NULL AS DOUBLE) WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN 1E15D ELSE x.v END AS value",
        f"{loc} AS location")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in wire form: one JSON text per message, key = sensor_id, as the
    producers publish them (ts as ISO-8601 text with a trailing ``Z``)."""
    r = readings(spark, sf_dir)
    msg = F.struct(
        "sensor_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
        "metric", "value", "location")
    return r.select(F.col("sensor_id").alias("key"), F.to_json(msg).alias("value"), "event_id")


def sensor_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sensor seen in ``events`` plus one sensor per type that
    has no readings (the next free number), so inner and outer joins differ."""
    ev = events(spark, sf_dir)
    seen = ev.select("user_id").distinct().selectExpr(f"{KIND} AS kind", f"{NUMBER} AS number")
    spare = seen.groupBy("kind").agg((F.max("number") + 1).alias("number"))
    ids = seen.unionByName(spare)
    return ids.selectExpr(
        f"concat(CASE kind WHEN 0 THEN 'Loop-' WHEN 1 THEN 'Air-' ELSE 'Noise-' END, "
        f"{padded('number')}) AS sensor_id",
        "CASE kind WHEN 0 THEN 'traffic_loop' WHEN 1 THEN 'air_quality' ELSE 'noise' END AS type",
        "CASE kind WHEN 0 THEN 'vehicles/min' WHEN 1 THEN 'µg/m³' ELSE 'dB' END AS unit",
        f"'{schema.CITY}' AS city",
        f"{_road_sql('kind', 'number')} AS road",
        f"{_coord_sql('number', 42.6629, 37)} AS lat",
        f"{_coord_sql('number', 21.1639, 53)} AS lon",
        "60 AS interval_s")
