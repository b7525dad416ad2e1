"""Enrichment and joins: sensor type (P3), default coordinates (P7), alert
location map (P8), metadata scans (S6), and the joins J1-J5.

Joins with ``sensor_metadata`` are left un-hinted: the dimension grows with
the fleet, so the broadcast decision is taken by adaptive execution from the
measured size of the shuffled side (``spark.sql.autoBroadcastJoinThreshold``);
above the threshold it stays a shuffle join. Only the fixed lookup tables
(D8, D9: a handful of literal rows) are broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..sources.fixtures import sensor_type_from_id
from .windows import latest_per_sensor, newest_n


def sensor_type(sensor_id, metric) -> Column:
    """Type by id prefix; otherwise by metric."""
    sid = F.col(sensor_id) if isinstance(sensor_id, str) else sensor_id
    m = F.col(metric) if isinstance(metric, str) else metric
    by_metric = (F.when(m.isin(*schema.AIR_METRICS), "air_quality")
                 .when(m.isin(*schema.NOISE_METRICS), "noise").otherwise("traffic_loop"))
    return F.coalesce(sensor_type_from_id(sid), by_metric)


def with_default_coords(meta: DataFrame) -> DataFrame:
    """Missing lat/lon -> city centre."""
    return (meta.withColumn("lat", F.coalesce(F.col("lat"), F.lit(schema.DEFAULT_LAT)))
                .withColumn("lon", F.coalesce(F.col("lon"), F.lit(schema.DEFAULT_LON))))


def road_from_id(sensor_id) -> Column:
    """P8 road: 'Road ' + part after the first '-', zero-padded to 2 (never cut);
    no '-' -> 'Road 01'."""
    sid = F.col(sensor_id) if isinstance(sensor_id, str) else sensor_id
    part = F.when(F.instr(sid, "-") > 0, F.split(sid, "-").getItem(1)).otherwise(F.lit("01"))
    padded = F.lpad(part, F.greatest(F.length(part), F.lit(2)), F.lit("0"))
    return F.concat(F.lit("Road "), padded)


def location_map(sensor_id) -> Column:
    """{road, city, country} map from the id."""
    return F.create_map(F.lit("road"), road_from_id(sensor_id), F.lit("city"), F.lit(schema.CITY),
                        F.lit("country"), F.lit(schema.COUNTRY))


# --------------------------------------------------------------------- S6 scans
META_COLUMNS = ["sensor_id", "type", "unit", "city", "road", "lat", "lon", "interval_s"]


def metadata_scan(meta: DataFrame, sensor_type_eq: str | None = None) -> DataFrame:
    """Metadata, optionally of one type (equality filter, pushed to the scan),
    coordinates defaulted (P7)."""
    m = meta if sensor_type_eq is None else meta.filter(F.col("type") == sensor_type_eq)
    return with_default_coords(m.select(*META_COLUMNS))


# ------------------------------------------------------------------------- joins
def latest_with_meta(agg: DataFrame, meta: DataFrame) -> DataFrame:
    """Latest minute row per sensor joined with metadata (inner: sensors
    without readings are omitted). Output carries ``sensor_type``."""
    latest = latest_per_sensor(agg)
    m = with_default_coords(meta).select(
        "sensor_id", F.col("type").alias("sensor_type"), "unit", "city", "road", "lat", "lon")
    return latest.join(m, "sensor_id")


def sensors_of_type_with_latest(agg: DataFrame, meta: DataFrame, stype: str) -> DataFrame:
    """Every sensor of a type with its latest row (left outer)."""
    m = metadata_scan(meta, stype)
    return m.join(latest_per_sensor(agg), "sensor_id", "left")


def sensor_detail(agg: DataFrame, meta: DataFrame, sensor_id: str, n: int = 10) -> DataFrame:
    """One sensor's metadata with its ``n`` newest minute rows."""
    m = metadata_scan(meta).filter(F.col("sensor_id") == sensor_id)
    rows = newest_n(agg.filter(F.col("sensor_id") == sensor_id), n)
    return m.join(rows, "sensor_id")


def history_of_type(agg: DataFrame, meta: DataFrame, stype: str) -> DataFrame:
    """Minute rows of sensors of one type (left semi join)."""
    return agg.join(meta.filter(F.col("type") == stype).select("sensor_id"), "sensor_id", "left_semi")


def with_limits(df: DataFrame, limits: DataFrame) -> DataFrame:
    """Readings left-joined with alert limits on (sensor_type, metric).
    ``limits`` is the fixed D9 table (6 rows): broadcast."""
    lim = F.broadcast(limits.select(F.col("sensor_type").alias("_lt"), F.col("metric").alias("_lm"),
                                    "warning", "critical", "direction"))
    return (df.join(lim, (df["sensor_type"] == lim["_lt"]) & (df["metric"] == lim["_lm"]), "left")
              .drop("_lt", "_lm"))
