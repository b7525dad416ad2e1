"""Threshold alerts: breach rule (P5), message text (P6), location (P8), alert
rows (D4), unresolved scan (S7), resolve (S8), counts (A17), notification
text (P19) and the critical feed (T9).

All stateless per reading: the only join is with the fixed limit table (D9,
broadcast); no shuffle of the readings at all until a count or a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import decimal_text, number_text
from .enrich import location_map, sensor_type, with_limits
from .quality import completeness

# Message templates per (sensor_type, metric) of the reference:
# (prefix, label, decimals, unit after value, unit after limit)
MESSAGE_TEMPLATES = [
    ("traffic_loop", "vehicle_count", "High vehicle count on ", "Vehicles: ", 0, "", ""),
    ("traffic_loop", "wait_time_s", "Long wait time on ", "Wait: ", 1, "s", "s"),
    ("traffic_loop", "avg_speed", "Slow traffic on ", "Speed: ", 1, " km/h", " km/h"),
    ("air_quality", "pm25", "High PM2.5 levels at ", "PM2.5: ", 1, " µg/m³", ""),
    ("air_quality", "co", "High CO levels at ", "CO: ", 1, " ppm", ""),
    ("noise", None, "High noise levels at ", "Noise: ", 1, " dB", " dB"),
]
# P19 type labels
NOTIFY_LABELS = [("air_quality", "AIR"), ("traffic_loop", "TRAFFIC"), ("noise", "NOISE")]


def severity_and_threshold(value: Column) -> tuple[Column, Column]:
    """P5 over J5 columns (warning, critical, direction): returns
    (severity, threshold). 'low' direction: value <= limit, critical first."""
    low = F.col("direction") == "low"
    crit = F.when(low, value <= F.col("critical")).otherwise(value >= F.col("critical"))
    warn = F.when(low, value <= F.col("warning")).otherwise(value >= F.col("warning"))
    sev = F.when(crit, "critical").when(warn, "warning")
    thr = F.when(crit, F.col("critical")).when(warn, F.col("warning"))
    return sev, thr


def alert_message(sensor_id: Column, stype: Column, metric: Column, value: Column,
                  threshold: Column) -> Column:
    """Text per type and metric; generic text otherwise."""
    lim = number_text(threshold)
    expr = None
    for t, m, prefix, label, digits, unit_v, unit_l in MESSAGE_TEMPLATES:
        cond = (stype == t) if m is None else ((stype == t) & (metric == m))
        txt = F.concat(F.lit(prefix), sensor_id, F.lit(f", {schema.CITY}. {label}"),
                       decimal_text(value, digits), F.lit(f"{unit_v} (limit: "), lim, F.lit(f"{unit_l})"))
        expr = F.when(cond, txt) if expr is None else expr.when(cond, txt)
    generic = F.concat(F.lit("Alert for "), sensor_id, F.lit(": "), metric, F.lit(" = "),
                       decimal_text(value, 2), F.lit(" (threshold: "), lim, F.lit(")"))
    return expr.otherwise(generic)


def alert_id(sensor_id: Column, metric: Column, ts: Column, value: Column) -> Column:
    """Deterministic id (R19): a hash of (sensor, metric, event time, value),
    laid out as a uuid; replaying a batch gives the same ids."""
    ts_text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    h = F.sha2(F.concat_ws("|", sensor_id, metric, ts_text, value.cast("string")), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def alerts_from_readings(readings: DataFrame, limits: DataFrame) -> DataFrame:
    """Readings -> D4 alert rows (T7 batch form). Event time is stored."""
    r = readings.filter(completeness(readings, strict_text=True))
    typed = r.withColumn("sensor_type", sensor_type("sensor_id", "metric"))
    j = with_limits(typed, limits)
    sev, thr = severity_and_threshold(F.col("value"))
    j = j.withColumn("severity", sev).withColumn("threshold_value", thr).filter(F.col("severity").isNotNull())
    return j.select(
        alert_id(F.col("sensor_id"), F.col("metric"), F.col("ts"), F.col("value")).alias("alert_id"),
        "sensor_id", "sensor_type", "metric", "value", "severity",
        alert_message(F.col("sensor_id"), F.col("sensor_type"), F.col("metric"), F.col("value"),
                      F.col("threshold_value")).alias("message"),
        location_map(F.col("sensor_id")).alias("location"),
        F.col("ts").alias("timestamp"),
        F.lit(False).alias("resolved"),
        F.col("severity").alias("threshold_type"),
        "threshold_value",
    )


def unresolved(alerts: DataFrame) -> DataFrame:
    """Active alerts."""
    return alerts.filter(~F.col("resolved"))


def resolve(alerts: DataFrame, ids: DataFrame) -> DataFrame:
    """Mark the alerts whose ``alert_id`` is in ``ids`` as resolved. The id
    set may be as large as the table: it is a left join, not a broadcast."""
    hit = ids.select(F.col("alert_id").alias("_hit")).distinct()
    return (alerts.join(hit, alerts["alert_id"] == hit["_hit"], "left")
            .withColumn("resolved", F.col("resolved") | F.col("_hit").isNotNull()).drop("_hit"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Total, active, active critical, active warning in one scan."""
    active = ~F.col("resolved")
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        F.count_if(active).alias("active_alerts"),
        F.count_if(active & (F.col("severity") == "critical")).alias("critical_count"),
        F.count_if(active & (F.col("severity") == "warning")).alias("warning_count"))


def notification_text(alerts: DataFrame) -> DataFrame:
    """Short text ``{TYPE} ALERT!\\n{road}: {metric}={value}``."""
    label = None
    for t, lab in NOTIFY_LABELS:
        label = F.when(F.col("sensor_type") == t, lab) if label is None else label.when(F.col("sensor_type") == t, lab)
    label = label.otherwise("ALERT")
    road = F.coalesce(F.col("location").getItem("road"), F.lit("Unknown"))
    text = F.concat(label, F.lit(" ALERT!\n"), road, F.lit(": "), F.col("metric"), F.lit("="),
                    F.col("value").cast("string"))
    return alerts.select("alert_id", "sensor_id", "timestamp", text.alias("notification"))


def critical_feed(alerts: DataFrame, minutes: int = 1, as_of: Column | None = None) -> DataFrame:
    """T9 batch form: critical alerts newer than ``as_of - minutes`` (default
    as-of: the newest alert time in the table)."""
    if as_of is None:
        as_of = alerts.agg(F.max("timestamp")).scalar()  # scalar subquery, no join
    j = alerts.filter(F.col("timestamp") > F.timestamp_add("MINUTE", F.lit(-minutes), as_of))
    return notification_text(j.filter(F.col("severity") == "critical"))
