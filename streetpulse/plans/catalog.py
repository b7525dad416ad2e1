"""Named queries: one per operator of the inventory. Each takes (spark, sf_dir)
and returns a lazy DataFrame over the driver's tables; ``ORACLE`` holds the
SQL twin where the result is expressible in SQL.

Frames are rebuilt per query from the parquet tables: every plan starts at a
scan, so Catalyst prunes columns and pushes filters down to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators import alerts as AL
from ..operators import enrich as EN
from ..operators import quality as QU
from ..operators import windows as WI
from ..sources import fixtures as FX
from ..session import session_key
from .oracle import _mean, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = sql(oracle)
        return fn
    return deco


# ------------------------------------------------------------- shared frames
# Shared intermediate frames are lazy logical plans; they are built once per
# session and data folder and reused by every query (no data is cached).
_FRAMES: dict = {}


def shared(fn):
    def get(spark, d, *args):
        key = (session_key(spark), d, fn.__name__, args)
        if key not in _FRAMES:
            _FRAMES[key] = fn(spark, d, *args)
        return _FRAMES[key]
    get.__name__ = fn.__name__
    get.__doc__ = fn.__doc__
    return get


@shared
def readings(spark, d):
    return FX.readings(spark, d)


@shared
def meta(spark, d):
    return FX.sensor_metadata(spark, d)


@shared
def validated(spark, d):
    complete, _ = QU.split_complete(readings(spark, d))
    return QU.validate(complete, schema.valid_ranges(spark))


@shared
def valid(spark, d):
    return validated(spark, d).filter("is_valid").select("event_id", "sensor_id", "ts", "metric", "value")


@shared
def agg(spark, d):
    return WI.aggregates_minute(valid(spark, d))


def agg_text(df: DataFrame) -> DataFrame:
    """Render the ``breaches`` array as text for comparison outputs."""
    return df.withColumn("breaches", F.array_join("breaches", ","))


@shared
def latest_meta(spark, d):
    return EN.latest_with_meta(agg(spark, d), meta(spark, d))


@shared
def alerts(spark, d):
    return AL.alerts_from_readings(readings(spark, d), schema.alert_limits(spark))


AGG_TEXT_SQL = "array_to_string(breaches, ',') AS breaches"

# ======================================================================== 2.1
_FINITE = "coalesce(abs(value) <= 1e12, false)"
_KEYS = f"(sensor_id IS NOT NULL AND ts IS NOT NULL AND metric IS NOT NULL AND {_FINITE})"


@register("S2", f"""
SELECT count(*) FILTER (WHERE {_KEYS}) AS complete_rows, count(*) FILTER (WHERE NOT {_KEYS}) AS quarantined_rows,
       count(*) FILTER (WHERE coalesce(sensor_id <> '', false) AND coalesce(metric <> '', false) AND {_FINITE}) AS alert_complete_rows
FROM readings""")
def q_s2(spark, d):
    r = readings(spark, d)
    ok = QU.completeness(r)
    return r.agg(F.count_if(ok).alias("complete_rows"),
                 F.count_if(~F.coalesce(ok, F.lit(False))).alias("quarantined_rows"),
                 F.count_if(QU.completeness(r, strict_text=True)).alias("alert_complete_rows"))


# ======================================================================== 2.2
@register("P1", """
SELECT event_id, sensor_id, metric, value, is_valid, validation_msg FROM validated""")
def q_p1(spark, d):
    return validated(spark, d).select("event_id", "sensor_id", "metric", "value", "is_valid", "validation_msg")


@register("P2", """
SELECT metric, count(*) FILTER (WHERE is_valid) AS valid_rows, count(*) FILTER (WHERE NOT is_valid) AS invalid_rows
FROM validated GROUP BY metric""")
def q_p2(spark, d):
    good, bad = QU.split_valid(validated(spark, d))
    return (good.select("metric", F.lit(1).alias("v"), F.lit(0).alias("i"))
            .unionByName(bad.select("metric", F.lit(0).alias("v"), F.lit(1).alias("i")))
            .groupBy("metric").agg(F.sum("v").cast("long").alias("valid_rows"),
                                   F.sum("i").cast("long").alias("invalid_rows")))


# ======================================================================== 2.4
@register("A1", f"""
SELECT sensor_id, date_trunc('minute', ts) AS window_start, metric,
  {_mean('value')} AS mean_value, count(*) AS n
FROM valid GROUP BY sensor_id, date_trunc('minute', ts), metric""")
def q_a1(spark, d):
    return WI.minute_means(valid(spark, d))


@register("P9", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg")
def q_p9(spark, d):
    return agg_text(agg(spark, d))


# ======================================================================== 2.5
@register("Q1", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM latest")
def q_q1(spark, d):
    return agg_text(WI.latest_per_sensor(agg(spark, d)))


# ======================================================================== 2.3
@register("J1", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM j1")
def q_j1(spark, d):
    return agg_text(latest_meta(spark, d))


# ======================================================================== A3
def _m(col):
    return f"coalesce({_mean(col)}, 0)"


@register("A3", f"""
SELECT sensor_type, count(*) AS sensor_count,
  {_m('vehicle_count_per_min')} AS vehicle_count_avg, {_m('avg_speed_kmh')} AS speed_avg,
  {_m('avg_wait_time_s')} AS wait_time_avg, {_m('pm25')} AS pm25_avg, {_m('temp_c')} AS temp_avg,
  {_m('noise_db')} AS noise_avg
FROM j1 GROUP BY sensor_type""")
def q_a3(spark, d):
    from ..operators.dashboards import fleet_statistics
    return fleet_statistics(latest_meta(spark, d))


# ============================================================== 2.1 sources
@register("S1", """
SELECT event_id, sensor_id, ts, metric, value FROM readings""")
def q_s1(spark, d):
    """S1 batch form: messages in wire form (JSON text) parsed back to rows."""
    from ..sources.streams import parse_messages
    return parse_messages(FX.raw_messages(spark, d)).select("event_id", "sensor_id", "ts", "metric", "value")


@register("S3", """
SELECT event_id, CASE WHEN event_id % 10 <> 7 THEN ts END AS ts, ts IS NOT NULL AND event_id % 10 <> 7 AS parsed_ok
FROM readings""")
def q_s3(spark, d):
    """S3: ISO-8601 text with 'Z' and '+00:00' parsed to the same UTC instant;
    every tenth text is no time."""
    r = readings(spark, d)
    z = F.when(F.col("event_id") % 10 == 7, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    off = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00")
    a, b = QU.parse_iso_ts(z), QU.parse_iso_ts(off)
    return r.select("event_id", a.alias("ts"), F.coalesce(a == b, F.lit(False)).alias("parsed_ok"))


@register("S6", "SELECT * FROM meta_d WHERE type = 'air_quality'")
def q_s6(spark, d):
    return EN.metadata_scan(meta(spark, d), "air_quality")


def resolved_alerts(spark, d):
    """S8 by age: alerts older than 7 days before the newest reading that has an
    alert are resolved; a rule on the row itself, no join (ids: ``S8_stored``)."""
    a = alerts(spark, d)
    newest = a.agg(F.max("timestamp")).scalar()
    old = F.coalesce(F.col("timestamp") < F.timestamp_add("DAY", F.lit(-7), newest), F.lit(False))
    return a.withColumn("resolved", F.col("resolved") | old)


RESOLVED_SQL = """(SELECT * REPLACE (coalesce(timestamp < (SELECT max(timestamp) FROM alerts) - INTERVAL 7 DAY, false) AS resolved) FROM alerts)"""


@register("S8", f"SELECT alert_id, resolved FROM {RESOLVED_SQL}")
def q_s8(spark, d):
    return resolved_alerts(spark, d).select("alert_id", "resolved")


@register("S7", f"""
SELECT alert_id, sensor_id, sensor_type, metric, value, severity, timestamp FROM {RESOLVED_SQL} WHERE NOT resolved""")
def q_s7(spark, d):
    return AL.unresolved(resolved_alerts(spark, d)).select(
        "alert_id", "sensor_id", "sensor_type", "metric", "value", "severity", "timestamp")


# ============================================================== 2.2 predicates
@register("P3", """
SELECT event_id, sensor_id, metric,
  coalesce(CASE WHEN starts_with(sensor_id, 'Loop-') THEN 'traffic_loop' WHEN starts_with(sensor_id, 'Air-') THEN 'air_quality'
                WHEN starts_with(sensor_id, 'Noise-') THEN 'noise' END,
           CASE WHEN metric IN ('pm25','co','temp_c') THEN 'air_quality' WHEN metric = 'noise_db' THEN 'noise' ELSE 'traffic_loop' END) AS sensor_type
FROM readings""")
def q_p3(spark, d):
    return readings(spark, d).select("event_id", "sensor_id", "metric",
                                     EN.sensor_type("sensor_id", "metric").alias("sensor_type"))


@register("P4", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM j1 WHERE sensor_type = 'air_quality'")
def q_p4(spark, d):
    from ..operators.dashboards import select_sensors
    return agg_text(select_sensors(latest_meta(spark, d), stype="air_quality"))


@register("P4_sensor", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM j1 WHERE sensor_id = 'Loop-0001'")
def q_p4_sensor(spark, d):
    from ..operators.dashboards import select_sensors
    return agg_text(select_sensors(latest_meta(spark, d), stype="air_quality", sensor_id="Loop-0001"))


@register("P5", """
SELECT r.event_id, r.sensor_type, r.metric, r.value,
  CASE WHEN crit THEN 'critical' WHEN warn THEN 'warning' END AS severity,
  CASE WHEN crit THEN l.critical WHEN warn THEN l.warning END AS threshold_value
FROM (SELECT *, coalesce(CASE WHEN starts_with(sensor_id, 'Loop-') THEN 'traffic_loop' WHEN starts_with(sensor_id, 'Air-') THEN 'air_quality'
                WHEN starts_with(sensor_id, 'Noise-') THEN 'noise' END,
           CASE WHEN metric IN ('pm25','co','temp_c') THEN 'air_quality' WHEN metric = 'noise_db' THEN 'noise' ELSE 'traffic_loop' END) AS sensor_type
      FROM readings WHERE coalesce(abs(value) <= 1e12, false)) r
LEFT JOIN limits l ON r.sensor_type = l.sensor_type AND r.metric = l.metric,
LATERAL (SELECT CASE WHEN l.direction = 'low' THEN r.value <= l.critical ELSE r.value >= l.critical END AS crit,
                CASE WHEN l.direction = 'low' THEN r.value <= l.warning ELSE r.value >= l.warning END AS warn)""")
def q_p5(spark, d):
    r = readings(spark, d).filter(QU.finite(F.col("value"))).withColumn(
        "sensor_type", EN.sensor_type("sensor_id", "metric"))
    j = EN.with_limits(r, schema.alert_limits(spark))
    sev, thr = AL.severity_and_threshold(F.col("value"))
    return j.select("event_id", "sensor_type", "metric", "value", sev.alias("severity"), thr.alias("threshold_value"))


@register("P6", "SELECT alert_id, message FROM alerts")
def q_p6(spark, d):
    return alerts(spark, d).select("alert_id", "message")


@register("P7", "SELECT * FROM meta_d")
def q_p7(spark, d):
    return EN.metadata_scan(meta(spark, d))


@register("P8", """
SELECT sensor_id, 'Road ' || CASE WHEN length(pt) >= 2 THEN pt ELSE lpad(pt, 2, '0') END AS road,
  'Prishtina' AS city, 'Kosovo' AS country
FROM (SELECT sensor_id, CASE WHEN strpos(sensor_id, '-') > 0 THEN split_part(sensor_id, '-', 2) ELSE '01' END AS pt FROM meta)""")
def q_p8(spark, d):
    loc = EN.location_map(F.col("sensor_id"))
    return meta(spark, d).select("sensor_id", loc.getItem("road").alias("road"), loc.getItem("city").alias("city"),
                                 loc.getItem("country").alias("country"))


# ================================================================= 2.3 joins
J2_SQL = f"""
SELECT m.*, l.* EXCLUDE (sensor_id, breaches), array_to_string(l.breaches, ',') AS breaches
FROM meta_d m LEFT JOIN latest l USING (sensor_id) WHERE m.type = 'traffic_loop'"""


@register("J2", J2_SQL)
def q_j2(spark, d):
    return agg_text(EN.sensors_of_type_with_latest(agg(spark, d), meta(spark, d), "traffic_loop"))


@register("J3", f"""
SELECT m.*, a.* EXCLUDE (sensor_id, breaches), array_to_string(a.breaches, ',') AS breaches
FROM meta_d m JOIN (SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) AS INTEGER) AS rn
                    FROM agg WHERE sensor_id = 'Loop-0001') a USING (sensor_id)
WHERE m.sensor_id = 'Loop-0001' AND a.rn <= 10""")
def q_j3(spark, d):
    return agg_text(EN.sensor_detail(agg(spark, d), meta(spark, d), "Loop-0001", 10))


HIST_SQL = {t: f"(SELECT * FROM agg WHERE sensor_id IN (SELECT sensor_id FROM meta WHERE type = '{t}'))"
            for t in ("traffic_loop", "air_quality", "noise")}


@register("J4", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM {HIST_SQL['traffic_loop']}")
def q_j4(spark, d):
    return agg_text(EN.history_of_type(agg(spark, d), meta(spark, d), "traffic_loop"))


@register("J5", """
SELECT r.event_id, r.sensor_type, r.metric, l.warning, l.critical, l.direction
FROM (SELECT *, coalesce(CASE WHEN starts_with(sensor_id, 'Loop-') THEN 'traffic_loop' WHEN starts_with(sensor_id, 'Air-') THEN 'air_quality'
                WHEN starts_with(sensor_id, 'Noise-') THEN 'noise' END,
           CASE WHEN metric IN ('pm25','co','temp_c') THEN 'air_quality' WHEN metric = 'noise_db' THEN 'noise' ELSE 'traffic_loop' END) AS sensor_type
      FROM readings) r
LEFT JOIN limits l ON r.sensor_type = l.sensor_type AND r.metric = l.metric""")
def q_j5(spark, d):
    r = readings(spark, d).withColumn("sensor_type", EN.sensor_type("sensor_id", "metric"))
    return EN.with_limits(r, schema.alert_limits(spark)).select(
        "event_id", "sensor_type", "metric", "warning", "critical", "direction")


# ============================================================ 2.4 aggregates
@register("A2", f"""
SELECT sensor_id, metric, avg_value, min_value, max_value, count,
  CAST(sum(count) OVER (PARTITION BY sensor_id) AS BIGINT) AS window_size,
  min(_first) OVER (PARTITION BY sensor_id) AS range_start, max(_last) OVER (PARTITION BY sensor_id) AS range_end
FROM (SELECT sensor_id, metric, {_mean('value')} AS avg_value, min(value) AS min_value, max(value) AS max_value,
        count(*) AS count, min(ts) AS _first, max(ts) AS _last
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn FROM valid)
      WHERE rn <= 20 GROUP BY sensor_id, metric)""")
def q_a2(spark, d):
    return WI.last_readings_stats(valid(spark, d), 20)


@register("A17", f"""
SELECT count(*) AS total_alerts, count(*) FILTER (WHERE NOT resolved) AS active_alerts,
  count(*) FILTER (WHERE NOT resolved AND severity = 'critical') AS critical_count,
  count(*) FILTER (WHERE NOT resolved AND severity = 'warning') AS warning_count
FROM {RESOLVED_SQL}""")
def q_a17(spark, d):
    return AL.alert_counts(resolved_alerts(spark, d))


# =============================================================== 2.5 windows
@register("Q2", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) AS INTEGER) AS rn FROM agg) WHERE rn <= 10""")
def q_q2(spark, d):
    return agg_text(WI.newest_n(agg(spark, d), 10))


@register("Q2_period", f"""
SELECT sensor_id, window_start, vehicle_count_per_min, avg_speed_kmh, avg_wait_time_s, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) AS INTEGER) AS rn
  FROM {HIST_SQL['traffic_loop']}) WHERE rn <= 10080""")
def q_q2_period(spark, d):
    """E2 history: traffic sensors (J4), newest rows within the '1week' budget."""
    return _period(spark, d, "traffic_loop", "1week", ["vehicle_count_per_min", "avg_speed_kmh", "avg_wait_time_s"])


def _period(spark, d, stype, period, measures):
    h = EN.history_of_type(agg(spark, d), meta(spark, d), stype)
    return WI.newest_n(h, WI.period_budget(period, stype)).select("sensor_id", "window_start", *measures, "rn")


def _period_sql(stype: str, measures: str, rows: int) -> str:
    return f"""
SELECT sensor_id, window_start, {measures}, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) AS INTEGER) AS rn
  FROM {HIST_SQL[stype]}) WHERE rn <= {rows}"""


@register("Q2_day", _period_sql("traffic_loop", "vehicle_count_per_min, avg_speed_kmh, avg_wait_time_s", 1440))
def q_q2_day(spark, d):
    return _period(spark, d, "traffic_loop", "day", ["vehicle_count_per_min", "avg_speed_kmh", "avg_wait_time_s"])


@register("Q2_air", _period_sql("air_quality", "pm25, temp_c", 1440))
def q_q2_air(spark, d):
    """Air-quality history within the 'day' budget."""
    return _period(spark, d, "air_quality", "day", ["pm25", "temp_c"])


@register("Q2_noise", _period_sql("noise", "noise_db", 10080))
def q_q2_noise(spark, d):
    """Noise history within the 'week' budget."""
    return _period(spark, d, "noise", "week", ["noise_db"])


@register("Q3", """
SELECT event_id, sensor_id, ts, metric, value, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn FROM valid) WHERE rn <= 20""")
def q_q3(spark, d):
    return WI.last_readings(valid(spark, d), 20).select("event_id", "sensor_id", "ts", "metric", "value", "rn")


def _running_cols() -> str:
    out = []
    for m in ["vehicle_count", "avg_speed", "wait_time_s", "pm25", "noise_db", "temp_c"]:
        c = f"count(CASE WHEN metric = '{m}' THEN value END) OVER w"
        a = f"avg(CASE WHEN metric = '{m}' THEN value END) OVER w"
        out.append(f"{a} AS {m}_avg, {c} AS {m}_count")
    return ",\n  ".join(out)


@register("Q3_running", f"""
SELECT event_id, sensor_id, ts, metric, value, count(*) OVER w AS buffer_size,
  {_running_cols()}
FROM valid
WINDOW w AS (PARTITION BY sensor_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def q_q3_running(spark, d):
    """Q3 running form: statistics of each sensor's last 20 readings at every reading."""
    return WI.running_buffer_stats(valid(spark, d), 20)


SPIKES_SQL = """
SELECT event_id, sensor_id, metric, ts, value, recent_avg FROM (
  SELECT *, (lag(value, 2) OVER w + lag(value, 1) OVER w + value) / 3 AS recent_avg
  FROM valid WINDOW w AS (PARTITION BY sensor_id, metric ORDER BY ts, event_id))
WHERE value > recent_avg * 2"""


@register("Q4", SPIKES_SQL)
def q_q4(spark, d):
    return WI.spikes_scanned(valid(spark, d))


@register("A20", f"""
SELECT (SELECT count(*) FROM validated WHERE is_valid) AS messages_processed,
       (SELECT count(*) FROM validated WHERE NOT is_valid) AS validation_errors,
       (SELECT count(*) FROM ({SPIKES_SQL})) AS anomalies_detected""")
def q_a20(spark, d):
    return WI.counters_scanned(validated(spark, d))


@register("T3", f"""
SELECT sensor_id, metric, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
  {_mean('value')} AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*) AS count
FROM (SELECT v.*, date_trunc('minute', ts) - to_minutes(k) AS window_start FROM valid v, range(0, 10) r(k))
GROUP BY sensor_id, metric, window_start""")
def q_t3(spark, d):
    return WI.sliding_windows(valid(spark, d))


@register("T5", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg
WHERE window_start >= (SELECT max(window_start) FROM agg) - INTERVAL 24 HOUR""")
def q_t5(spark, d):
    return agg_text(WI.retained(valid(spark, d), 24))


@register("B1", f"SELECT sensor_id, window_start, status, {AGG_TEXT_SQL} FROM agg")
def q_b1(spark, d):
    return agg_text(agg(spark, d).select("sensor_id", "window_start", "status", "breaches"))


# ================================================================ alerts
ALERT_COLS = "alert_id, sensor_id, sensor_type, metric, value, severity, message, location['road'] AS road, timestamp, resolved, threshold_type, threshold_value"


@register("T7", f"SELECT {ALERT_COLS} FROM alerts")
def q_t7(spark, d):
    """T7 batch form: every reading that breaches a limit becomes an alert row."""
    a = alerts(spark, d)
    return a.select(*[c for c in a.columns if c != "location"], F.col("location")["road"].alias("road"))


NOTIFY_SQL = """(SELECT alert_id, sensor_id, timestamp, severity,
  CASE sensor_type WHEN 'air_quality' THEN 'AIR' WHEN 'traffic_loop' THEN 'TRAFFIC' WHEN 'noise' THEN 'NOISE' ELSE 'ALERT' END
  || ' ALERT!' || chr(10) || coalesce(location['road'], 'Unknown') || ': ' || metric || '=' || CAST(value AS VARCHAR) AS notification
  FROM alerts)"""


@register("P19", f"SELECT alert_id, sensor_id, timestamp, notification FROM {NOTIFY_SQL}")
def q_p19(spark, d):
    return AL.notification_text(alerts(spark, d))


@register("T9", f"""
SELECT alert_id, sensor_id, timestamp, notification FROM {NOTIFY_SQL}
WHERE severity = 'critical' AND timestamp > (SELECT max(timestamp) FROM alerts) - INTERVAL 1 MINUTE""")
def q_t9(spark, d):
    return AL.critical_feed(alerts(spark, d), minutes=1)


# ============================================================ dashboards
from ..operators import dashboards as DB  # noqa: E402


def _band_sql(x: str, spec) -> str:
    parts = [f"WHEN {x} IS NULL THEN NULL"]
    for label, upper, inclusive in spec:
        if upper is None:
            return "CASE " + " ".join(parts) + f" ELSE '{label}' END"
        parts.append(f"WHEN {x} {'<=' if inclusive else '<'} {upper} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def _dec(x: str, digits: int) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,12)), {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _zsum(c: str) -> str:
    return f"sum(coalesce({c}, 0))"


def _hist_sql(src: str, band_expr: str, labels) -> str:
    vals = ", ".join(f"({i}, '{lab}')" for i, lab in enumerate(labels))
    return (f"SELECT l.band_order, l.band, count(t.b) AS count FROM (VALUES {vals}) l(band_order, band) "
            f"LEFT JOIN (SELECT {band_expr} AS b FROM {src}) t ON t.b = l.band GROUP BY l.band_order, l.band")


def _dist_sql(src: str, band_expr: str, labels) -> str:
    order = "CASE band " + " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(labels)) + " END"
    return (f"SELECT {order} AS band_order, band, count(*) AS count FROM (SELECT {band_expr} AS band FROM {src}) "
            f"GROUP BY band")


def _labels(spec):
    return [x[0] for x in spec]


LATEST_T = "(SELECT * FROM j1 WHERE sensor_type = 'traffic_loop')"
LATEST_A = "(SELECT * FROM j1 WHERE sensor_type = 'air_quality')"
LATEST_N = "(SELECT * FROM j1 WHERE sensor_type = 'noise')"


@shared
def history(spark, d, stype):
    return EN.history_of_type(agg(spark, d), meta(spark, d), stype)


@register("A4", f"""
SELECT {_dec('total', 0)} AS total_vehicles, {_dec('avg_speed', 1)} AS avg_speed, {_dec('avg_wait', 1)} AS avg_wait_time,
  {_dec('peak', 0)} AS peak_traffic, active_sensors, {_band_sql('avg_speed', DB.CONGESTION_LEVELS)} AS congestion_level
FROM (SELECT {_zsum('vehicle_count_per_min')} AS total, {_zsum('avg_speed_kmh')} / count(*) AS avg_speed,
        {_zsum('avg_wait_time_s')} / count(*) AS avg_wait, max(coalesce(vehicle_count_per_min, 0)) AS peak,
        count(vehicle_count_per_min) AS active_sensors FROM {LATEST_T})""")
def q_a4(spark, d):
    return DB.traffic_kpis(latest_meta(spark, d))


@register("A5", f"""
SELECT {_dec('avg_pm25', 1)} AS avg_pm25, {_dec('avg_temp', 1)} AS avg_temp, {_dec('max_pm25', 1)} AS max_pm25,
  good_air_quality, active_sensors, {_band_sql('avg_pm25', DB.AIR_LEVELS)} AS overall_quality
FROM (SELECT {_zsum('pm25')} / count(*) AS avg_pm25, {_zsum('temp_c')} / count(*) AS avg_temp,
        max(coalesce(pm25, 0)) AS max_pm25,
        count(*) FILTER (WHERE {_band_sql('coalesce(pm25, 0)', DB.AIR_LEVELS)} = 'Good') AS good_air_quality,
        count(pm25) AS active_sensors FROM {LATEST_A})""")
def q_a5(spark, d):
    return DB.air_kpis(latest_meta(spark, d))


@register("A6", f"""
SELECT {_dec('avg_noise', 1)} AS avg_noise, {_dec('max_noise', 1)} AS max_noise, {_dec('min_noise', 1)} AS min_noise,
  quiet_sensors, loud_sensors, active_sensors, {_band_sql('avg_noise', DB.NOISE_LEVELS)} AS overall_level
FROM (SELECT {_zsum('noise_db')} / count(*) AS avg_noise, max(coalesce(noise_db, 0)) AS max_noise,
        min(coalesce(noise_db, 0)) AS min_noise, count(*) FILTER (WHERE coalesce(noise_db, 0) <= 40) AS quiet_sensors,
        count(*) FILTER (WHERE noise_db > 80) AS loud_sensors, count(noise_db) AS active_sensors FROM {LATEST_N})""")
def q_a6(spark, d):
    return DB.noise_kpis(latest_meta(spark, d))


@register("A7", _hist_sql(LATEST_T, _band_sql("coalesce(avg_speed_kmh, 0)", DB.SPEED_BANDS_CURRENT),
                          _labels(DB.SPEED_BANDS_CURRENT)))
def q_a7(spark, d):
    return DB.speed_histogram_current(latest_meta(spark, d))


@register("A7_history", _hist_sql(f"(SELECT * FROM {HIST_SQL['traffic_loop']} WHERE avg_speed_kmh IS NOT NULL)",
                                  _band_sql("avg_speed_kmh", DB.SPEED_BANDS_HISTORY), _labels(DB.SPEED_BANDS_HISTORY)))
def q_a7_history(spark, d):
    return DB.speed_histogram_history(history(spark, d, "traffic_loop"))


@register("A8", _hist_sql(f"(SELECT * FROM {HIST_SQL['air_quality']} WHERE temp_c IS NOT NULL)",
                          _band_sql("temp_c", DB.TEMP_BANDS), _labels(DB.TEMP_BANDS)))
def q_a8(spark, d):
    return DB.temperature_histogram(history(spark, d, "air_quality"))


@register("A9", _dist_sql(f"(SELECT * FROM {HIST_SQL['air_quality']} WHERE pm25 IS NOT NULL)",
                          _band_sql("pm25", DB.AIR_LEVELS), _labels(DB.AIR_LEVELS)))
def q_a9(spark, d):
    return DB.air_level_distribution(history(spark, d, "air_quality"))


@register("A10", _hist_sql(LATEST_N, _band_sql("coalesce(noise_db, 0)", DB.NOISE_BANDS), _labels(DB.NOISE_BANDS)))
def q_a10(spark, d):
    return DB.noise_histogram(latest_meta(spark, d))


@register("A10_categories", _dist_sql(LATEST_N, _band_sql("coalesce(noise_db, 0)", DB.NOISE_LEVELS),
                                      _labels(DB.NOISE_LEVELS)))
def q_a10_categories(spark, d):
    return DB.noise_categories(latest_meta(spark, d))


@register("A11", f"""
SELECT CASE status WHEN 'OK' THEN 0 WHEN 'WARN' THEN 1 WHEN 'ALERT' THEN 2 WHEN 'UNKNOWN' THEN 3 ELSE 4 END AS status_order,
  status, CAST(sum(c) AS BIGINT) AS count
FROM (SELECT coalesce(status, 'UNKNOWN') AS status, count(*) AS c FROM {LATEST_T} GROUP BY 1
      UNION ALL SELECT * FROM (VALUES ('OK', 0), ('WARN', 0), ('ALERT', 0), ('UNKNOWN', 0)) t(status, c))
GROUP BY status""")
def q_a11(spark, d):
    return DB.status_distribution(latest_meta(spark, d))


@register("A12", "SELECT sensor_type, count(*) AS sensor_count FROM j1 GROUP BY sensor_type")
def q_a12(spark, d):
    return DB.sensors_per_type(latest_meta(spark, d))


A13_SQL = f"""
SELECT bucket_start, {_mean('vehicle_count_per_min')} AS avg_vehicles, count(*) AS n,
  strftime(bucket_start, '%-m/%-d %H:%M') AS label
FROM (SELECT *, date_trunc('hour', window_start) AS bucket_start FROM {HIST_SQL['traffic_loop']}
      WHERE vehicle_count_per_min IS NOT NULL)
GROUP BY bucket_start"""


@register("A13", A13_SQL)
def q_a13(spark, d):
    return DB.vehicle_rollup(history(spark, d, "traffic_loop"), "1hour", "1week")


@register("A13_5min", f"""
SELECT bucket_start, {_mean('vehicle_count_per_min')} AS avg_vehicles, count(*) AS n,
  strftime(bucket_start, '%H:%M') AS label
FROM (SELECT *, date_trunc('hour', window_start) + to_minutes(CAST(minute(window_start) // 5 * 5 AS BIGINT)) AS bucket_start
      FROM {HIST_SQL['traffic_loop']} WHERE vehicle_count_per_min IS NOT NULL)
GROUP BY bucket_start""")
def q_a13_5min(spark, d):
    return DB.vehicle_rollup(history(spark, d, "traffic_loop"), "5min", "1hour")


@register("L5", f"""
SELECT CAST(row_number() OVER (ORDER BY bucket_start) AS INTEGER) AS position, label, bucket_start FROM ({A13_SQL})""")
def q_l5(spark, d):
    """Chart labels ordered by true bucket time (R8), not by text. The
    global order runs over the rolled-up buckets (one row per bucket)."""
    from pyspark.sql import Window
    r = DB.vehicle_rollup(history(spark, d, "traffic_loop"), "1hour", "1week")
    return r.select(F.row_number().over(Window.orderBy("bucket_start")).alias("position"), "label", "bucket_start")


@register("A14", f"""
SELECT 'avg_wait_time_s' AS profile, CAST(hour(window_start) AS INTEGER) AS hour, {_mean('avg_wait_time_s')} AS avg_value, count(*) AS n,
  printf('%02d:00', hour(window_start)) AS label
FROM {HIST_SQL['traffic_loop']} WHERE avg_wait_time_s IS NOT NULL GROUP BY hour(window_start)
UNION ALL
SELECT 'pm25' AS profile, CAST(hour(window_start) AS INTEGER) AS hour, {_mean('pm25')} AS avg_value, count(*) AS n,
  printf('%02d:00', hour(window_start)) AS label
FROM {HIST_SQL['air_quality']} WHERE pm25 IS NOT NULL GROUP BY hour(window_start)""")
def q_a14(spark, d):
    return DB.hour_profiles(agg(spark, d), meta(spark, d), [("traffic_loop", "avg_wait_time_s"), ("air_quality", "pm25")])


@register("A15", f"""
SELECT sensor_id, window_start, temp_c AS x, pm25 AS y, CAST(15 AS DOUBLE) AS who_line
FROM {HIST_SQL['air_quality']} WHERE pm25 IS NOT NULL AND temp_c IS NOT NULL""")
def q_a15(spark, d):
    return DB.pm25_temperature_pairs(history(spark, d, "air_quality"))


@register("A15_corr", f"""
SELECT CASE WHEN count(*) >= 2 AND NOT isnan(corr(temp_c, pm25)) THEN round(corr(temp_c, pm25), 9) END AS correlation, count(*) AS pairs
FROM {HIST_SQL['air_quality']} WHERE pm25 IS NOT NULL AND temp_c IS NOT NULL""")
def q_a15_corr(spark, d):
    return DB.pm25_temperature_correlation(history(spark, d, "air_quality"))


@register("A16", f"""
SELECT avg_noise, standard, limit_db, avg_noise - limit_db AS difference
FROM (SELECT {_zsum('noise_db')} / count(*) AS avg_noise FROM {LATEST_N}),
     (VALUES {", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in DB.NOISE_STANDARDS)}) s(standard, limit_db)""")
def q_a16(spark, d):
    return DB.noise_vs_standards(latest_meta(spark, d))


@register("A16_sensors", f"""
SELECT sensor_id, coalesce(noise_db, 0) AS noise_db, {_band_sql('coalesce(noise_db, 0)', DB.NOISE_LEVELS)} AS level,
  coalesce(noise_db, 0) > 55 AS above_who FROM {LATEST_N}""")
def q_a16_sensors(spark, d):
    return DB.noise_per_sensor(latest_meta(spark, d))


@register("A22", """
SELECT min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon, count(*) AS sensors FROM j1""")
def q_a22(spark, d):
    return DB.geographic_extent(latest_meta(spark, d))


@register("Q5", f"""
SELECT sensor_id, ranking, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY ranking ORDER BY value DESC, sensor_id) AS INTEGER) AS rank FROM (
    SELECT sensor_id, 'byTraffic' AS ranking, coalesce(vehicle_count_per_min, 0) AS value FROM {LATEST_T}
    UNION ALL SELECT sensor_id, 'bySpeed', coalesce(avg_speed_kmh, 0) FROM {LATEST_T}
    UNION ALL SELECT sensor_id, 'byWaitTime', coalesce(avg_wait_time_s, 0) FROM {LATEST_T}))
WHERE rank <= 10""")
def q_q5(spark, d):
    return DB.rankings(latest_meta(spark, d), 10)


@register("L1", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg ORDER BY window_start DESC, sensor_id LIMIT 30 OFFSET 30""")
def q_l1(spark, d):
    """L1: page 2 (30 per page) of the newest-first table of all rows."""
    return agg_text(DB.page(agg(spark, d), [F.col("window_start").desc(), F.col("sensor_id")], page_no=2, per_page=30))


@register("L2", "SELECT * FROM meta_d ORDER BY sensor_id LIMIT 30 OFFSET 30")
def q_l2(spark, d):
    return DB.page(EN.metadata_scan(meta(spark, d)), [F.col("sensor_id")], page_no=2, per_page=30)


@register("L3", "SELECT count(*) AS total, CAST(ceil(count(*) / 30) AS BIGINT) AS pages, 30 AS per_page FROM agg")
def q_l3(spark, d):
    return DB.page_count(agg(spark, d), 30)


@register("L4", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM {LATEST_T}
ORDER BY coalesce(vehicle_count_per_min, 0) DESC, sensor_id LIMIT 10""")
def q_l4(spark, d):
    """L4: the ten traffic sensors with the largest latest vehicle count."""
    return agg_text(DB.top_k(DB.of_type(latest_meta(spark, d), "traffic_loop"), "vehicle_count_per_min", 10))


@register("P17", f"""
SELECT sensor_id, {_band_sql('avg_speed_kmh', DB.SPEED_BANDS_CURRENT)} AS speed_band,
  {_band_sql('temp_c', DB.TEMP_BANDS)} AS temperature_band, {_band_sql('pm25', DB.AIR_LEVELS)} AS air_quality_level,
  {_band_sql('noise_db', DB.NOISE_LEVELS)} AS noise_level, {_band_sql('avg_speed_kmh', DB.CONGESTION_LEVELS)} AS congestion_level
FROM j1""")
def q_p17(spark, d):
    return DB.bands(latest_meta(spark, d))


@register("P18", f"""
SELECT sensor_id, coalesce(sensor_type, '-') AS sensor_type, coalesce(strftime(window_start, '%Y-%m-%dT%H:%M:%S'), '-') AS timestamp,
  {", ".join(f"coalesce({_dec(c, 2)}, '-') AS {c}" for c in DB.REPORT_MEASURES)},
  coalesce({_dec('lat', 6)}, '-') AS lat, coalesce({_dec('lon', 6)}, '-') AS lon, coalesce(status, '-') AS status,
  CASE WHEN len(breaches) > 0 THEN array_to_string(breaches, ', ') ELSE '-' END AS breaches
FROM j1""")
def q_p18(spark, d):
    return DB.report(latest_meta(spark, d))


# ======================================================= features and rules
from ..operators import features as FE  # noqa: E402

TRAFFIC_INPUTS_SQL = f"""(SELECT sensor_id, window_start, coalesce(vehicle_count_per_min, 0) AS vehicle_count,
  coalesce(avg_speed_kmh, 0) AS avg_speed, coalesce(avg_wait_time_s, 0) AS wait_time_s FROM {HIST_SQL['traffic_loop']})"""
ONE = "CAST(1 AS DOUBLE)"


def _rule_state_sql(sp: str, wt: str) -> str:
    parts = " ".join(f"WHEN {sp} > {ms} AND {wt} < {mw} THEN '{st}'" for st, ms, mw, _ in FE.RULE_STATES)
    return f"CASE {parts} ELSE '{FE.RULE_ELSE[0]}' END"


def _lookup_sql(x: str, pairs, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in pairs) + f" ELSE '{default}' END"


def traffic_minutes(spark, d):
    return FE.traffic_inputs(history(spark, d, "traffic_loop"))


@register("P10", f"""
SELECT *, avg_speed / greatest(vehicle_count, {ONE}) AS speed_variance,
  wait_time_s * vehicle_count / greatest(avg_speed, {ONE}) AS congestion_index,
  avg_speed / greatest(wait_time_s, {ONE}) AS flow_efficiency, CAST(hour(window_start) AS INTEGER) AS hour,
  CAST((hour(window_start) BETWEEN 7 AND 9) OR (hour(window_start) BETWEEN 17 AND 19) AS INTEGER) AS is_rush_hour,
  CAST(isodow(window_start) - 1 >= 5 AS INTEGER) AS is_weekend
FROM {TRAFFIC_INPUTS_SQL}""")
def q_p10(spark, d):
    return FE.with_features(traffic_minutes(spark, d))


@register("P11", f"SELECT * FROM {TRAFFIC_INPUTS_SQL}")
def q_p11(spark, d):
    return traffic_minutes(spark, d)


P12_SQL = f"""SELECT sensor_id, window_start, st AS traffic_state,
  CAST(CASE st {" ".join(f"WHEN '{a}' THEN {c}" for a, _, _, c in FE.RULE_STATES)} ELSE {FE.RULE_ELSE[1]} END AS DOUBLE) AS confidence,
  {_lookup_sql('st', FE.STATE_SEVERITY, FE.DEFAULT_SEVERITY)} AS severity,
  {_lookup_sql('st', FE.STATE_DURATION, FE.DEFAULT_DURATION)} AS predicted_duration
FROM (SELECT *, {_rule_state_sql('avg_speed', 'wait_time_s')} AS st FROM {TRAFFIC_INPUTS_SQL})"""


@register("P12", P12_SQL)
def q_p12(spark, d):
    t = traffic_minutes(spark, d)
    return t.select("sensor_id", "window_start",
                    FE.rule_classification(F.col("avg_speed"), F.col("wait_time_s")).alias("c")).select(
        "sensor_id", "window_start", "c.*")


def _fallback_sql(i: int, as_text: bool) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    return (f"CASE WHEN vehicle_count > 35 OR wait_time_s > 60 THEN {lit(FE.FALLBACK_HEAVY[i])} "
            f"WHEN vehicle_count > 20 OR wait_time_s > 30 THEN {lit(FE.FALLBACK_LIGHT[i])} ELSE {lit(FE.FALLBACK_FREE[i])} END")


SCORING_NAMES = ["ai_traffic_state", "ai_confidence", "ai_severity", "ai_predicted_duration",
                 "ai_anomaly_detected", "ai_anomaly_score"]
P13_COLS = ", ".join(f"{_fallback_sql(i, False)} AS {n}" for i, n in enumerate(SCORING_NAMES)) \
    + f", '{FE.FALLBACK_VERSION}' AS ai_model_version"


@register("P13", f"SELECT sensor_id, window_start, {P13_COLS} FROM {TRAFFIC_INPUTS_SQL}")
def q_p13(spark, d):
    t = traffic_minutes(spark, d)
    return t.select("sensor_id", "window_start",
                    FE.fallback_scoring(F.col("vehicle_count"), F.col("wait_time_s")).alias("s")).select(
        "sensor_id", "window_start", "s.*")


@register("P14", f"""
SELECT sensor_id, window_start, vehicle_count AS vehicle_count_per_min, avg_speed AS avg_speed_kmh,
  wait_time_s AS avg_wait_time_s, pm25, noise_db, temp_c, 'OK' AS status, {P13_COLS},
  wait_time_s * vehicle_count / greatest(avg_speed, {ONE}) AS ai_congestion_index
FROM {TRAFFIC_INPUTS_SQL} JOIN (SELECT sensor_id, window_start, pm25, noise_db, temp_c FROM agg) USING (sensor_id, window_start)""")
def q_p14(spark, d):
    s = FE.scored_minutes(history(spark, d, "traffic_loop"))
    return s.withColumn("ai_congestion_index", F.col("ai_features")["congestion_index"]).drop("ai_features")


def _reasons_sql() -> str:
    terms = ", ".join(f"CASE WHEN {m} < {lo} OR {m} > {hi} THEN '{pre}' || CAST({m} AS VARCHAR) END"
                      for m, lo, hi, pre in FE.NORMAL_RANGES)
    return f"list_filter([{terms}], lambda x: x IS NOT NULL)"


@register("P15", f"""
SELECT sensor_id, window_start, len(r) > 0 AS is_anomaly,
  CAST(CASE WHEN len(r) > 0 THEN 0.5 ELSE 0.3 END AS DOUBLE) AS confidence, CAST(CASE WHEN len(r) > 0 THEN -0.5 ELSE 0.3 END AS DOUBLE) AS anomaly_score,
  array_to_string(r, ',') AS reasons
FROM (SELECT *, {_reasons_sql()} AS r FROM {TRAFFIC_INPUTS_SQL})""")
def q_p15(spark, d):
    t = traffic_minutes(spark, d)
    a = FE.rule_anomaly(F.col("vehicle_count"), F.col("avg_speed"), F.col("wait_time_s"))
    return t.select("sensor_id", "window_start", a.is_anomaly.alias("is_anomaly"),
                    a.confidence.cast("double").alias("confidence"),
                    a.anomaly_score.cast("double").alias("anomaly_score"),
                    F.array_join(a.reasons, ",").alias("reasons"))


@register("P16", f"""
SELECT traffic_state, {_lookup_sql('traffic_state', FE.STATE_SEVERITY, FE.DEFAULT_SEVERITY)} AS severity,
  {_lookup_sql('traffic_state', FE.STATE_DURATION, FE.DEFAULT_DURATION)} AS predicted_duration, count(*) AS minutes
FROM ({P12_SQL}) GROUP BY traffic_state""")
def q_p16(spark, d):
    """P16 over the rule states of every traffic minute: severity and duration
    per state, with the number of minutes in that state."""
    t = traffic_minutes(spark, d).select(FE.rule_state(F.col("avg_speed"), F.col("wait_time_s")).alias("traffic_state"))
    return (t.groupBy("traffic_state").agg(F.count("*").alias("minutes"))
            .select("traffic_state", FE.severity_of(F.col("traffic_state")).alias("severity"),
                    FE.duration_of(F.col("traffic_state")).alias("predicted_duration"), "minutes"))


M7_ITEMS_SQL = f"""(SELECT sensor_id, window_start, CAST(vehicle_count_per_min AS VARCHAR) AS vehicle_count,
  CAST(avg_speed_kmh AS VARCHAR) AS avg_speed, CAST(avg_wait_time_s AS VARCHAR) AS wait_time_s FROM {HIST_SQL['traffic_loop']})"""


@register("M7", f"""
SELECT sensor_id, window_start, err AS error,
  CASE WHEN err IS NULL THEN traffic_state END AS traffic_state, CASE WHEN err IS NULL THEN confidence END AS confidence,
  CASE WHEN err IS NULL THEN severity END AS severity, CASE WHEN err IS NULL THEN predicted_duration END AS predicted_duration,
  CASE WHEN err IS NULL THEN len(r) > 0 END AS anomaly_detected,
  CAST(CASE WHEN err IS NULL THEN CASE WHEN len(r) > 0 THEN -0.5 ELSE 0.3 END END AS DOUBLE) AS anomaly_score
FROM (
  SELECT i.sensor_id, i.window_start,
    CASE WHEN len(miss) > 0 THEN 'Missing fields: [' || array_to_string(list_transform(miss, lambda x: chr(39) || x || chr(39)), ', ') || ']' END AS err,
    st AS traffic_state,
    CAST(CASE st {" ".join(f"WHEN '{a}' THEN {c}" for a, _, _, c in FE.RULE_STATES)} ELSE {FE.RULE_ELSE[1]} END AS DOUBLE) AS confidence,
    {_lookup_sql('st', FE.STATE_SEVERITY, FE.DEFAULT_SEVERITY)} AS severity,
    {_lookup_sql('st', FE.STATE_DURATION, FE.DEFAULT_DURATION)} AS predicted_duration,
    {_reasons_sql()} AS r
  FROM (SELECT sensor_id, window_start,
          list_filter([CASE WHEN vehicle_count IS NULL THEN 'vehicle_count' END, CASE WHEN avg_speed IS NULL THEN 'avg_speed' END,
                       CASE WHEN wait_time_s IS NULL THEN 'wait_time_s' END], lambda x: x IS NOT NULL) AS miss,
          TRY_CAST(vehicle_count AS DOUBLE) AS vehicle_count, TRY_CAST(avg_speed AS DOUBLE) AS avg_speed,
          TRY_CAST(wait_time_s AS DOUBLE) AS wait_time_s FROM {M7_ITEMS_SQL}) i,
  LATERAL (SELECT {_rule_state_sql('i.avg_speed', 'i.wait_time_s')} AS st))""")
def q_m7(spark, d):
    """M7: every traffic minute submitted as a text item (null measure =
    missing field); good items scored by the rules, the rest get an error."""
    h = history(spark, d, "traffic_loop")
    items = h.select("sensor_id", "window_start",
                     F.col("vehicle_count_per_min").cast("string").alias("vehicle_count"),
                     F.col("avg_speed_kmh").cast("string").alias("avg_speed"),
                     F.col("avg_wait_time_s").cast("string").alias("wait_time_s"))
    return FE.batch_score(items)


# ============================================================== streaming
from ..session import scratch_path  # noqa: E402
from ..streaming import alerting as SA  # noqa: E402
from ..streaming import buffers as SB  # noqa: E402
from ..streaming import chained as SC  # noqa: E402
from ..operators import pages as PG  # noqa: E402
from ..sources import clustered as CL  # noqa: E402
from ..streaming import ingest as SI  # noqa: E402
from ..streaming import minutes as SM  # noqa: E402
from ..streaming import partials as SP  # noqa: E402
from ..streaming import rollups as SR  # noqa: E402
from ..streaming import sinks as SK  # noqa: E402


def readings_stream(spark, d):
    return FX.readings_from_events(FX.events_stream(spark, d))


SLICES, FILES = 4, 4


def sliced_stream(spark, d, order=tuple(range(SLICES))):
    """The events as a stream of micro-batches: ``SLICES`` time slices written
    one after the other, in ``order``, as ``FILES`` files each."""
    path = scratch_path(spark, "events-sliced")
    ev = FX.events(spark, d)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    for i in order if lo is not None else ():
        start, end = (F.lit(lo + (hi - lo) * k / SLICES) for k in (i, i + 1))
        inside = (F.col("ts") >= start) & ((F.col("ts") < end) if i < SLICES - 1 else F.lit(True))
        ev.filter(inside).repartition(FILES).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", FILES).parquet(path)
    return FX.readings_from_events(stream)


EVENTS_PER_BATCH, FILES_PER_BATCH = 1_000_000, 12


def time_ordered_stream(spark, d, least=1):
    """The events in time order, in micro-batches of about ``EVENTS_PER_BATCH`` rows however
    many there are, and in ``least`` ones: the watermark follows the rows, so a stream keeps
    the state of two batches, not of the whole table. Each row is written twice, in one pass
    each: to its slice, then the slices one after the other (a stream reads files in that order)."""
    ev = FX.events(spark, d)
    rows = ev.count()
    batches = max(least, -(-rows // EVENTS_PER_BATCH))
    if batches < 2 or not rows:
        return readings_stream(spark, d)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = ev.agg(F.percentile_approx(at, [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    number = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b <= at))
    path, staged = scratch_path(spark, "events-ordered"), scratch_path(spark, "events-staged")
    ev.withColumn("batch", F.when(at.isNull(), 0).otherwise(number)).write.partitionBy("batch").parquet(staged)
    slices = spark.read.parquet(staged)
    # Every micro-batch must be one slice: each is written as the same number of files, none of them empty.
    files = FILES_PER_BATCH if rows >= 1000 * FILES_PER_BATCH * batches else 1
    groups, size = [[]], 0
    for i, n in sorted(slices.groupBy("batch").count().collect()):
        if size >= 100 * (files - 1) and groups[-1]:
            groups, size = [*groups, []], 0
        groups[-1].append(i)
        size += n
    if size < 100 * (files - 1) and len(groups) > 1:
        groups[-2:] = [groups[-2] + groups[-1]]
    for own in groups:
        slices.where(F.col("batch").isin(own)).drop("batch").repartition(files).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files)
    return FX.readings_from_events(stream.parquet(path))


def _run_minutes(spark, d, mode, source=readings_stream):
    base = scratch_path(spark, f"minutes-{mode}")
    q = SM.start_minute_table(source(spark, d), schema.valid_ranges(spark), base + "/table",
                              base + "/checkpoint", mode=mode)
    q.awaitTermination()
    return base


@register("T1", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg
WHERE window_start + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM valid)""")
def q_t1(spark, d):
    """Streaming tumbling minutes, append mode, 1-minute grace; every window
    the watermark has closed, read back through the upsert view (S4)."""
    base = _run_minutes(spark, d, "append")
    return agg_text(SK.read_upserted(spark, base + "/table"))


@register("T2", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg")
def q_t2(spark, d):
    """Update mode (changed windows re-emitted as new versions), newest
    version per (sensor, minute): all windows, including still-open ones."""
    base = _run_minutes(spark, d, "update")
    return agg_text(SK.read_upserted(spark, base + "/table"))


def _maintained(spark, d, sink=None):
    """The minute table kept up to date by four micro-batches, with a fold after
    every second one; ``sink`` sees the table, the batch's rows and its number."""
    base = scratch_path(spark, "minute-days")
    table = SM.minute_day_table(spark, base + "/minutes")

    def on_batch(df, batch_id):
        if sink:
            sink(base, table, df, batch_id)
        if batch_id == 1:
            table.fold()

    SM.start_minute_days(sliced_stream(spark, d), schema.valid_ranges(spark), table, base + "/checkpoint",
                         on_batch=on_batch).awaitTermination()
    return base, table


@register("S4", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL}, CAST(window_start AS DATE) AS day FROM agg")
def q_s4(spark, d):
    """Upserts of four micro-batches; the days of the first two are folded,
    the rest is merged on read."""
    return agg_text(_maintained(spark, d)[1].read())


@register("T2_late", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg")
def q_t2_late(spark, d):
    """T2 with a whole slice behind the watermark: its partial sums go to the
    side table and are merged into the emitted minutes by reconciliation."""
    base = scratch_path(spark, "late-minutes")
    late = SP.LateMinutes(spark, base)
    late.start(sliced_stream(spark, d, (0, 2, 3, 1)), schema.valid_ranges(spark), base + "/checkpoint").awaitTermination()
    late.reconcile()
    return agg_text(late.minutes())


def _hours(spark, d):
    """The hour table maintained with the minute table: each micro-batch
    recomputes the hours it touches."""
    hours = []

    def sink(base, table, df, batch_id):
        if not hours:
            hours.append(SR.hour_table(spark, base + "/hours"))
        SR.refresh_hours(table, hours[0], df, batch_id)
        if batch_id == 2:
            hours[0].fold()

    base, _ = _maintained(spark, d, sink)
    return (hours[0] if hours else SR.hour_table(spark, base + "/hours")).read()


@register("A13_view", A13_SQL)
def q_a13_view(spark, d):
    """A13 from the maintained hour table."""
    return SR.vehicle_rollup(_hours(spark, d), meta(spark, d), "traffic_loop", "1hour", "1week")


@register("A13_view_day", f"""
SELECT bucket_start, {_mean('vehicle_count_per_min')} AS avg_vehicles, count(*) AS n, strftime(bucket_start, '%-m/%-d') AS label
FROM (SELECT *, date_trunc('day', window_start)::TIMESTAMP AS bucket_start FROM {HIST_SQL['traffic_loop']}
      WHERE vehicle_count_per_min IS NOT NULL)
GROUP BY bucket_start""")
def q_a13_view_day(spark, d):
    """A13 by day from the maintained hour table."""
    return SR.vehicle_rollup(_hours(spark, d), meta(spark, d), "traffic_loop", "1day", "month")


@register("A14_view")
def q_a14_view(spark, d):
    """A14 from the maintained hour table."""
    return SR.hour_profiles(_hours(spark, d), meta(spark, d), [("traffic_loop", "avg_wait_time_s"), ("air_quality", "pm25")])


def _run_buffers(spark, d, source=readings_stream, retention="24 hours"):
    base = scratch_path(spark, "buffers")
    r = source(spark, d)
    complete, _ = QU.split_complete(r)
    valid_s = QU.validate(complete, schema.valid_ranges(spark)).filter("is_valid")

    def sink(df, batch_id):
        SK.write_batch(df, base + "/table", batch_id)

    SB.start_buffers(valid_s, sink, base + "/checkpoint", retention=retention).awaitTermination()
    return SK.read_versions(spark, base + "/table")


@register("T4", f"""
SELECT sensor_id, metric, avg_value, min_value, max_value, count,
  CAST(sum(count) OVER (PARTITION BY sensor_id) AS BIGINT) AS window_size,
  min(_first) OVER (PARTITION BY sensor_id) AS range_start, max(_last) OVER (PARTITION BY sensor_id) AS range_end
FROM (SELECT sensor_id, metric, {_mean('value')} AS avg_value, min(value) AS min_value, max(value) AS max_value,
        count(*) AS count, min(ts) AS _first, max(ts) AS _last
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn FROM valid)
      WHERE rn <= 20 GROUP BY sensor_id, metric)""")
def q_t4(spark, d):
    """T4: per-sensor 20-reading state; the statistics of each sensor's newest batch."""
    return _newest_stats(_run_buffers(spark, d))


def _newest_stats(rows):
    v = rows.filter("kind = 'stats'")
    newest = SK.newest_rows(v)
    return newest.select("sensor_id", "metric", "avg_value", "min_value", "max_value", "count", "window_size",
                         F.col("range_start").cast("timestamp_ntz").alias("range_start"),
                         F.col("range_end").cast("timestamp_ntz").alias("range_end"))


@register("T6", SPIKES_SQL)
def q_t6(spark, d):
    """Spike rule checked on every reading inside the T4 state."""
    return _spike_rows(_run_buffers(spark, d))


def _spike_rows(rows):
    v = rows.filter("kind = 'spike'")
    return v.select("event_id", "sensor_id", "metric", F.col("ts").cast("timestamp_ntz").alias("ts"), "value",
                    F.col("avg_value").alias("recent_avg"))


@register("T1_multi")
def q_t1_multi(spark, d):
    """T1 over several micro-batches: state and watermark carried between them."""
    base = _run_minutes(spark, d, "append", sliced_stream)
    return agg_text(SK.read_upserted(spark, base + "/table"))


LONG_RETENTION = "2000 hours"  # longer than the table, so that no idle sensor's state is dropped


@register("T4_multi")
def q_t4_multi(spark, d):
    """T4 over several micro-batches: each sensor's newest batch, all its metrics."""
    return _newest_stats(_run_buffers(spark, d, sliced_stream, LONG_RETENTION))


@register("T6_multi")
def q_t6_multi(spark, d):
    """T6 over several micro-batches: the last values carried in the state."""
    return _spike_rows(_run_buffers(spark, d, sliced_stream, LONG_RETENTION))


for _name in ("T1", "T4", "T6"):
    ORACLE[f"{_name}_multi"] = ORACLE[_name]


def _run_alerts(spark, d):
    """(folder, alert table) after the alert stream."""
    base = scratch_path(spark, "alerts")
    table = SA.alert_table(spark, base + "/alerts")
    q = SA.start_alerts(readings_stream(spark, d), schema.alert_limits(spark), table,
                        base + "/messages", base + "/checkpoint")
    q.awaitTermination()
    return base, table


@register("T7_stream", f"SELECT {ALERT_COLS} FROM alerts")
def q_t7_stream(spark, d):
    """Streaming alerts written by the S5 sink, read back from the table."""
    a = _run_alerts(spark, d)[1].read().drop("day")
    return a.select(*[c for c in a.columns if c != "location"], F.col("location")["road"].alias("road"))


def _resolved_table(spark, d):
    """The stored alert table with old alerts resolved: the ids are written as
    marks, half of them folded in, the others merged on read."""
    table = _run_alerts(spark, d)[1]
    stored = table.read()
    newest = stored.agg(F.max("timestamp")).scalar()
    ids = stored.filter(F.col("timestamp") < F.timestamp_add("DAY", F.lit(-7), newest)).select("alert_id")
    half = F.pmod(F.xxhash64("alert_id"), F.lit(2))
    table.mark_keys(ids.filter(half == 0), 0, "resolve")
    table.fold()
    table.mark_keys(ids.filter(half == 1), 1, "resolve")
    return table.read()


@register("S8_stored", f"SELECT alert_id, resolved FROM {RESOLVED_SQL}")
def q_s8_stored(spark, d):
    """S8 on the stored alert table: only the resolved ids are written."""
    return _resolved_table(spark, d).select("alert_id", "resolved")


@register("S7_stored")
def q_s7_stored(spark, d):
    """S7 from the stored alert table."""
    return AL.unresolved(_resolved_table(spark, d)).select(
        "alert_id", "sensor_id", "sensor_type", "metric", "value", "severity", "timestamp")


@register("A17_stored")
def q_a17_stored(spark, d):
    """A17 from the stored alert table."""
    return AL.alert_counts(_resolved_table(spark, d))


@register("S5", "SELECT alert_id, sensor_id, severity, message FROM alerts")
def q_s5(spark, d):
    """The alert topic side of the sink (JSON messages), parsed back."""
    base, _ = _run_alerts(spark, d)
    msgs = spark.read.json(base + "/messages")
    m = F.from_json("value", "alert_id string, sensor_id string, severity string, message string")
    return msgs.select(m.alias("m")).select("m.*")


@register("T9_stream", f"SELECT alert_id, sensor_id, timestamp, notification FROM {NOTIFY_SQL} WHERE severity = 'critical'")
def q_t9_stream(spark, d):
    """T9 stream form: every critical alert exactly once, with its text."""
    base = scratch_path(spark, "feed")
    feed = SA.critical_feed_stream(SA.alert_stream(readings_stream(spark, d), schema.alert_limits(spark)))
    q = (feed.writeStream.outputMode("append").format("parquet").option("path", base + "/feed")
         .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/feed")


@register("T9_redelivered", f"""
SELECT alert_id, sensor_id, timestamp, notification FROM {NOTIFY_SQL} WHERE severity = 'critical' AND timestamp IS NOT NULL""")
def q_t9_redelivered(spark, d):
    """T9 over a stream that delivers two of its four slices again: every
    critical alert with a time once."""
    base = scratch_path(spark, "feed")
    alerted = SA.alert_stream(sliced_stream(spark, d, (0, 1, 0, 2, 3, 2)), schema.alert_limits(spark))
    feed = SA.critical_feed_stream(alerted.filter("timestamp IS NOT NULL"), LONG_RETENTION)
    q = (feed.writeStream.outputMode("append").format("parquet").option("path", base + "/feed")
         .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/feed")


_SENT_BAD = "event_id % 50 = 3 OR event_id % 50 = 7"


@register("S1_outcomes", f"""
SELECT outcome, reason, count(*) AS messages FROM (
  SELECT CASE WHEN sent_bad OR missing <> '' OR NOT finite THEN 'dead' WHEN in_range THEN 'good' ELSE 'invalid' END AS outcome,
         CASE WHEN sent_bad THEN 'not a message' WHEN missing <> '' THEN 'missing or unreadable: ' || missing
              WHEN NOT finite THEN 'value is no usable number' WHEN NOT in_range THEN 'Out of range' END AS reason
  FROM (SELECT {_SENT_BAD} AS sent_bad, {_FINITE} AS finite,
               g.metric IS NULL OR coalesce(r.value >= g.min_value AND r.value <= g.max_value, false) AS in_range,
               array_to_string(list_filter([CASE WHEN sensor_id IS NULL THEN 'sensor_id' END, CASE WHEN ts IS NULL THEN 'ts' END,
                 CASE WHEN r.metric IS NULL THEN 'metric' END, CASE WHEN value IS NULL THEN 'value' END], lambda x: x IS NOT NULL), ', ') AS missing
        FROM readings r LEFT JOIN ranges g ON r.metric = g.metric))
GROUP BY outcome, reason""")
def q_s1_outcomes(spark, d):
    """A message stream, some of it broken text, into the good, invalid
    and dead-letter tables; what each holds and why."""
    base = scratch_path(spark, "ingest")
    m = FX.raw_messages(spark, d).select("event_id", "value")
    kind = F.col("event_id") % 50
    m = m.withColumn("value", F.when(kind == 3, F.expr("left(value, length(value) - 5)")).when(kind == 7, "no json at all")
                     .otherwise(F.col("value")))
    m.write.parquet(base + "/messages")
    SI.start_ingest(spark.readStream.schema(m.schema).parquet(base + "/messages"), schema.valid_ranges(spark), base + "/tables",
                    base + "/checkpoint").awaitTermination()
    out = None
    for outcome in SI.OUTCOMES:
        part = SI.read_outcome(spark, base + "/tables", outcome).select(F.lit(outcome).alias("outcome"), "reason")
        out = part if out is None else out.unionByName(part)
    short = F.when(F.col("reason").startswith("Out of range"), "Out of range").otherwise(F.col("reason"))
    return out.groupBy("outcome", short.alias("reason")).agg(F.count("*").alias("messages"))


NEWEST_FIRST = ["-unix_micros(CAST(window_start AS TIMESTAMP))", "sensor_id"]


def _paged(spark, d, frame, key, rows_per_part=2000):
    return PG.PagedTable.write(frame(spark, d), scratch_path(spark, "pages"), key, rows_per_part)


@register("L1_deep", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg ORDER BY window_start DESC, sensor_id LIMIT 30 OFFSET 5970""")
def q_l1_deep(spark, d):
    """L1: page 200 of the stored table, from the parts that hold it."""
    return agg_text(_paged(spark, d, agg, NEWEST_FIRST).page(200))


@register("L1_after", f"""
SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg ORDER BY window_start DESC, sensor_id LIMIT 30 OFFSET 3000""")
def q_l1_after(spark, d):
    """L1 by key: the page after the last row of page 100."""
    pages = _paged(spark, d, agg, NEWEST_FIRST)
    last = pages.page(100).selectExpr(*NEWEST_FIRST).collect()[-1:]     # one page, in order
    return agg_text(pages.after(tuple(last[0])) if last else pages.page(101))


@register("L2_deep", "SELECT * FROM meta_d ORDER BY sensor_id LIMIT 30 OFFSET 90")
def q_l2_deep(spark, d):
    """L2: page 4 of the stored metadata."""
    return _paged(spark, d, lambda spark, d: EN.metadata_scan(meta(spark, d)), ["sensor_id"], 50).page(4)


@register("L3_pages")
def q_l3_pages(spark, d):
    """L3 from the fences of the stored table."""
    return _paged(spark, d, agg, NEWEST_FIRST).total(30)


ORACLE["L3_pages"] = ORACLE["L3"]


def _clustered(spark, d):
    """The minute table and the metadata, bucketed by sensor."""
    names = []
    for kind, df, time in (("minutes", agg(spark, d), "window_start"), ("meta", meta(spark, d), None)):
        names.append(f"sp_{kind}_{uuid.uuid4().hex[:12]}")
        CL.write_clustered(df, names[-1], scratch_path(spark, f"clustered-{kind}"), time)
    return [CL.clustered(spark, n) for n in names]


@register("J4_stored")
def q_j4_stored(spark, d):
    """J4 over the clustered tables: a co-located semi join."""
    minutes, sensors = _clustered(spark, d)
    return agg_text(EN.history_of_type(minutes, sensors, "traffic_loop"))


@register("P4_stored", f"SELECT * EXCLUDE (breaches), {AGG_TEXT_SQL} FROM agg WHERE sensor_id = 'Loop-0001'")
def q_p4_stored(spark, d):
    """One sensor looked up in the clustered table (one bucket is read)."""
    return agg_text(_clustered(spark, d)[0].filter(F.col("sensor_id") == "Loop-0001"))


ORACLE["J4_stored"] = ORACLE["J4"]


@register("T3_stream", f"""
SELECT * FROM (
  SELECT sensor_id, metric, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
    {_mean('value')} AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*) AS count
  FROM (SELECT v.*, date_trunc('minute', ts) - to_minutes(k) AS window_start FROM valid v, range(0, 10) r(k))
  GROUP BY sensor_id, metric, window_start)
WHERE window_end + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM valid)""")
def q_t3_stream(spark, d):
    """T3 stream form: sliding windows emitted once the watermark closes them."""
    base = scratch_path(spark, "sliding")
    SC.start_sliding(time_ordered_stream(spark, d), schema.valid_ranges(spark), base + "/out",
                     base + "/checkpoint").awaitTermination()
    return SK.read_versions(spark, base + "/out").drop(*SK.VERSION)


def _run_chained(spark, d):
    """T1 and T3 as one stream of two chained operators over four micro-batches, or more of a large table."""
    base = scratch_path(spark, "chained")
    SC.start_minutes_and_sliding(time_ordered_stream(spark, d, SLICES), schema.valid_ranges(spark), base + "/minutes",
                                 base + "/sliding", base + "/checkpoint").awaitTermination()
    return base


@register("T1_chained")
def q_t1_chained(spark, d):
    """T1 from the chained stream: a projection of the second operator's rows."""
    return agg_text(SK.read_upserted(spark, _run_chained(spark, d) + "/minutes", time="window_start"))


@register("T3_chained")
def q_t3_chained(spark, d):
    """T3 from the chained stream: minute partials expanded, not readings."""
    return SK.read_upserted(spark, _run_chained(spark, d) + "/sliding", SC.SLIDING_KEYS, "window_start")


ORACLE["T1_chained"], ORACLE["T3_chained"] = ORACLE["T1"], ORACLE["T3_stream"]


# ===================================================================== models
from ..ml import hybrid as MH  # noqa: E402
from ..ml import isolation as MI  # noqa: E402
from ..ml import lifecycle as ML  # noqa: E402
from ..ml import patterns as MP  # noqa: E402
from ..ml import registry as MR  # noqa: E402
from ..ml import forest as MF  # noqa: E402
from ..streaming import scoring as SS  # noqa: E402

_BUNDLES: dict = {}


def trained_bundle(spark, d) -> MH.ModelBundle:
    """Models trained from the stored traffic history (M10: a scheduled fit,
    never inside scoring), kept per session and data folder."""
    key = (session_key(spark), d)
    if key not in _BUNDLES:
        _BUNDLES[key] = ML.train_all(history(spark, d, "traffic_loop"))
    return _BUNDLES[key]


def traffic_features(spark, d):
    return ML.traffic_features(history(spark, d, "traffic_loop"))


@register("M1")
def q_m1(spark, d):
    """M1: the fitted cluster centres (standardised space) with their names."""
    pm = trained_bundle(spark, d).patterns
    rows = [(i, pm.labels.get(i), [float(v) for v in c], pm.training_cost, pm.samples)
            for i, c in enumerate(pm.centers)]
    return spark.createDataFrame(rows, "cluster int, pattern string, center array<double>, training_cost double, "
                                       "samples long")


@register("A21")
def q_a21(spark, d):
    """Cluster profile over the training rows, ranked by mean speed."""
    pm = trained_bundle(spark, d).patterns
    return MP.cluster_profile(pm.pipeline.transform(traffic_features(spark, d)))


@register("M2")
def q_m2(spark, d):
    out = MP.predict_patterns(trained_bundle(spark, d).patterns, traffic_features(spark, d))
    return out.select("sensor_id", "window_start", "cluster", "pattern", "pattern_confidence")


@register("M3")
def q_m3(spark, d):
    return MP.training_set(MP.predict_patterns(trained_bundle(spark, d).patterns, traffic_features(spark, d)))


@register("M4")
def q_m4(spark, d):
    """M4: classifier state, confidence, severity and duration per traffic minute."""
    out = MF.predict_states(trained_bundle(spark, d).states, traffic_features(spark, d))
    return out.select("sensor_id", "window_start", "traffic_state", "confidence", "severity", "predicted_duration")


@register("M4_importances")
def q_m4_importances(spark, d):
    imp = trained_bundle(spark, d).states.importances
    return spark.createDataFrame(sorted(imp.items()), "feature string, importance double")


@register("M5")
def q_m5(spark, d):
    """M5: isolation forest fitted on the traffic minutes and scoring them."""
    feats = traffic_features(spark, d)
    model = MI.fit_isolation(feats, ["sensor_id", "window_start"])
    return MI.score_isolation(model, feats).select("sensor_id", "window_start", "vehicle_count", "avg_speed",
                                                   "wait_time_s", "is_anomaly", "anomaly_score", "anomaly_confidence")


def _inputs(spark, d):
    return FE.traffic_inputs(history(spark, d, "traffic_loop"))


@register("M6")
def q_m6(spark, d):
    """M6: hybrid scoring (classifier + isolation forest) of every traffic minute."""
    return MH.hybrid_score(_inputs(spark, d), trained_bundle(spark, d))


@register("M8")
def q_m8(spark, d):
    """M8: latest row of every traffic sensor scored with the models."""
    return MH.score_latest(latest_meta(spark, d), trained_bundle(spark, d))


@register("M8_unavailable", f"""
SELECT sensor_id, window_start, coalesce(vehicle_count_per_min, 0) AS vehicle_count, coalesce(avg_speed_kmh, 0) AS avg_speed,
  coalesce(avg_wait_time_s, 0) AS wait_time_s, 'Unknown' AS ai_traffic_state, CAST(0 AS DOUBLE) AS ai_confidence,
  'Low' AS ai_severity, 'Unknown' AS ai_predicted_duration, false AS ai_anomaly_detected,
  CAST(0 AS DOUBLE) AS ai_anomaly_score, 'fallback-v1.0' AS ai_model_version, false AS ml_available
FROM {LATEST_T}""")
def q_m8_unavailable(spark, d):
    """M8 without models: every sensor Unknown, not available."""
    return MH.score_latest(latest_meta(spark, d), None)


@register("M6_rules", f"""
SELECT sensor_id, window_start, vehicle_count, avg_speed, wait_time_s, st AS ai_traffic_state,
  CAST(CASE st WHEN 'Free Flow' THEN 0.7 WHEN 'Light Traffic' THEN 0.6 WHEN 'Heavy Congestion' THEN 0.5 ELSE 0.4 END AS DOUBLE) AS ai_confidence,
  {_lookup_sql('st', FE.STATE_SEVERITY, FE.DEFAULT_SEVERITY)} AS ai_severity,
  {_lookup_sql('st', FE.STATE_DURATION, FE.DEFAULT_DURATION)} AS ai_predicted_duration,
  len(r) > 0 AS ai_anomaly_detected, CAST(CASE WHEN len(r) > 0 THEN -0.5 ELSE 0.3 END AS DOUBLE) AS ai_anomaly_score,
  'rules-v1' AS ai_model_version, false AS ml_available
FROM (SELECT *, {_rule_state_sql('avg_speed', 'wait_time_s')} AS st, {_reasons_sql()} AS r FROM {TRAFFIC_INPUTS_SQL})""")
def q_m6_rules(spark, d):
    """M6 on the rule path: every traffic minute scored without fitted models."""
    return MH.hybrid_score(_inputs(spark, d), None, fallback="rules")


@register("A18", f"""
SELECT count(*) AS total_sensors, CAST(0 AS BIGINT) AS ml_available_count, CAST(0 AS DOUBLE) AS ml_availability_rate,
  CAST(0 AS BIGINT) AS anomaly_count, CAST(0 AS DOUBLE) AS anomaly_rate, CAST(0 AS DOUBLE) AS avg_confidence
FROM {LATEST_T}""")
def q_a18(spark, d):
    """A18 with no model loaded: every sensor Unknown and not available."""
    return MH.prediction_summary(MH.score_latest(latest_meta(spark, d), None))


@register("A18_states", f"SELECT 'Unknown' AS traffic_state, count(*) AS sensors FROM {LATEST_T} HAVING count(*) > 0")
def q_a18_states(spark, d):
    return MH.state_distribution(MH.score_latest(latest_meta(spark, d), None))


@register("A18_models")
def q_a18_models(spark, d):
    """A18 over model scores, with the state distribution as a map."""
    scored = MH.score_latest(latest_meta(spark, d), trained_bundle(spark, d))
    states = MH.state_distribution_map(scored).scalar()
    return MH.prediction_summary(scored).withColumn("state_distribution", states)


@register("M9")
def q_m9(spark, d):
    return ML.model_quality(history(spark, d, "traffic_loop"), trained_bundle(spark, d))


@register("M10", f"""
SELECT model, CAST(n AS BIGINT) AS samples, trained_at,
  n >= greatest(first_at, minimum) AND (trained_at IS NULL OR n - trained_at >= every) AS due,
  CASE WHEN n < greatest(first_at, minimum) THEN 'needs ' || greatest(first_at, minimum) || ' samples'
       WHEN trained_at IS NULL THEN 'first fit'
       WHEN n - trained_at >= every THEN (n - trained_at) || ' new samples' ELSE 'up to date' END AS reason
FROM (SELECT *, CASE which WHEN 1 THEN n - every WHEN 2 THEN n - every + 1 END AS trained_at
      FROM (SELECT count(*) AS n FROM {HIST_SQL['traffic_loop']}),
           (VALUES ('patterns', 100, 50, 20), ('anomalies', 100, 50, 50), ('states', 50, 25, 20)) r(model, first_at, every, minimum),
           range(0, 3) w(which))""")
def q_m10(spark, d):
    """Retrain decisions of each model for the stored history: never
    trained, trained as many samples ago as asked for, and one sample fewer."""
    n = history(spark, d, "traffic_loop").agg(F.count("*").alias("samples"))
    rules = ", ".join(f"'{m}', {every}L" for m, (_, every, _) in ML.RETRAIN_RULES.items())
    cases = n.selectExpr("samples", f"stack({len(ML.RETRAIN_RULES)}, {rules}) AS (model, every)") \
        .withColumn("which", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn(
        "trained_at", F.when(F.col("which") == 1, F.col("samples") - F.col("every")).when(
            F.col("which") == 2, F.col("samples") - F.col("every") + 1))
    return ML.retrain_decisions(cases).select("model", "samples", "trained_at", "due", "reason")


@register("M11")
def q_m11(spark, d):
    """Save the models, load them back, score with the loaded bundle."""
    path = scratch_path(spark, "models")
    ML.save_bundle(spark, trained_bundle(spark, d), path)
    return MH.hybrid_score(_inputs(spark, d), ML.load_bundle(spark, path))


def _run_scoring(spark, d):
    base = scratch_path(spark, "scoring")
    minutes = SM.minute_stream(readings_stream(spark, d), schema.valid_ranges(spark), observe=False)
    q = SS.start_scoring(minutes, trained_bundle(spark, d), base + "/scored", base + "/stats", base + "/checkpoint")
    q.awaitTermination()
    return base


@register("T8")
def q_t8(spark, d):
    """Streaming scoring of the emitted traffic minutes (availableNow)."""
    base = _run_scoring(spark, d)
    return SK.read_versions(spark, base + "/scored").drop(*SK.VERSION)


@register("A19")
def q_a19(spark, d):
    """Per-micro-batch scoring statistics of the T8 stream."""
    base = _run_scoring(spark, d)
    return SK.read_versions(spark, base + "/stats").drop("written_at", "query")


@register("T8_versions", f"""
SELECT CAST(batch AS INTEGER) AS batch_id, CASE WHEN batch < 2 THEN 'v1' ELSE 'v2' END AS ai_model_version, count(*) AS "rows"
FROM (SELECT least({SLICES - 1}, (epoch_us(window_start) - lo) * {SLICES} // (hi - lo)) AS batch
      FROM {HIST_SQL['traffic_loop']}, (SELECT min(epoch_us(window_start)) AS lo, max(epoch_us(window_start)) AS hi
                                        FROM {HIST_SQL['traffic_loop']}))
GROUP BY batch""")
def q_t8_versions(spark, d):
    """T8/M11 with a model registry: a stream of four micro-batches, a second
    version published after the second one; rows by batch and model version."""
    base = scratch_path(spark, "registry")
    registry = MR.Registry(spark, base + "/models")
    registry.publish(trained_bundle(spark, d), "v1")

    def after(df, batch_id):
        if batch_id == 1:
            registry.publish(trained_bundle(spark, d), "v2")

    minutes = history(spark, d, "traffic_loop")
    edges = minutes.agg(F.min("window_start"), F.max("window_start")).first()
    for i in range(SLICES if edges[0] is not None else 0):
        lo, hi = (edges[0] + (edges[1] - edges[0]) * k / SLICES for k in (i, i + 1))
        inside = (F.col("window_start") >= F.lit(lo)) & ((F.col("window_start") < F.lit(hi)) if i < SLICES - 1 else F.lit(True))
        minutes.filter(inside).coalesce(1).write.mode("append").parquet(base + "/minutes")
    stream = spark.readStream.schema(minutes.schema).option("maxFilesPerTrigger", 1).parquet(base + "/minutes")
    SS.start_scoring(stream, registry, base + "/scored", base + "/stats", base + "/checkpoint", on_batch=after).awaitTermination()
    return SK.read_versions(spark, base + "/scored").groupBy("batch_id", "ai_model_version").agg(F.count("*").alias("rows"))


# =================================================================== flagship
@register("flagship")
def q_flagship(spark, d):
    """Fleet statistics (A3) over the latest minute row of every sensor."""
    return q_a3(spark, d)


for _view, _whole in (("A14_view", "A14"), ("S7_stored", "S7"), ("A17_stored", "A17")):
    ORACLE[_view] = ORACLE[_whole]
ORACLE["flagship"] = ORACLE["A3"]


# ------------------------------------------------------------------ comparison
# Means are computed in full precision; engines add doubles in different orders,
# so the compared projection (here, and in the SQL twin) rounds them.
DIGITS = 9
_WIDE = "vehicle_count_per_min avg_speed_kmh avg_wait_time_s pm25 noise_db temp_c"
ROUNDED = {
    **dict.fromkeys(["P9", "Q1", "J1", "P4", "P4_sensor", "J2", "J3", "J4", "Q2", "T5", "L1", "L4", "T1", "T1_multi", "T1_chained", "T2", "T2_late", "S4", "L1_deep", "L1_after", "J4_stored", "P4_stored"], _WIDE),
    **dict.fromkeys(["A2", "T3", "A14", "A14_view", "T4", "T4_multi", "T3_stream", "T3_chained"], "avg_value"),
    **dict.fromkeys(["Q2_period", "Q2_day"], "vehicle_count_per_min avg_speed_kmh avg_wait_time_s"),
    **dict.fromkeys(["A13", "A13_5min", "A13_view", "A13_view_day"], "avg_vehicles"),
    **dict.fromkeys(["Q4", "T6", "T6_multi"], "recent_avg"),
    "A1": "mean_value",
    "A3": "vehicle_count_avg speed_avg wait_time_avg pm25_avg temp_avg noise_avg",
    "A15": "x y",
    "A16": "avg_noise difference",
    "A16_sensors": "noise_db",
    "P10": "vehicle_count avg_speed wait_time_s speed_variance congestion_index flow_efficiency",
    "P11": "vehicle_count avg_speed wait_time_s",
    "P14": f"{_WIDE} ai_congestion_index",
    "M6_rules": "vehicle_count avg_speed wait_time_s",
    "M8_unavailable": "vehicle_count avg_speed wait_time_s",
    "Q2_air": "pm25 temp_c",
    "Q2_noise": "noise_db",
    "Q3_running": "vehicle_count_avg avg_speed_avg wait_time_s_avg pm25_avg noise_db_avg temp_c_avg",
    "Q5": "value",
}


def _rounding(fn, cols: list[str]):
    def run(spark, d):
        return fn(spark, d).withColumns({c: F.round(c, DIGITS) + F.lit(0.0) for c in cols})  # -0.0 is 0.0
    run.__doc__ = fn.__doc__
    return run


for _name, _cols in ROUNDED.items():
    QUERIES[_name] = _rounding(QUERIES[_name], _cols.split())
    _replaced = ", ".join(f"round({c}, {DIGITS}) + 0.0 AS {c}" for c in _cols.split())
    ORACLE[_name] = f"SELECT * REPLACE ({_replaced}) FROM (\n{ORACLE[_name]}\n)"
QUERIES["flagship"], ORACLE["flagship"] = QUERIES["A3"], ORACLE["A3"]
