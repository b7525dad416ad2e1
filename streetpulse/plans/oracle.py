"""Reference SQL (DuckDB dialect) for the correctness gate.

Each registered query has an SQL twin that recomputes it from the raw driver
tables. The shared steps (readings derived from ``events``, metadata, valid
readings, the minute table ...) are named common table expressions; ``sql()``
prepends the ones a query uses, in dependency order.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------- shared CTEs
_KIND = "user_id % 3"
_NUM = "(CAST(user_id // 3 AS INTEGER) + 1)"


def _mean(expr: str) -> str:
    return f"avg({expr})"


def _stype(col: str = "sensor_id") -> str:
    return (f"CASE WHEN starts_with({col}, 'Loop-') THEN 'traffic_loop' "
            f"WHEN starts_with({col}, 'Air-') THEN 'air_quality' "
            f"WHEN starts_with({col}, 'Noise-') THEN 'noise' END")


def _ptype(sid: str = "sensor_id", metric: str = "metric") -> str:
    """Prefix, else by metric."""
    return (f"coalesce({_stype(sid)}, CASE WHEN {metric} IN ('pm25','co','temp_c') THEN 'air_quality' "
            f"WHEN {metric} IN ('noise_db') THEN 'noise' ELSE 'traffic_loop' END)")


def _num_text(x: str) -> str:
    return f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END)"


def _dec_text(x: str, digits: int) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(38,12)), {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _coord(base: float, mult: int) -> str:
    return (f"CASE WHEN number % 7 = 0 THEN NULL ELSE CAST({base} AS DOUBLE) + "
            f"CAST((number * {mult}) % 101 - 50 AS DOUBLE) / 1000.0 END")


def _road(kind: str = "kind", num: str = "number") -> str:
    return (f"CASE {kind} WHEN 0 THEN 'Road ' || CAST({num} AS VARCHAR) "
            f"WHEN 1 THEN 'Air Quality Station ' || CAST({num} AS VARCHAR) "
            f"ELSE 'Noise Monitoring Point ' || CAST({num} AS VARCHAR) END")


def _sev(value: str, warning: float, critical: float, direction: str) -> str:
    op = "<=" if direction == "low" else ">="
    return (f"CASE WHEN {value} {op} {critical} THEN 'critical' "
            f"WHEN {value} {op} {warning} THEN 'warning' END")


# Fixed values, typed here by hand: limits, valid ranges, message templates.
LIMITS = [
    ("traffic_loop", "wait_time_s", 8.0, 12.0, "high"),
    ("traffic_loop", "vehicle_count", 8.0, 12.0, "high"),
    ("traffic_loop", "avg_speed", 55.0, 60.0, "low"),
    ("air_quality", "pm25", 15.0, 20.0, "high"),
    ("air_quality", "co", 5.0, 8.0, "high"),
    ("noise", "noise_db", 50.0, 55.0, "high"),
]
RANGES = [("vehicle_count", 0, 100), ("avg_speed", 0, 120), ("wait_time_s", 0, 600),
          ("pm25", 0, 500), ("noise_db", 30, 120), ("temp_c", -30, 50)]
WIDE = [("vehicle_count", "vehicle_count_per_min"), ("avg_speed", "avg_speed_kmh"),
        ("wait_time_s", "avg_wait_time_s"), ("pm25", "pm25"), ("noise_db", "noise_db"), ("temp_c", "temp_c")]


def _values(rows, cols) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


_breach_terms = ", ".join(
    f"CASE WHEN {_ptype('sensor_id', repr(m))} = '{t}' AND ({_sev(m, w, c, d)}) IS NOT NULL THEN '{m}' END"
    for t, m, w, c, d in LIMITS)
_rank_terms = ", ".join(
    f"coalesce(CASE WHEN {_ptype('sensor_id', repr(m))} = '{t}' THEN "
    f"CASE ({_sev(m, w, c, d)}) WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 END END, 0)"
    for t, m, w, c, d in LIMITS)

CTES: dict[str, str] = {
    "readings": f"""
SELECT event_id * 4 + k AS event_id,
  CASE event_id % 101 WHEN 3 THEN '' WHEN 5 THEN 'S-' || {_NUM}
    ELSE concat(CASE {_KIND} WHEN 0 THEN 'Loop-' WHEN 1 THEN 'Air-' ELSE 'Noise-' END, printf('%04d', {_NUM})) END AS sensor_id,
  CASE WHEN event_id % 101 <> 6 THEN ts END AS ts,
  CASE WHEN event_id % 101 <> 4 THEN m END AS metric,
  CASE event_id % 101 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST(1e15 AS DOUBLE) ELSE v END AS value
FROM (
  SELECT *, 0 AS k, 'vehicle_count' AS m, value / 4 AS v FROM events WHERE {_KIND} = 0
  UNION ALL SELECT *, 1, 'avg_speed', 125 - value / 4 FROM events WHERE {_KIND} = 0
  UNION ALL SELECT *, 2, 'wait_time_s', CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value / 5 END FROM events WHERE {_KIND} = 0
  UNION ALL SELECT *, 3, 'queue_len', value FROM events WHERE {_KIND} = 0 AND event_type = 'error'
  UNION ALL SELECT *, 0, 'pm25', CASE WHEN event_type IN ('click', 'view') THEN value * 2 ELSE value / 10 END FROM events WHERE {_KIND} = 1
  UNION ALL SELECT *, 1, 'temp_c', value / 8 - 10 FROM events WHERE {_KIND} = 1
  UNION ALL SELECT *, 2, 'co', value / 10 FROM events WHERE {_KIND} = 1 AND event_type = 'error'
  UNION ALL SELECT *, 0, 'noise_db', value / 2 + 25 FROM events WHERE {_KIND} = 2)""",
    "meta_ids": f"""
SELECT kind, number FROM (SELECT DISTINCT {_KIND} AS kind, {_NUM} AS number FROM events)
UNION ALL
SELECT {_KIND} AS kind, max({_NUM}) + 1 AS number FROM events GROUP BY {_KIND}""",
    "meta": f"""
SELECT concat(CASE kind WHEN 0 THEN 'Loop-' WHEN 1 THEN 'Air-' ELSE 'Noise-' END, printf('%04d', number)) AS sensor_id,
  CASE kind WHEN 0 THEN 'traffic_loop' WHEN 1 THEN 'air_quality' ELSE 'noise' END AS type,
  CASE kind WHEN 0 THEN 'vehicles/min' WHEN 1 THEN 'µg/m³' ELSE 'dB' END AS unit,
  'Prishtina' AS city,
  {_road()} AS road,
  {_coord(42.6629, 37)} AS lat,
  {_coord(21.1639, 53)} AS lon,
  60 AS interval_s
FROM meta_ids""",
    "meta_d": """
SELECT sensor_id, type, unit, city, road, coalesce(lat, CAST(42.6629 AS DOUBLE)) AS lat,
  coalesce(lon, CAST(21.1655 AS DOUBLE)) AS lon, interval_s FROM meta""",
    "ranges": _values(RANGES, ["metric", "min_value", "max_value"]),
    "limits": _values(LIMITS, ["sensor_type", "metric", "warning", "critical", "direction"]),
    "validated": f"""
SELECT r.event_id, r.sensor_id, r.ts, r.metric, r.value,
  (g.metric IS NULL OR coalesce(r.value >= g.min_value AND r.value <= g.max_value, false)) AS is_valid,
  CASE WHEN g.metric IS NULL THEN 'Unknown metric'
       WHEN r.value >= g.min_value AND r.value <= g.max_value THEN 'Valid'
       ELSE 'Out of range: ' || CAST(r.value AS VARCHAR) || ' not in [' || {_num_text('g.min_value')}
            || ', ' || {_num_text('g.max_value')} || ']' END AS validation_msg
FROM readings r LEFT JOIN ranges g ON r.metric = g.metric
WHERE r.sensor_id IS NOT NULL AND r.ts IS NOT NULL AND r.metric IS NOT NULL AND coalesce(abs(r.value) <= 1e12, false)""",
    "valid": "SELECT event_id, sensor_id, ts, metric, value FROM validated WHERE is_valid",
    "agg_g": "SELECT sensor_id, date_trunc('minute', ts) AS window_start, "
             + ", ".join(f"{_mean(f'CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN value END')} AS {m}"
                         for m in ["vehicle_count", "avg_speed", "wait_time_s", "pm25", "noise_db", "temp_c", "co"])
             + " FROM valid GROUP BY sensor_id, date_trunc('minute', ts)",
    "agg": f"""
SELECT sensor_id, window_start, {", ".join(f"{m} AS {c}" for m, c in WIDE)},
  CASE greatest({_rank_terms}) WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARN' ELSE 'OK' END AS status,
  list_sort(list_distinct(list_filter([{_breach_terms}], lambda x: x IS NOT NULL))) AS breaches
FROM agg_g""",
    "latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY window_start DESC) AS rn FROM agg) WHERE rn = 1""",
    "j1": """
SELECT l.*, m.type AS sensor_type, m.unit, m.city, m.road, m.lat, m.lon
FROM latest l JOIN meta_d m USING (sensor_id)""",
    "alerts": f"""
SELECT
  concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12)) AS alert_id,
  * EXCLUDE (h)
FROM (
  SELECT sha256(concat_ws('|', sensor_id, metric, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
                          CAST(value AS VARCHAR))) AS h,
    sensor_id, sensor_type, metric, value, severity, message, location, ts AS timestamp,
    false AS resolved, severity AS threshold_type, threshold_value
  FROM (
    SELECT r.*, CASE WHEN crit THEN 'critical' WHEN warn THEN 'warning' END AS severity,
      CASE WHEN crit THEN l.critical WHEN warn THEN l.warning END AS threshold_value,
      MAP {{'road': 'Road ' || CASE WHEN length(pt) >= 2 THEN pt ELSE lpad(pt, 2, '0') END,
           'city': 'Prishtina', 'country': 'Kosovo'}} AS location,
      __MESSAGE__ AS message
    FROM (SELECT r.*, {_ptype()} AS sensor_type,
            CASE WHEN strpos(sensor_id, '-') > 0 THEN split_part(sensor_id, '-', 2) ELSE '01' END AS pt
          FROM readings r
          WHERE coalesce(sensor_id <> '', false) AND coalesce(metric <> '', false) AND coalesce(abs(value) <= 1e12, false)) r
    JOIN limits l ON r.sensor_type = l.sensor_type AND r.metric = l.metric,
    LATERAL (SELECT CASE WHEN l.direction = 'low' THEN r.value <= l.critical ELSE r.value >= l.critical END AS crit,
                    CASE WHEN l.direction = 'low' THEN r.value <= l.warning ELSE r.value >= l.warning END AS warn)
    WHERE crit OR warn))""",
}

_TEMPLATES = [
    ("traffic_loop", "vehicle_count", "High vehicle count on ", "Vehicles: ", 0, "", ""),
    ("traffic_loop", "wait_time_s", "Long wait time on ", "Wait: ", 1, "s", "s"),
    ("traffic_loop", "avg_speed", "Slow traffic on ", "Speed: ", 1, " km/h", " km/h"),
    ("air_quality", "pm25", "High PM2.5 levels at ", "PM2.5: ", 1, " µg/m³", ""),
    ("air_quality", "co", "High CO levels at ", "CO: ", 1, " ppm", ""),
    ("noise", None, "High noise levels at ", "Noise: ", 1, " dB", " dB"),
]


def _message_sql() -> str:
    thr = "(CASE WHEN crit THEN l.critical ELSE l.warning END)"
    lim = _num_text(thr)
    parts = []
    for t, m, prefix, label, digits, uv, ul in _TEMPLATES:
        cond = f"r.sensor_type = '{t}'" + ("" if m is None else f" AND r.metric = '{m}'")
        txt = (f"'{prefix}' || r.sensor_id || ', Prishtina. {label}' || {_dec_text('r.value', digits)} "
               f"|| '{uv} (limit: ' || {lim} || '{ul})'")
        parts.append(f"WHEN {cond} THEN {txt}")
    generic = (f"'Alert for ' || r.sensor_id || ': ' || r.metric || ' = ' || {_dec_text('r.value', 2)} "
               f"|| ' (threshold: ' || {lim} || ')'")
    return "CASE " + " ".join(parts) + f" ELSE {generic} END"


CTES["alerts"] = CTES["alerts"].replace("__MESSAGE__", _message_sql())

def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """Prepend, in dependency order, the shared CTEs that ``body`` mentions."""
    defs = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in order:
            return
        for dep in [n for n in defs if n != name and re.search(rf"\b(FROM|JOIN)\s+{n}\b", defs[name])]:
            if dep not in seen:
                visit(dep, seen + (name,))
        order.append(name)

    for name in [n for n in defs if re.search(rf"\b(FROM|JOIN)\s+{n}\b", body)]:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({defs[n]})" for n in order) + "\n" + body
