"""Dashboard analytics: fleet statistics (A3), KPIs (A4-A6), histograms and
distributions (A7-A12), time rollups (A13, A14), pairs and correlation (A15),
standards comparison (A16), extent (A22), rankings and pages (Q5, L1-L5),
filters (P4), bands (P17) and report formatting (P18).

Inputs are either the latest row per sensor (J1 output, one row per sensor)
or the minute history (D3). Every aggregate is a single hash aggregation with
a map-side partial step; zero-filled histograms are conditional counts in that
one aggregation, unpivoted with ``stack`` (no join with a label list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (band, banded, dash_or, decimal_text, floor_minutes, mean,
                                 time_floor, title_case)

# ---------------------------------------------------------------------------
# Fixed values of the reference dashboards (band edges, labels, standards).
# ---------------------------------------------------------------------------
# current speed histogram: first band strictly below 20
SPEED_BANDS_CURRENT = [("<20", 20, False), ("20-40", 40, True), ("41-60", 60, True),
                       ("61-80", 80, True), ("80+", None, True)]
# historical speed histogram: first band up to and including 20
SPEED_BANDS_HISTORY = [("0-20 km/h", 20, True), ("21-40 km/h", 40, True), ("41-60 km/h", 60, True),
                       ("61-80 km/h", 80, True), ("80+ km/h", None, True)]
TEMP_BANDS = [("<10°C", 10, False), ("10-15°C", 15, True), ("16-20°C", 20, True),
              ("21-25°C", 25, True), ("26-30°C", 30, True), (">30°C", None, True)]
AIR_LEVELS = [("Good", 12, True), ("Moderate", 35.4, True), ("Unhealthy for Sensitive", 55.4, True),
              ("Unhealthy", 150.4, True), ("Very Unhealthy", None, True)]
NOISE_LEVELS = [("Quiet", 40, True), ("Moderate", 60, True), ("Loud", 80, True),
                ("Very Loud", 100, True), ("Extremely Loud", None, True)]
NOISE_BANDS = [("<40 dB", 40, True), ("40-60 dB", 60, True), ("61-80 dB", 80, True),
               ("81-100 dB", 100, True), (">100 dB", None, True)]
# congestion level from mean speed: <30 High, <50 Medium, else Low
CONGESTION_LEVELS = [("High", 30, False), ("Medium", 50, False), ("Low", None, True)]
STATUS_LABELS = ["OK", "WARN", "ALERT", "UNKNOWN"]
NOISE_STANDARDS = [("WHO Guideline", 55.0), ("Residential Limit", 45.0), ("Commercial Limit", 65.0),
                   ("Industrial Limit", 75.0), ("Highway Level", 85.0)]
WHO_NOISE_DB = 55.0
WHO_PM25 = 15.0
QUIET_DB = 40.0
LOUD_DB = 80.0


def zero(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(0.0))


def of_type(df: DataFrame, stype: str, col: str = "sensor_type") -> DataFrame:
    return df.filter(F.col(col) == stype)


# ----------------------------------------------------------------------- P4
def select_sensors(df: DataFrame, stype: str | None = None, sensor_id: str | None = None,
                   type_col: str = "sensor_type") -> DataFrame:
    """One selected sensor wins over a type filter; none -> all."""
    if sensor_id is not None:
        return df.filter(F.col("sensor_id") == sensor_id)
    if stype is not None:
        return df.filter(F.col(type_col) == stype)
    return df


# ----------------------------------------------------------------------- A3
def fleet_statistics(latest: DataFrame) -> DataFrame:
    """A3: per type, sensor count and null-skipping means (0 when none)."""
    def m(c):
        return F.coalesce(mean(c), F.lit(0.0))
    return latest.groupBy("sensor_type").agg(
        F.count("*").alias("sensor_count"),
        m("vehicle_count_per_min").alias("vehicle_count_avg"), m("avg_speed_kmh").alias("speed_avg"),
        m("avg_wait_time_s").alias("wait_time_avg"), m("pm25").alias("pm25_avg"),
        m("temp_c").alias("temp_avg"), m("noise_db").alias("noise_avg"))


def _zero_mean(c: str) -> Column:
    """Mean with nulls counted as 0 (UI rule); null on empty input."""
    return F.avg(zero(c))


# --------------------------------------------------------------------- A4-A6
def traffic_kpis(latest: DataFrame) -> DataFrame:
    """A4 over the latest traffic rows: nulls count as 0 in means."""
    t = of_type(latest, "traffic_loop")
    k = t.agg(F.sum(zero("vehicle_count_per_min")).alias("total"),
              _zero_mean("avg_speed_kmh").alias("avg_speed"),
              _zero_mean("avg_wait_time_s").alias("avg_wait"),
              F.max(zero("vehicle_count_per_min")).alias("peak"),
              F.count("vehicle_count_per_min").alias("active_sensors"))
    return k.select(
        decimal_text("total", 0).alias("total_vehicles"),
        decimal_text("avg_speed", 1).alias("avg_speed"),
        decimal_text("avg_wait", 1).alias("avg_wait_time"),
        decimal_text("peak", 0).alias("peak_traffic"),
        "active_sensors",
        banded("avg_speed", CONGESTION_LEVELS).alias("congestion_level"))


def air_kpis(latest: DataFrame) -> DataFrame:
    """A5 over the latest air-quality rows."""
    a = of_type(latest, "air_quality")
    level = banded(zero("pm25"), AIR_LEVELS)
    k = a.agg(_zero_mean("pm25").alias("avg_pm25"), _zero_mean("temp_c").alias("avg_temp"),
              F.max(zero("pm25")).alias("max_pm25"),
              F.count_if(level == "Good").alias("good_air_quality"),
              F.count("pm25").alias("active_sensors"))
    return k.select(decimal_text("avg_pm25", 1).alias("avg_pm25"), decimal_text("avg_temp", 1).alias("avg_temp"),
                    decimal_text("max_pm25", 1).alias("max_pm25"), "good_air_quality", "active_sensors",
                    banded("avg_pm25", AIR_LEVELS).alias("overall_quality"))


def noise_kpis(latest: DataFrame) -> DataFrame:
    """A6 over the latest noise rows."""
    n = of_type(latest, "noise")
    k = n.agg(_zero_mean("noise_db").alias("avg_noise"), F.max(zero("noise_db")).alias("max_noise"),
              F.min(zero("noise_db")).alias("min_noise"),
              F.count_if(zero("noise_db") <= QUIET_DB).alias("quiet_sensors"),
              F.count_if(F.coalesce(F.col("noise_db") > LOUD_DB, F.lit(False))).alias("loud_sensors"),
              F.count("noise_db").alias("active_sensors"))
    return k.select(decimal_text("avg_noise", 1).alias("avg_noise"), decimal_text("max_noise", 1).alias("max_noise"),
                    decimal_text("min_noise", 1).alias("min_noise"), "quiet_sensors", "loud_sensors",
                    "active_sensors", banded("avg_noise", NOISE_LEVELS).alias("overall_level"))


# ------------------------------------------------------------------ histograms
def zero_filled_histogram(df: DataFrame, band_col: Column, labels: Sequence[str]) -> DataFrame:
    """Counts per label, including empty labels, in one aggregation; rows
    (band_order, band, count)."""
    counts = df.agg(*[F.count_if(band_col == lab).alias(f"_c{i}") for i, lab in enumerate(labels)])
    pairs = ", ".join(f"{i}, '{lab}', _c{i}" for i, lab in enumerate(labels))
    return counts.selectExpr(f"stack({len(labels)}, {pairs}) AS (band_order, band, count)")


def distribution(df: DataFrame, band_col: Column, labels: Sequence[str]) -> DataFrame:
    """Counts per label, empty labels dropped; rows (band_order, band, count)."""
    order = F.array_position(F.array(*[F.lit(x) for x in labels]), band_col) - 1
    return (df.select(band_col.alias("band"), order.cast("int").alias("band_order"))
            .groupBy("band_order", "band").agg(F.count("*").alias("count")))


def _labels(spec):
    return [s[0] for s in spec]


def speed_histogram_current(latest: DataFrame) -> DataFrame:
    """A7 current: latest traffic rows, null speed -> 0, zero-filled."""
    t = of_type(latest, "traffic_loop")
    return zero_filled_histogram(t, banded(zero("avg_speed_kmh"), SPEED_BANDS_CURRENT), _labels(SPEED_BANDS_CURRENT))


def speed_histogram_history(history: DataFrame) -> DataFrame:
    """A7 historical: minute rows, null speeds skipped, zero-filled."""
    h = history.filter(F.col("avg_speed_kmh").isNotNull())
    return zero_filled_histogram(h, banded("avg_speed_kmh", SPEED_BANDS_HISTORY), _labels(SPEED_BANDS_HISTORY))


def temperature_histogram(history: DataFrame) -> DataFrame:
    """Temperature bands over air rows, nulls skipped, zero-filled."""
    h = history.filter(F.col("temp_c").isNotNull())
    return zero_filled_histogram(h, banded("temp_c", TEMP_BANDS), _labels(TEMP_BANDS))


def air_level_distribution(history: DataFrame) -> DataFrame:
    """PM2.5 level per row (nulls skipped), empty levels dropped."""
    h = history.filter(F.col("pm25").isNotNull())
    return distribution(h, banded("pm25", AIR_LEVELS), _labels(AIR_LEVELS))


def noise_histogram(latest: DataFrame) -> DataFrame:
    """A10 histogram: latest noise rows, null -> 0, zero-filled."""
    n = of_type(latest, "noise")
    return zero_filled_histogram(n, banded(zero("noise_db"), NOISE_BANDS), _labels(NOISE_BANDS))


def noise_categories(latest: DataFrame) -> DataFrame:
    """A10 categories: latest noise rows, null -> 0, empty categories dropped."""
    n = of_type(latest, "noise")
    return distribution(n, banded(zero("noise_db"), NOISE_LEVELS), _labels(NOISE_LEVELS))


def status_distribution(latest: DataFrame) -> DataFrame:
    """Traffic status counts over OK/WARN/ALERT/UNKNOWN (zero-filled),
    other values kept after them."""
    t = of_type(latest, "traffic_loop")
    st = F.coalesce(F.col("status"), F.lit("UNKNOWN"))
    observed = t.groupBy(st.alias("status")).agg(F.count("*").alias("count"))
    fixed = observed.sparkSession.createDataFrame(
        [(s, 0) for s in STATUS_LABELS], "status string, count long")
    pos = F.array_position(F.array(*[F.lit(s) for s in STATUS_LABELS]), F.col("status"))
    order = F.when(pos > 0, pos - 1).otherwise(F.lit(len(STATUS_LABELS)))
    return (observed.unionByName(fixed).groupBy("status").agg(F.sum("count").cast("long").alias("count"))
            .select(order.cast("int").alias("status_order"), "status", "count"))


def sensors_per_type(latest: DataFrame) -> DataFrame:
    """A12."""
    return latest.groupBy("sensor_type").agg(F.count("*").alias("sensor_count"))


# ---------------------------------------------------------------- A13 / A14
GRAINS = {"1min": "minute", "5min": 5, "30min": 30, "1hour": "hour", "1day": "day"}
LONG_PERIODS = ("2days", "1week", "week")


def bucket_start(ts: str, granularity: str) -> Column:
    g = GRAINS.get(granularity, "minute")
    return floor_minutes(ts, g) if isinstance(g, int) else time_floor(ts, g)


def bucket_label(start: Column, granularity: str, period: str) -> Column:
    """Clock label 'HH:mm' ('M/d' for days), date-prefixed for long periods."""
    fmt = "M/d" if GRAINS.get(granularity) == "day" else "HH:mm"
    if period in LONG_PERIODS:
        fmt = "M/d " + fmt
    return F.date_format(start, fmt)


def vehicle_rollup(history: DataFrame, granularity: str = "1hour", period: str = "1week") -> DataFrame:
    """Mean vehicles per bucket over rows with a count (true time buckets,
    ordered by time, label kept separately, R8)."""
    h = history.filter(F.col("vehicle_count_per_min").isNotNull())
    b = bucket_start("window_start", granularity)
    return (h.groupBy(b.alias("bucket_start"))
            .agg(mean("vehicle_count_per_min").alias("avg_vehicles"), F.count("*").alias("n"))
            .withColumn("label", bucket_label(F.col("bucket_start"), granularity, period)))


def hour_profiles(agg: DataFrame, meta: DataFrame, profiles: Sequence[tuple[str, str]]) -> DataFrame:
    """Mean by hour of day for each (sensor type, measure), over the rows
    with a value, from one aggregation of the minute rows."""
    typed = agg.join(meta.select("sensor_id", "type"), "sensor_id")
    held = [F.when(F.col("type") == stype, F.col(m)) for stype, m in profiles]
    g = typed.groupBy(F.hour("window_start").alias("hour")).agg(
        *[mean(h).alias(f"avg_{m}") for h, (_, m) in zip(held, profiles)],
        *[F.count(h).alias(f"n_{m}") for h, (_, m) in zip(held, profiles)])
    each = ", ".join(f"'{m}', avg_{m}, n_{m}" for _, m in profiles)
    return (g.selectExpr("hour", f"stack({len(profiles)}, {each}) AS (profile, avg_value, n)").filter("n > 0")
            .withColumn("label", F.format_string("%02d:00", F.col("hour"))))


# ------------------------------------------------------------------- A15
def pm25_temperature_pairs(history: DataFrame) -> DataFrame:
    """(temperature, PM2.5) pairs where both exist, with the WHO line."""
    h = history.filter(F.col("pm25").isNotNull() & F.col("temp_c").isNotNull())
    return h.select("sensor_id", "window_start", F.col("temp_c").alias("x"), F.col("pm25").alias("y"),
                    F.lit(WHO_PM25).alias("who_line"))


def pm25_temperature_correlation(history: DataFrame) -> DataFrame:
    """A15 summary: Pearson correlation (rounded to 9 digits; null below two
    pairs or without variance) and pair count."""
    h = history.filter(F.col("pm25").isNotNull() & F.col("temp_c").isNotNull())
    corr = F.when(F.count("*") >= 2, F.round(F.corr("temp_c", "pm25"), 9))
    return h.agg(F.nanvl(corr, F.lit(None).cast("double")).alias("correlation"), F.count("*").alias("pairs"))


# ------------------------------------------------------------------- A16
def noise_vs_standards(latest: DataFrame) -> DataFrame:
    """Mean noise (null -> 0) against five standards, with difference.
    The five standards are literal rows produced by ``stack``: no join."""
    n = of_type(latest, "noise")
    avg = n.agg(_zero_mean("noise_db").alias("avg_noise"))
    pairs = ", ".join(f"'{k}', CAST({v} AS DOUBLE)" for k, v in NOISE_STANDARDS)
    return (avg.selectExpr("avg_noise", f"stack({len(NOISE_STANDARDS)}, {pairs}) AS (standard, limit_db)")
            .withColumn("difference", F.col("avg_noise") - F.col("limit_db")))


def noise_per_sensor(latest: DataFrame) -> DataFrame:
    """A16 per sensor: level (null -> 0) against the WHO 55 dB line."""
    n = of_type(latest, "noise")
    db = zero("noise_db")
    return n.select("sensor_id", db.alias("noise_db"), banded(db, NOISE_LEVELS).alias("level"),
                    (db > WHO_NOISE_DB).alias("above_who"))


# ------------------------------------------------------------------- A22
def geographic_extent(latest: DataFrame) -> DataFrame:
    return latest.agg(F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"),
                      F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"),
                      F.count("*").alias("sensors"))


# --------------------------------------------------------------------- Q5
RANKINGS = [("byTraffic", "vehicle_count_per_min"), ("bySpeed", "avg_speed_kmh"),
            ("byWaitTime", "avg_wait_time_s")]


def rankings(latest: DataFrame, k: int = 10) -> DataFrame:
    """Q5: top ``k`` traffic sensors by vehicles, speed and wait (null -> 0),
    rank 1..k, ties by sensor_id. ``row_number <= k`` is planned as a group
    limit before the shuffle."""
    t = of_type(latest, "traffic_loop")
    pairs = ", ".join(f"'{name}', coalesce({c}, CAST(0 AS DOUBLE))" for name, c in RANKINGS)
    long = t.selectExpr("sensor_id", f"stack({len(RANKINGS)}, {pairs}) AS (ranking, value)")
    w = Window.partitionBy("ranking").orderBy(F.col("value").desc(), F.col("sensor_id"))
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ------------------------------------------------------------------ L1-L4
def page(df: DataFrame, order: Sequence[Column], page_no: int = 1, per_page: int = 30) -> DataFrame:
    """A page of a sorted table (offset + limit after a global order)."""
    return df.orderBy(*order).offset((page_no - 1) * per_page).limit(per_page)


def page_count(df: DataFrame, per_page: int = 30) -> DataFrame:
    """L3: total rows and pages = ceil(total / per_page)."""
    return (df.agg(F.count("*").alias("total"))
            .withColumn("pages", F.ceil(F.col("total") / F.lit(per_page)).cast("long"))
            .withColumn("per_page", F.lit(per_page)))


def top_k(latest: DataFrame, measure: str, k: int = 10, tie: Sequence[str] = ("sensor_id",)) -> DataFrame:
    """L4: ``k`` sensors with the largest latest ``measure``, null as 0
    (TakeOrderedAndProject)."""
    return latest.orderBy(zero(measure).desc(), *tie).limit(k)


# ------------------------------------------------------------------- P17
def bands(latest: DataFrame) -> DataFrame:
    """Every band of a latest row (null measures give null bands)."""
    return latest.select(
        "sensor_id",
        banded("avg_speed_kmh", SPEED_BANDS_CURRENT).alias("speed_band"),
        banded("temp_c", TEMP_BANDS).alias("temperature_band"),
        banded("pm25", AIR_LEVELS).alias("air_quality_level"),
        banded("noise_db", NOISE_LEVELS).alias("noise_level"),
        banded("avg_speed_kmh", CONGESTION_LEVELS).alias("congestion_level"))


# ------------------------------------------------------------------- P18
REPORT_MEASURES = ["vehicle_count_per_min", "avg_speed_kmh", "avg_wait_time_s", "pm25", "noise_db", "temp_c"]


def report(latest: DataFrame) -> DataFrame:
    """Display form: null -> '-', 2 decimals for measures, 6 for lat/lon,
    breaches joined by ', ' ('-' when empty)."""
    br = F.when(F.size("breaches") > 0, F.array_join("breaches", ", ")).otherwise(F.lit("-"))
    return latest.select(
        "sensor_id", F.coalesce(F.col("sensor_type"), F.lit("-")).alias("sensor_type"),
        F.coalesce(F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-")).alias("timestamp"),
        *[dash_or(c, 2).alias(c) for c in REPORT_MEASURES],
        dash_or("lat", 6).alias("lat"), dash_or("lon", 6).alias("lon"),
        F.coalesce(F.col("status"), F.lit("-")).alias("status"), br.alias("breaches"))


def column_titles(df: DataFrame) -> DataFrame:
    """P18 headers: column keys as title-case text, in column order."""
    rows = [(i, c) for i, c in enumerate(df.columns)]
    keys = df.sparkSession.createDataFrame(rows, "position int, column string")
    return keys.withColumn("title", title_case("column"))
