from helpers import T
from pyspark.sql import functions as F

from streetpulse.operators import dashboards as DB

LATEST = ("sensor_id string, sensor_type string, window_start timestamp_ntz, vehicle_count_per_min double, "
          "avg_speed_kmh double, avg_wait_time_s double, pm25 double, noise_db double, temp_c double, "
          "status string, breaches array<string>, lat double, lon double")


def _latest(spark, rows):
    full = [r + (None,) * (13 - len(r)) for r in rows]
    return spark.createDataFrame(full, LATEST)


def test_speed_band_edges_current_vs_history(spark):
    t = T("2024-01-01")
    df = _latest(spark, [(f"L{i}", "traffic_loop", t, 1.0, v) for i, v in enumerate([20.0, 19.9, 40.0, 80.0, 80.1, None])])
    cur = {r.band: r["count"] for r in DB.speed_histogram_current(df).collect()}
    assert cur == {"<20": 2, "20-40": 2, "41-60": 0, "61-80": 1, "80+": 1}     # null -> 0 -> '<20'
    hist = {r.band: r["count"] for r in DB.speed_histogram_history(df).collect()}
    assert hist["0-20 km/h"] == 2 and sum(hist.values()) == 5               # nulls skipped


def test_zero_filled_sums_and_distribution_drops_empty(spark):
    t = T("2024-01-01")
    df = _latest(spark, [(f"N{i}", "noise", t, None, None, None, None, v) for i, v in enumerate([40.0, 40.5, 101.0])])
    h = DB.noise_histogram(df).collect()
    assert len(h) == 5 and sum(r["count"] for r in h) == 3
    cats = {r.band: r["count"] for r in DB.noise_categories(df).collect()}
    assert cats == {"Quiet": 1, "Moderate": 1, "Extremely Loud": 1}


def test_status_distribution_zero_filled_with_extra(spark):
    t = T("2024-01-01")
    df = _latest(spark, [("L1", "traffic_loop", t) + (None,) * 6 + ("WARN",),
                         ("L2", "traffic_loop", t) + (None,) * 6 + ("ODD",),
                         ("L3", "traffic_loop", t)])
    got = {r.status: (r.status_order, r["count"]) for r in DB.status_distribution(df).collect()}
    assert got == {"OK": (0, 0), "WARN": (1, 1), "ALERT": (2, 0), "UNKNOWN": (3, 1), "ODD": (4, 1)}


def test_kpis_count_nulls_as_zero(spark):
    t = T("2024-01-01")
    df = _latest(spark, [("L1", "traffic_loop", t, 10.0, 40.0, 5.0), ("L2", "traffic_loop", t, None, 20.0, None)])
    k = DB.traffic_kpis(df).collect()[0]
    assert (k.total_vehicles, k.avg_speed, k.avg_wait_time, k.peak_traffic, k.active_sensors,
            k.congestion_level) == ("10", "30.0", "2.5", "10", 1, "Medium")


def test_rankings_ties_and_pages(spark):
    t = T("2024-01-01")
    df = _latest(spark, [(f"L{i:02d}", "traffic_loop", t, float(i % 3)) for i in range(15)])
    top = [r.sensor_id for r in DB.rankings(df).filter("ranking = 'byTraffic'").orderBy("rank").collect()]
    assert top[:5] == ["L02", "L05", "L08", "L11", "L14"] and len(top) == 10
    p2 = [r.sensor_id for r in DB.page(df, [F.col("sensor_id")], page_no=2, per_page=4).collect()]
    assert p2 == ["L04", "L05", "L06", "L07"]
    pc = DB.page_count(df, 4).collect()[0]
    assert (pc.total, pc.pages) == (15, 4)


def test_rollup_labels_and_time_order(spark):
    hist = spark.createDataFrame([(T("2024-01-01 23:10:00"), 10.0), (T("2024-01-02 00:20:00"), 20.0),
                                  (T("2024-01-02 00:40:00"), 40.0)],
                                 "window_start timestamp_ntz, vehicle_count_per_min double")
    r = DB.vehicle_rollup(hist, "1hour", "1week").orderBy("bucket_start").collect()
    assert [(x.label, x.avg_vehicles) for x in r] == [("1/1 23:00", 10.0), ("1/2 00:00", 30.0)]
    r5 = DB.vehicle_rollup(hist, "30min", "1hour").orderBy("bucket_start").collect()
    assert [x.label for x in r5] == ["23:00", "00:00", "00:30"]


def test_report_formatting(spark):
    t = T("2024-01-01 10:00:00")
    df = _latest(spark, [("A1", "air_quality", t, None, None, None, 12.345, None, -3.0, "WARN", ["co", "pm25"],
                          42.1, 21.123456789)])
    r = DB.report(df).collect()[0]
    assert (r.pm25, r.temp_c, r.noise_db, r.breaches, r.lon) == ("12.35", "-3.00", "-", "co, pm25", "21.123457")
    titles = [x.title for x in DB.column_titles(df.select("sensor_id", "vehicle_count_per_min")).collect()]
    assert titles == ["Sensor Id", "Vehicle Count Per Min"]


def test_title_case_keeps_inner_capitals(spark):
    from streetpulse.functions.columns import title_case
    df = spark.createDataFrame([("sensorID_value",), ("avg_speed_kmh",)], "c string")
    assert [r[0] for r in df.select(title_case("c")).collect()] == ["SensorID Value", "Avg Speed Kmh"]
