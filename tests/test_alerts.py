from helpers import T, readings_df, rows
from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.operators import alerts as AL
from streetpulse.operators import enrich as EN


def _alerts(spark, data, limits=None):
    return AL.alerts_from_readings(readings_df(spark, data), schema.alert_limits(spark, limits))


def test_sensor_type_prefix_then_metric(spark):
    df = spark.createDataFrame([("Loop-1", "pm25"), ("Air-1", "noise_db"), ("X1", "co"), ("X2", "noise_db"),
                                ("X3", "vehicle_count"), ("Noise-7", "x")], "sensor_id string, metric string")
    got = [r[0] for r in df.select(EN.sensor_type("sensor_id", "metric")).collect()]
    assert got == ["traffic_loop", "air_quality", "air_quality", "noise", "traffic_loop", "noise"]


def test_breach_thresholds_high_and_low(spark):
    t0 = T("2024-01-01 00:00:00")
    data = [(1, "Loop-01", t0, "wait_time_s", 7.99), (2, "Loop-01", t0, "wait_time_s", 8.0),
            (3, "Loop-01", t0, "wait_time_s", 12.0), (4, "Loop-01", t0, "avg_speed", 60.0),
            (5, "Loop-01", t0, "avg_speed", 60.5), (6, "Air-01", t0, "pm25", 15.0),
            (7, "Air-01", t0, "co", 8.0), (8, "Noise-01", t0, "noise_db", 54.9), (9, "Noise-01", t0, "temp_c", 99.0),
            (10, "Loop-01", t0, "queue_len", 99.0)]
    a = _alerts(spark, data)
    got = {(r.sensor_id, r.metric, r.value): (r.severity, r.threshold_value) for r in a.collect()}
    assert a.count() == 6
    assert got[("Loop-01", "wait_time_s", 8.0)] == ("warning", 8.0)
    assert got[("Loop-01", "wait_time_s", 12.0)] == ("critical", 12.0)
    # avg_speed: value <= limit, critical (60) tested first -> warning (55) unreachable
    assert got[("Loop-01", "avg_speed", 60.0)] == ("critical", 60.0)
    assert got[("Air-01", "pm25", 15.0)] == ("warning", 15.0)
    assert got[("Air-01", "co", 8.0)] == ("critical", 8.0)
    assert got[("Noise-01", "noise_db", 54.9)] == ("warning", 50.0)


def test_low_direction_with_ordered_limits(spark):
    limits = [("traffic_loop", "avg_speed", 60.0, 55.0, "low")]
    t0 = T("2024-01-01")
    got = {r.value: r.severity for r in _alerts(spark, [(1, "Loop-1", t0, "avg_speed", 55.0),
                                                        (2, "Loop-1", t0, "avg_speed", 58.0),
                                                        (3, "Loop-1", t0, "avg_speed", 61.0)], limits).collect()}
    assert got == {55.0: "critical", 58.0: "warning"}


def test_messages_location_ids(spark):
    t0 = T("2024-01-01 10:00:00")
    a = {r.metric: r for r in _alerts(spark, [(1, "Loop-7", t0, "vehicle_count", 12.5),
                                              (2, "Loop-123", t0, "wait_time_s", 12.25),
                                              (3, "Air-01", t0, "co", 9.0),
                                              (4, "Noise-3", t0, "noise_db", 56.04)]).collect()}
    assert a["vehicle_count"].message == "High vehicle count on Loop-7, Prishtina. Vehicles: 13 (limit: 12)"
    assert a["wait_time_s"].message == "Long wait time on Loop-123, Prishtina. Wait: 12.3s (limit: 12s)"
    assert a["co"].message == "High CO levels at Air-01, Prishtina. CO: 9.0 ppm (limit: 8)"
    assert a["noise_db"].message == "High noise levels at Noise-3, Prishtina. Noise: 56.0 dB (limit: 55 dB)"
    assert a["vehicle_count"].location == {"road": "Road 07", "city": "Prishtina", "country": "Kosovo"}
    assert a["wait_time_s"].location["road"] == "Road 123"
    assert a["co"].timestamp == t0 and a["co"].resolved is False and a["co"].threshold_type == "critical"
    again = {r.metric: r.alert_id for r in _alerts(spark, [(9, "Air-01", t0, "co", 9.0)]).collect()}
    assert again["co"] == a["co"].alert_id and len(a["co"].alert_id) == 36


def test_road_without_dash(spark):
    df = spark.createDataFrame([("Sensor",)], "sensor_id string")
    assert df.select(EN.road_from_id("sensor_id")).collect()[0][0] == "Road 01"


def test_resolve_counts_and_feed(spark):
    t0 = T("2024-01-01 10:00:00")
    a = _alerts(spark, [(1, "Loop-1", t0, "wait_time_s", 20.0), (2, "Loop-1", T("2024-01-01 10:00:30"), "wait_time_s", 9.0),
                        (3, "Air-1", T("2024-01-01 09:00:00"), "pm25", 30.0)])
    first = a.filter(F.col("value") == 20.0).select("alert_id")
    r = AL.resolve(a, first)
    c = AL.alert_counts(r).collect()[0]
    assert (c.total_alerts, c.active_alerts, c.critical_count, c.warning_count) == (3, 2, 1, 1)
    assert AL.unresolved(r).count() == 2
    feed = AL.critical_feed(a, minutes=1).collect()
    assert [x.notification for x in feed] == ["TRAFFIC ALERT!\nRoad 01: wait_time_s=20.0"]
