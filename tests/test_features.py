from helpers import T
from pyspark.sql import functions as F

from streetpulse.operators import features as FE

# (vehicle_count, avg_speed, wait_time_s) -> expected rule state
SCENARIOS = [
    ((5, 55, 8), "Free Flow"), ((15, 35, 15), "Light Traffic"), ((35, 20, 45), "Heavy Congestion"),
    ((50, 8, 120), "Gridlock"), ((100, 2, 300), "Gridlock"), ((45, 15, 60), "Gridlock"),
    ((25, 35, 30), "Heavy Congestion"), ((8, 55, 8), "Free Flow"), ((50, 5, 120), "Gridlock"),
]


def _df(spark, triples):
    return spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in triples],
                                 "vehicle_count double, avg_speed double, wait_time_s double")


def test_rule_states_for_reference_scenarios(spark):
    df = _df(spark, [s for s, _ in SCENARIOS])
    got = df.select(FE.rule_classification(F.col("avg_speed"), F.col("wait_time_s")).alias("c")).collect()
    assert [r.c.traffic_state for r in got] == [e for _, e in SCENARIOS]
    first = got[0].c
    assert (first.confidence, first.severity, first.predicted_duration) == (0.7, "Low", "0-5 minutes")
    assert got[3].c.severity == "Critical" and got[3].c.confidence == 0.4


def test_fallback_scoring(spark):
    df = _df(spark, [(36, 50, 0), (10, 50, 61), (21, 50, 0), (5, 50, 31), (20, 50, 30)])
    got = [r.s for r in df.select(FE.fallback_scoring(F.col("vehicle_count"), F.col("wait_time_s")).alias("s")).collect()]
    assert [g.ai_traffic_state for g in got] == ["Heavy Congestion", "Heavy Congestion", "Light Traffic",
                                                 "Light Traffic", "Free Flow"]
    assert got[0].ai_anomaly_detected is True and got[4].ai_predicted_duration == "5-10 minutes"
    assert got[4].ai_model_version == "fallback-v1.0"


def test_rule_anomaly_and_reasons(spark):
    df = _df(spark, [(100, 80, 120), (101, 2, 300), (-1, 81, 0)])
    got = [r.a for r in df.select(FE.rule_anomaly(F.col("vehicle_count"), F.col("avg_speed"),
                                                  F.col("wait_time_s")).alias("a")).collect()]
    assert got[0].is_anomaly is False and got[0].anomaly_score == 0.3
    assert got[1].reasons == ["unusual_vehicle_count_101.0", "unusual_wait_time_300.0"]
    assert got[2].confidence == 0.5 and got[2].anomaly_score == -0.5


def test_features_use_event_time(spark):
    df = spark.createDataFrame([(T("2024-01-06 08:30:00"), 10.0, 0.0, 20.0)],
                               "window_start timestamp_ntz, vehicle_count double, avg_speed double, wait_time_s double")
    r = FE.with_features(df).collect()[0]
    assert (r.hour, r.is_rush_hour, r.is_weekend) == (8, 1, 1)
    assert r.speed_variance == 0.0 and r.congestion_index == 200.0 and r.flow_efficiency == 0.0


def test_batch_score_errors_per_row(spark):
    items = spark.createDataFrame([("a", "10", "55", "8"), ("b", None, "55", None), ("c", "x", "1", "2")],
                                  "sensor_id string, vehicle_count string, avg_speed string, wait_time_s string")
    got = {r.sensor_id: r for r in FE.batch_score(items).collect()}
    assert got["a"].error is None and got["a"].traffic_state == "Free Flow"
    assert got["b"].error == "Missing fields: ['vehicle_count', 'wait_time_s']" and got["b"].traffic_state is None
    assert got["c"].error == "could not convert string to float: 'x'"
