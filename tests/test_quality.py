from helpers import T, readings_df, rows

from streetpulse import schema
from streetpulse.operators import quality as QU


def test_completeness_gate_and_quarantine(spark):
    df = readings_df(spark, [
        (1, "Loop-01", T("2024-01-01 00:00:00"), "avg_speed", 50.0),
        (2, None, T("2024-01-01 00:00:00"), "avg_speed", 50.0),
        (3, "Loop-01", None, "avg_speed", 50.0),
        (4, "Loop-01", T("2024-01-01 00:00:00"), None, 50.0),
        (5, "Loop-01", T("2024-01-01 00:00:00"), "avg_speed", None),
        (6, "", T("2024-01-01 00:00:00"), "avg_speed", 1.0),
    ])
    ok, bad = QU.split_complete(df)
    assert sorted(r[0] for r in rows(ok, "event_id")) == [1, 6]
    assert sorted(r[0] for r in rows(bad, "event_id")) == [2, 3, 4, 5]
    ok2, bad2 = QU.split_complete(df, strict_text=True)
    # alert variant: empty sensor_id rejected, missing ts allowed
    assert sorted(r[0] for r in rows(ok2, "event_id")) == [1, 3]


def test_iso_timestamp_parse(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+00:00",),
                                ("2024-01-01T10:00:00.250Z",), ("not a time",)], "t string")
    got = [r[0] for r in df.select(QU.parse_iso_ts("t")).collect()]
    assert got[0] == T("2024-01-01 10:00:00") == got[1]
    assert got[2] == T("2024-01-01 10:00:00.250")
    assert got[3] is None


def test_range_validation_boundaries(spark):
    df = readings_df(spark, [
        (1, "Loop-01", T("2024-01-01"), "vehicle_count", 0.0),
        (2, "Loop-01", T("2024-01-01"), "vehicle_count", 100.0),
        (3, "Loop-01", T("2024-01-01"), "vehicle_count", 100.5),
        (4, "Loop-01", T("2024-01-01"), "vehicle_count", -0.5),
        (5, "Air-01", T("2024-01-01"), "temp_c", -30.0),
        (6, "Air-01", T("2024-01-01"), "temp_c", -30.25),
        (7, "Noise-01", T("2024-01-01"), "noise_db", 29.9),
        (8, "Loop-01", T("2024-01-01"), "queue_len", 1e6),
    ])
    v = QU.validate(df, schema.valid_ranges(spark))
    got = {r[0]: (r[1], r[2]) for r in rows(v, "event_id", "is_valid", "validation_msg")}
    assert got[1] == (True, "Valid") and got[2] == (True, "Valid")
    assert got[3] == (False, "Out of range: 100.5 not in [0, 100]")
    assert got[4] == (False, "Out of range: -0.5 not in [0, 100]")
    assert got[5][0] is True and got[6] == (False, "Out of range: -30.25 not in [-30, 50]")
    assert got[7] == (False, "Out of range: 29.9 not in [30, 120]")
    assert got[8] == (True, "Unknown metric")
    good, bad = QU.split_valid(v)
    assert good.count() + bad.count() == df.count()


def test_processing_counters(spark):
    df = readings_df(spark, [(1, "Loop-01", T("2024-01-01"), "avg_speed", 500.0),
                             (2, "Loop-01", T("2024-01-01"), "avg_speed", 50.0)])
    c = QU.processing_counters(QU.validate(df, schema.valid_ranges(spark))).collect()[0]
    assert (c.messages_processed, c.validation_errors, c.anomalies_detected) == (1, 1, 0)
