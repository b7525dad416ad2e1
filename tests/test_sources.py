from helpers import T

from streetpulse.operators import quality as QU
from streetpulse.sources import fixtures as FX
from streetpulse.sources.streams import parse_messages

from conftest import SF


def test_wire_messages_parse_and_quarantine(spark):
    msgs = spark.createDataFrame([
        (1, '{"sensor_id": "Loop-01", "ts": "2024-01-01T10:00:00Z", "metric": "avg_speed", "value": 50.5}'),
        (2, '{"sensor_id": "Loop-01", "ts": "2024-01-01T10:00:00+00:00", "metric": "avg_speed", "value": 7}'),
        (3, '{"sensor_id": "Loop-01", "ts": "yesterday", "metric": "avg_speed", "value": 1.0}'),
        (4, '{"sensor_id": "Loop-01", "metric": "avg_speed", "value": 1.0}'),
        (5, '{"sensor_id": "", "ts": "2024-01-01T10:00:00Z", "metric": "avg_speed", "value": 1.0}'),
        (6, '{"sensor_id": "Loop-01", "ts": "2024-01-01T10:00:00Z", "metric": "avg_speed", "value": null}'),
        (7, 'not json at all'),
    ], "event_id long, value string")
    parsed = parse_messages(msgs)
    got = {r.event_id: r for r in parsed.collect()}
    assert got[1].ts == T("2024-01-01 10:00:00") == got[2].ts and got[2].value == 7.0
    assert got[3].ts is None and got[4].ts is None and got[7].sensor_id is None
    ok, bad = QU.split_complete(parsed)
    assert sorted(r.event_id for r in ok.collect()) == [1, 2, 5]
    assert sorted(r.event_id for r in bad.collect()) == [3, 4, 6, 7]
    ok2, _ = QU.split_complete(parsed, strict_text=True)       # alert gate: empty id rejected
    assert sorted(r.event_id for r in ok2.collect()) == [1, 2, 3, 4]


def test_fixture_roundtrip_through_wire_format(spark):
    direct = FX.readings(spark, SF).select("event_id", "sensor_id", "ts", "metric", "value")
    wire = parse_messages(FX.raw_messages(spark, SF)).select("event_id", "sensor_id", "ts", "metric", "value")
    assert direct.count() > FX.events(spark, SF).count() and direct.exceptAll(wire).count() == 0 and wire.exceptAll(direct).count() == 0


def test_metadata_has_one_spare_sensor_per_type(spark):
    meta = FX.sensor_metadata(spark, SF)
    seen = FX.readings(spark, SF).select("sensor_id").distinct()
    spare = meta.join(seen, "sensor_id", "left_anti").groupBy("type").count().collect()
    assert sorted((r.type, r["count"]) for r in spare) == [("air_quality", 1), ("noise", 1), ("traffic_loop", 1)]
    assert meta.filter("lat IS NULL").count() == meta.filter("CAST(substring_index(sensor_id, '-', -1) AS INT) % 7 = 0").count()
