"""T1 and T3 as one stream: results, late rows, replays, one read of the source."""
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.sources.streams import json_file_stream, parse_messages
from streetpulse.streaming import chained as SC
from streetpulse.streaming import sinks as SK

MESSAGES = [
    [("Loop-0001", f"2024-01-01T10:0{m}:{s}Z", "avg_speed", 10.0 * m + i) for m in range(3)
     for i, s in enumerate(("10", "50"))]
    + [("Loop-0001", "2024-01-01T10:01:20Z", "vehicle_count", 7.0), ("Loop-0001", "2024-01-01T10:01:30Z", "odd", 4.0)],
    [("Loop-0001", "2024-01-01T10:30:00Z", "avg_speed", 30.0)],
    [("Loop-0001", "2024-01-01T10:30:20Z", "avg_speed", 30.0)],       # late rows are judged one batch later
    [("Loop-0001", "2024-01-01T10:01:30Z", "avg_speed", 99.0),        # behind the watermark
     ("Air-0002", "2024-01-01T11:00:00Z", "pm25", 5.0)],
]


def _source(base, batches):
    src = os.path.join(base, "in")
    os.makedirs(src, exist_ok=True)
    for batch in batches:
        with open(os.path.join(src, f"part-{len(os.listdir(src)):03d}.json"), "w") as fh:
            for sid, ts, metric, value in batch:
                fh.write(json.dumps({"sensor_id": sid, "ts": ts, "metric": metric, "value": value}) + "\n")
        time.sleep(1.1)  # file streams take files in modification-time order
    return src


def _start(spark, base, src):
    stream = parse_messages(json_file_stream(spark, src, max_files_per_trigger=1))
    q = SC.start_minutes_and_sliding(stream, schema.valid_ranges(spark), base + "/minutes", base + "/sliding",
                                     base + "/checkpoint")
    q.awaitTermination()
    return q


def _tables(spark, base):
    return (SK.read_versions(spark, base + "/minutes"), SK.read_versions(spark, base + "/sliding"))


def test_minutes_and_windows_from_one_query(spark):
    base = tempfile.mkdtemp(prefix="sp-chain-")
    q = _start(spark, base, _source(base, MESSAGES))
    minutes, sliding = _tables(spark, base)
    got = {(r.sensor_id, r.window_start.minute): r for r in minutes.collect()}
    assert minutes.count() == len(got) and sorted(got) == [("Loop-0001", m) for m in (0, 1, 2, 30)]
    assert [got["Loop-0001", m].avg_speed_kmh for m in (0, 1, 2, 30)] == [0.5, 10.5, 20.5, 30.0]
    assert got["Loop-0001", 1].vehicle_count_per_min == 7.0 and got["Loop-0001", 0].vehicle_count_per_min is None

    # Brute force over the readings that were in time.
    kept = [r for b in MESSAGES for r in b if r[3] != 99.0 and r[0] != "Air-0002"]
    want = {}
    for sid, ts, metric, value in kept:
        minute = int(ts[14:16])
        for start in range(minute - 9, minute + 1):
            want.setdefault((metric, start), []).append(value)
    base_minute = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ'2024-01-01 10:00:00', window_start)")
    rows = sliding.withColumn("at", base_minute).collect()
    assert len(rows) == len(want)
    for r in rows:
        values = want[r.metric, r.at]
        assert (r["count"], r["min_value"], r["max_value"]) == (len(values), min(values), max(values))
        assert abs(r["avg_value"] - sum(values) / len(values)) < 1e-9

    # One read of the source and two stateful operators; the late row is counted by the first one only.
    progress = [p for p in q.recentProgress if p["stateOperators"]]
    assert all(len(p["sources"]) == 1 and len(p["stateOperators"]) == 2 for p in progress)
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) == 1


def test_restart_carries_both_states(spark):
    base = tempfile.mkdtemp(prefix="sp-chain-")
    src = _source(base, MESSAGES[:1])
    _start(spark, base, src)
    _source(base, MESSAGES[1:])
    _start(spark, base, src)
    once = tempfile.mkdtemp(prefix="sp-chain-")
    _start(spark, once, _source(once, MESSAGES))
    for a, b in zip(_tables(spark, base), _tables(spark, once)):
        a, b = (x.drop(*SK.VERSION).withColumn("x", F.lit(1)) for x in (a, b))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_nothing_closed_gives_no_rows(spark):
    base = tempfile.mkdtemp(prefix="sp-chain-")
    _start(spark, base, _source(base, [[("Loop-0001", "2024-01-01T10:00:10Z", "avg_speed", 1.0)]]))
    minutes, sliding = _tables(spark, base)
    assert minutes.count() == 0 and sliding.count() == 0


def test_windows_keep_no_time_beside_the_minute_they_end_with(spark):
    """One row of state per window: what is kept is shuffled and written for each of a minute's ten windows."""
    base = tempfile.mkdtemp(prefix="sp-chain-")
    stream = parse_messages(json_file_stream(spark, _source(base, MESSAGES[:1])))
    windows = SC.sliding_partials(SC.minute_partials(stream, schema.valid_ranges(spark)))
    kept = [c for c in windows.columns if c not in ("sensor_id", "metric", "w")]
    assert kept == ["total", "count", "min_value", "max_value", "last_total", "last_n"]


def test_sliding_state_follows_the_batches_not_the_table(spark, monkeypatch):
    """Before, all events were one micro-batch, whose windows were all kept until its end."""
    from conftest import SF
    from pyspark.sql.streaming import DataStreamWriter
    from streetpulse.plans import catalog as C
    queries, start = [], DataStreamWriter.start

    def noted(self, *args, **kw):
        queries.append(start(self, *args, **kw))
        return queries[-1]
    monkeypatch.setattr(DataStreamWriter, "start", noted)

    def rows():
        return sorted((r.sensor_id, r.metric, r.window_start, round(r.avg_value, 9), r.min_value, r.max_value, r["count"])
                      for r in C.QUERIES["T3_stream"](spark, SF).collect())
    whole = rows()
    monkeypatch.setattr(C, "EVENTS_PER_BATCH", C.FX.events(spark, SF).count() // 5)
    assert whole and rows() == whole
    most = [max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) for q in queries]
    assert most[1] < 0.75 * most[0]


def _count_stateful_rows(spark, monkeypatch, name, sf):
    """State rows over all operators and micro-batches of the query's stream at their most."""
    from pyspark.sql.streaming import DataStreamWriter
    from streetpulse.plans import catalog as C
    queries, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: (queries.append(start(self, *a, **k)), queries[-1])[1])
    rows = C.QUERIES[name](spark, sf).count()
    return rows, max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in queries[0].recentProgress if p["stateOperators"])


def test_state_has_a_row_per_minute_not_per_window(spark, monkeypatch):
    """Before, a reading had a row of state in each of its ten windows."""
    from conftest import SF
    for name in ("T3_stream", "T3_chained"):
        rows, state = _count_stateful_rows(spark, monkeypatch, name, SF)
        assert rows > 1000 and state < rows / 5
        monkeypatch.undo()


def test_late_reading_counts_in_windows_still_open(spark):
    """T3 alone: a reading behind its minute, but not behind all windows that hold it."""
    base = tempfile.mkdtemp(prefix="sp-slide-")
    at = "2024-01-01T10:{}Z".format
    batches = [[("Loop-0001", at("00:10"), "avg_speed", 1.0)], [("Loop-0001", at("06:00"), "avg_speed", 2.0)],
               [("Loop-0001", at("06:10"), "avg_speed", 4.0)],
               [("Loop-0001", at("02:30"), "avg_speed", 8.0)],      # windows to 10:05 are closed
               [("Loop-0001", at("30:00"), "avg_speed", 16.0)]]
    stream = parse_messages(json_file_stream(spark, _source(base, batches), max_files_per_trigger=1))
    SC.start_sliding(stream, schema.valid_ranges(spark), base + "/t", base + "/c").awaitTermination()
    got = {r.window_end.minute: (r["count"], r.min_value, r.max_value) for r in SK.read_versions(spark, base + "/t").collect()}
    want = {m: (1, 1.0, 1.0) for m in range(1, 6)} | {6: (2, 1.0, 8.0)} | {m: (4, 1.0, 8.0) for m in range(7, 11)} \
        | {m: (3, 2.0, 8.0) for m in (11, 12)} | {m: (2, 2.0, 4.0) for m in range(13, 17)}
    assert got == want


def test_each_micro_batch_is_one_slice(spark, monkeypatch, tmp_path):
    """Slices of few or equal times: a file of a later slice in a batch would make the rest of it late."""
    from streetpulse.plans import catalog as C
    ev = spark.range(40).selectExpr("id AS event_id", "CAST(timestamp_seconds(1704067200 + IF(id < 30, 60, 600 * id)) AS TIMESTAMP_NTZ) AS ts",
                                    "id AS user_id", "'view' AS event_type", "1.0D AS value", "'' AS props")
    ev.write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    stream = C.time_ordered_stream(spark, str(tmp_path), 6)
    q = (stream.writeStream.foreachBatch(lambda df, i: seen.append(df.agg(F.min("ts"), F.max("ts")).first()))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    spans = [tuple(s) for s in seen if s[0] is not None]
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_batches_apart_in_time_are_read_without_ranking(spark, tmp_path):
    def put(batch, query, *minutes):
        rows = spark.createDataFrame([("s", m, float(batch)) for m in minutes], "sensor_id string, m int, v double").selectExpr(
            "sensor_id", "CAST(timestamp_seconds(60 * m) AS TIMESTAMP_NTZ) AS window_start", "v", "timestamp_seconds(%d) AS written_at" % batch)
        rows.write.parquet(f"{tmp_path}/t/query={query}/batch_id={batch}")

    def read(**more):
        return SK.read_upserted(spark, f"{tmp_path}/t", **more)
    put(0, "a", 1, 2, 3)
    put(1, "a", 4, 5)
    assert "Window" not in read(time="window_start")._jdf.queryExecution().optimizedPlan().toString()
    put(2, "b", 5, 9)
    put(3, "b", 20, None)
    put(4, "b", None)
    for rows in (read(), read(time="window_start")):
        assert sorted((r.v for r in rows.collect())) == [0.0, 0.0, 0.0, 1.0, 2.0, 2.0, 3.0, 4.0]
