import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.sources.streams import json_file_stream, parse_messages
from streetpulse.streaming import minutes as SM
from streetpulse.streaming import sinks as SK


def _write_files(folder, batches):
    for i, batch in enumerate(batches):
        with open(os.path.join(folder, f"part-{i:03d}.json"), "w") as fh:
            for sid, ts, metric, value in batch:
                fh.write(json.dumps({"sensor_id": sid, "ts": ts, "metric": metric, "value": value}) + "\n")
        time.sleep(1.1)  # file streams take files in modification-time order


BATCHES = [
    [("Loop-0001", f"2024-01-01T10:0{m}:10Z", "avg_speed", 10.0 * (m + 1)) for m in range(6)],
    [("Loop-0001", "2024-01-01T10:10:00Z", "avg_speed", 30.0)],
    [("Loop-0001", "2024-01-01T10:09:30+00:00", "avg_speed", 40.0),   # late, within the grace
     ("Loop-0001", "2024-01-01T10:02:00Z", "avg_speed", 50.0)],        # later than the watermark
]


def _run(spark, mode):
    base = tempfile.mkdtemp(prefix="sp-stream-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    _write_files(src, BATCHES)
    stream = parse_messages(json_file_stream(spark, src, max_files_per_trigger=1))
    q = SM.start_minute_table(stream, schema.valid_ranges(spark), base + "/table", base + "/ckpt", mode=mode)
    q.awaitTermination()
    got = {r.window_start.minute: r.avg_speed_kmh for r in SK.read_upserted(spark, base + "/table").collect()}
    return got, q


def test_update_mode_versions_and_late_rows(spark):
    got, q = _run(spark, "update")
    assert got[9] == 40.0            # late reading within the grace updated its minute
    assert got[2] == 30.0            # reading beyond the watermark did not change it
    assert got[10] == 30.0           # the open window is emitted in update mode
    assert SM.dropped_late_rows(q) >= 1


def test_append_mode_emits_closed_windows_once(spark):
    got, q = _run(spark, "append")
    assert sorted(got) == [0, 1, 2, 3, 4, 5]   # 10:09 and 10:10 are still open
    assert got[2] == 30.0
    assert SM.dropped_late_rows(q) >= 1


def test_replayed_batch_adds_no_duplicates(spark):
    base = tempfile.mkdtemp(prefix="sp-sink-")
    df = spark.createDataFrame([("Loop-1", 1.0)], "sensor_id string, v double") \
        .withColumn("window_start", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    SK.write_batch(df, base, 3)
    SK.write_batch(df.withColumn("v", F.lit(2.0)), base, 3)   # replay of batch 3
    SK.write_batch(df.withColumn("v", F.lit(5.0)), base, 4)
    assert SK.read_versions(spark, base).count() == 2
    assert [r.v for r in SK.read_upserted(spark, base).collect()] == [5.0]


def test_observed_counters_in_progress(spark):
    base = tempfile.mkdtemp(prefix="sp-obs-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    _write_files(src, [[("Loop-0001", "2024-01-01T10:00:00Z", "avg_speed", 500.0),
                        ("Loop-0001", "2024-01-01T10:00:05Z", "avg_speed", 50.0),
                        ("Loop-0001", "2024-01-01T10:00:06Z", "queue_len", 5.0)]])
    stream = parse_messages(json_file_stream(spark, src))
    q = SM.start_minute_table(stream, schema.valid_ranges(spark), base + "/t", base + "/c", mode="update")
    q.awaitTermination()
    seen = [p["observedMetrics"]["counters"] for p in q.recentProgress
            if p.get("observedMetrics", {}).get("counters") and p["numInputRows"] > 0]
    assert seen and seen[0]["messages_processed"] == 2 and seen[0]["validation_errors"] == 1


def test_restart_from_checkpoint_processes_only_new_files(spark):
    base = tempfile.mkdtemp(prefix="sp-restart-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    _write_files(src, BATCHES[:1])

    def run():
        stream = parse_messages(json_file_stream(spark, src))
        q = SM.start_minute_table(stream, schema.valid_ranges(spark), base + "/t", base + "/c", mode="update")
        q.awaitTermination()

    run()
    first = SK.read_versions(spark, base + "/t").count()
    run()                                     # restart, nothing new: no new versions
    assert SK.read_versions(spark, base + "/t").count() == first
    with open(os.path.join(src, "part-new.json"), "w") as fh:
        fh.write(json.dumps({"sensor_id": "Loop-0001", "ts": "2024-01-01T10:05:40Z", "metric": "avg_speed",
                             "value": 0.0}) + "\n")
    run()                                     # restart with one new file: only its minute changes
    view = {r.window_start.minute: r.avg_speed_kmh for r in SK.read_upserted(spark, base + "/t").collect()}
    assert len(view) == 6 and view[5] == 30.0 and view[0] == 10.0


def test_new_checkpoint_loses_nothing(spark, tmp_path):
    """Batches of a job with a new checkpoint start at 0 again; older folders stay."""
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema_ = "sensor_id string, window_start timestamp, v double"
    for i in range(2):
        df = spark.createDataFrame([(f"s{i}", None, float(i))], schema_)
        df.write.mode("append").parquet(src)
        (spark.readStream.schema(df.schema).parquet(src).writeStream.foreachBatch(lambda b, n: SK.write_batch(b, out, n))
         .option("checkpointLocation", str(tmp_path / f"ckpt{i}")).trigger(availableNow=True).start().awaitTermination())
    assert SK.read_versions(spark, out).count() == 3              # the first row was read by both jobs
    newest = SK.newest_versions(SK.read_versions(spark, out), ("sensor_id",))
    assert sorted((r.sensor_id, r.v) for r in newest.collect()) == [("s0", 0.0), ("s1", 1.0)]


def test_a_reading_from_the_future_moves_no_watermark(spark, tmp_path):
    from streetpulse import schema
    from streetpulse.streaming import minutes as SM
    src, base = str(tmp_path / "src"), str(tmp_path / "base")
    cols = "event_id long, sensor_id string, ts timestamp, metric string, value double"
    batches = [[(1, "Loop-0001", "2024-01-01 00:00:10", 50.0), (2, "Loop-0001", "2999-01-01 00:00:00", 50.0),
                (3, "Loop-0001", "2024-03-01 00:00:00", 1e15), (4, "Loop-0001", "2024-03-01 00:00:00", float("nan"))],
               [(5, "Loop-0002", "2024-01-01 00:00:40", 60.0)], [(6, "Loop-0002", "2024-01-01 00:10:00", 60.0)]]
    for rows in batches:
        spark.createDataFrame([(i, s, v) + (t,) for i, s, t, v in rows], "event_id long, sensor_id string, value double, t string") \
            .selectExpr("event_id", "sensor_id", "CAST(t AS TIMESTAMP) AS ts", "'avg_speed' AS metric", "value") \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(cols).option("maxFilesPerTrigger", 1).parquet(src)
    SM.start_minute_table(stream, schema.valid_ranges(spark), base + "/t", base + "/c").awaitTermination()
    got = SK.read_upserted(spark, base + "/t").collect()
    assert sorted(r.sensor_id for r in got) == ["Loop-0001", "Loop-0002"]


def test_clear_and_resolve_stored_tables(spark, tmp_path):
    path = str(tmp_path / "alerts")
    df = spark.createDataFrame([("a", False), ("b", False)], "alert_id string, resolved boolean")
    SK.write_batch(df, path, 0)
    SK.resolve_in_table(spark, path, df.filter("alert_id = 'a'").select("alert_id"), path + "-new")
    assert {(r.alert_id, r.resolved) for r in spark.read.parquet(path + "-new").collect()} == {("a", True), ("b", False)}
    SK.clear_table(spark, path + "-new", "alert_id string, resolved boolean")
    assert spark.read.parquet(path + "-new").count() == 0
