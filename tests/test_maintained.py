"""Late partials, the side table and hour rollups against batch results."""

import os

from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.operators.windows import aggregates_minute
from streetpulse.streaming import minutes as SM
from streetpulse.streaming import partials as SP
from streetpulse.streaming import rollups as SR

COLUMNS = "event_id long, sensor_id string, ts timestamp, metric string, value double"


def write(spark, src, batches):
    for rows in batches:
        spark.createDataFrame([(i, s, t, v) for i, (s, t, v) in enumerate(rows)], "event_id long, sensor_id string, t string, value double") \
            .selectExpr("event_id", "sensor_id", "CAST(t AS TIMESTAMP) AS ts", "'avg_speed' AS metric", "value") \
            .coalesce(1).write.mode("append").parquet(src)


def stream(spark, src):
    return spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(src)


BATCHES = [[("Loop-1", f"2024-01-01 10:0{m}:10", 10.0 * (m + 1)) for m in range(6)],
           [("Loop-1", "2024-01-02 09:00:00", 30.0), ("Loop-1", "2024-01-01 10:05:50", 20.0)],   # within the grace
           [("Loop-1", "2024-01-01 10:02:00", 50.0), ("Loop-2", "2024-01-01 08:00:00", 7.0),     # far behind
            ("Loop-1", "2024-01-02 09:00:30", 50.0)]]


def speeds(df):
    return {(r.sensor_id, str(r.window_start)[5:16]): r.avg_speed_kmh for r in df.collect()}


def test_late_partials_wait_in_the_side_table_until_reconciled(spark, tmp_path):
    src = str(tmp_path / "src")
    write(spark, src, BATCHES)
    late = SP.LateMinutes(spark, str(tmp_path / "t"))
    late.start(stream(spark, src), schema.valid_ranges(spark), str(tmp_path / "c")).awaitTermination()
    before = speeds(late.minutes())
    assert before[("Loop-1", "01-01 10:02")] == 30.0 and ("Loop-2", "01-01 08:00") not in before
    assert before[("Loop-1", "01-01 10:05")] == 40.0 and before[("Loop-1", "01-02 09:00")] == 40.0
    side = {(r.sensor_id, str(r.window_start)[11:16]): (r.total, r.n) for r in late.late.read().collect()}
    assert side == {("Loop-1", "10:02"): (50.0, 1), ("Loop-2", "08:00"): (7.0, 1)}
    assert late.reconcile() >= 1 and late.reconcile() == 0
    batch = spark.read.schema(COLUMNS).parquet(src).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    whole = {tuple(r) for r in aggregates_minute(batch).withColumn("breaches", F.array_join("breaches", ",")).collect()}
    assert {tuple(r) for r in late.minutes().withColumn("breaches", F.array_join("breaches", ",")).collect()} == whole
    late.partials.fold()
    assert speeds(late.minutes())[("Loop-1", "01-01 10:02")] == 40.0


def test_a_replayed_batch_and_a_repeated_reconciliation_change_nothing(spark, tmp_path):
    late = SP.LateMinutes(spark, str(tmp_path / "t"))

    def batch(rows):
        return spark.createDataFrame(rows, "sensor_id string, t string, value double").selectExpr(
            "sensor_id", "CAST(t AS TIMESTAMP) AS ts", "'avg_speed' AS metric", "value")
    for i, rows in enumerate(BATCHES):
        for _ in range(2):
            late.take(batch(rows), i, "1 minute")
    late.reconcile()
    first = speeds(late.minutes())
    late.take(batch(BATCHES[2]), 2, "1 minute")
    late.reconcile()
    late.partials.fold()
    late.take(batch(BATCHES[2]), 2, "1 minute")
    assert speeds(late.minutes()) == first and first[("Loop-1", "01-01 10:02")] == 40.0


def test_only_touched_hours_are_recomputed(spark, tmp_path):
    src = str(tmp_path / "src")
    table = SM.minute_day_table(spark, str(tmp_path / "minutes"))
    hours = SR.hour_table(spark, str(tmp_path / "hours"))
    read = []

    def on_batch(df, batch_id):
        read.append(SR.refresh_hours(table, hours, df, batch_id))
        table.fold()
        hours.fold()

    def run():
        SM.start_minute_days(stream(spark, src), schema.valid_ranges(spark), table, str(tmp_path / "c"),
                             on_batch=on_batch, grace="3 days").awaitTermination()
    write(spark, src, BATCHES[:2])
    run()
    data = str(tmp_path / "hours/data")
    before = {os.path.join(d, f) for d, _, names in os.walk(data) for f in names if f.endswith(".parquet")}
    write(spark, src, [[("Loop-1", "2024-01-02 09:00:30", 50.0)]])
    run()
    new = {os.path.join(d, f) for d, _, names in os.walk(data) for f in names if f.endswith(".parquet")} - before
    assert [d for d in read if d][-1] == ["2024-01-02"] and new and all("day=2024-01-02" in f for f in new)
    got = {(r.sensor_id, str(r.bucket_start)[5:13]): (r.sum_avg_speed_kmh, r.n_avg_speed_kmh) for r in hours.read().collect()}
    want = {(r.sensor_id, str(r.bucket_start)[5:13]): (r.sum_avg_speed_kmh, r.n_avg_speed_kmh)
            for r in SR.hour_rows(table.read()).collect()}
    assert got == want and got[("Loop-1", "01-02 09")] == (40.0, 1)
