import datetime as dt
import random

from helpers import T, readings_df, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from streetpulse.operators import windows as WI


def test_minute_table_wide_status_breaches(spark):
    df = readings_df(spark, [
        (1, "Loop-0001", T("2024-01-01 10:00:05"), "vehicle_count", 10.0),
        (2, "Loop-0001", T("2024-01-01 10:00:50"), "vehicle_count", 20.0),
        (3, "Loop-0001", T("2024-01-01 10:00:30"), "avg_speed", 70.0),
        (4, "Loop-0001", T("2024-01-01 10:01:00"), "wait_time_s", 9.0),
        (5, "Air-0001", T("2024-01-01 10:00:00"), "co", 9.0),
        (6, "Air-0001", T("2024-01-01 10:00:10"), "pm25", 3.0),
    ])
    a = {(r.sensor_id, r.window_start.minute): r for r in WI.aggregates_minute(df).collect()}
    r = a[("Loop-0001", 0)]
    assert r.vehicle_count_per_min == 15.0 and r.avg_speed_kmh == 70.0 and r.avg_wait_time_s is None
    assert r.status == "ALERT" and r.breaches == ["vehicle_count"]
    r = a[("Loop-0001", 1)]
    assert r.status == "WARN" and r.breaches == ["wait_time_s"]
    r = a[("Air-0001", 0)]
    assert r.pm25 == 3.0 and r.status == "ALERT" and r.breaches == ["co"]


def test_latest_and_newest_n(spark):
    df = readings_df(spark, [(i, "Loop-0001", T(f"2024-01-01 10:{i:02d}:00"), "avg_speed", float(i))
                             for i in range(30)])
    agg = WI.aggregates_minute(df)
    latest = WI.latest_per_sensor(agg).collect()
    assert len(latest) == 1 and latest[0].avg_speed_kmh == 29.0
    top = WI.newest_n(agg, 10).collect()
    assert sorted(r.rn for r in top) == list(range(1, 11))
    assert min(r.avg_speed_kmh for r in top) == 20.0


def test_last_readings_boundaries(spark):
    for n_rows, expect in ((19, 19), (20, 20), (21, 20)):
        df = readings_df(spark, [(i, "S-1", T("2024-01-01 00:00:00"), "avg_speed", float(i)) for i in range(n_rows)])
        got = WI.last_readings(df, 20)
        assert got.count() == expect
        # equal timestamps: ties broken by event_id (newest id first)
        assert min(r.event_id for r in got.collect()) == n_rows - expect


def test_last_readings_stats(spark):
    df = readings_df(spark, [(i, "Loop-0001", T(f"2024-01-01 00:{i:02d}:00"), "avg_speed" if i % 2 else "wait_time_s",
                              float(i)) for i in range(25)])
    s = {r.metric: r for r in WI.last_readings_stats(df, 20).collect()}
    assert s["avg_speed"]["count"] + s["wait_time_s"]["count"] == 20
    assert s["avg_speed"].window_size == 20
    assert s["avg_speed"].range_start == T("2024-01-01 00:05:00")


def test_spike_rule_needs_three_values(spark):
    base = [(1, "Loop-1", T("2024-01-01 00:00:00"), "vehicle_count", 1.0),
            (2, "Loop-1", T("2024-01-01 00:01:00"), "vehicle_count", 20.0)]
    assert WI.spikes(readings_df(spark, base)).count() == 0
    three = base + [(3, "Loop-1", T("2024-01-01 00:02:00"), "vehicle_count", 50.0)]
    got = WI.spikes(readings_df(spark, three)).collect()
    # mean of (1, 20, 50) = 23.67; 50 > 47.33
    assert [r.event_id for r in got] == [3]


def test_halo_buckets_equal_plain_window(spark):
    """Spike detection split into hour buckets with a halo equals the plain
    window over the whole history, also across empty and one-row buckets."""
    rnd = random.Random(7)
    data, eid = [], 0
    for sensor in ("Loop-1", "Loop-2"):
        t = 0
        for _ in range(400):
            t += rnd.choice([1, 2, 5, 30, 61, 200])
            data.append((eid, sensor, T("2024-01-01 00:00:00") + __import__("datetime").timedelta(minutes=t),
                         "vehicle_count", float(rnd.choice([1, 2, 3, 10, 40]))))
            eid += 1
    df = readings_df(spark, data)
    got = sorted(r.event_id for r in WI.spikes(df, bucket_unit="hour", hot_rows=100).collect())
    assert got == sorted(r.event_id for r in WI.spikes(df).collect())   # no key hot: one bucket
    w = Window.partitionBy("sensor_id", "metric").orderBy("ts", "event_id").rowsBetween(-2, 0)
    plain = (df.withColumn("n", F.count("value").over(w)).withColumn("a", F.avg("value").over(w))
             .filter((F.col("n") == 3) & (F.col("value") > 2 * F.col("a"))))
    assert got == sorted(r.event_id for r in plain.collect())
    assert len(got) > 10


def test_sliding_windows_cover_ten_minutes(spark):
    df = readings_df(spark, [(1, "Loop-1", T("2024-01-01 00:00:30"), "avg_speed", 10.0),
                             (2, "Loop-1", T("2024-01-01 00:05:00"), "avg_speed", 30.0)])
    w = {r.window_start: r for r in WI.sliding_windows(df).collect()}
    assert len(w) == 15
    assert w[T("2024-01-01 00:00:00")]["count"] == 2 and w[T("2024-01-01 00:00:00")].avg_value == 20.0


def test_retention_by_event_time(spark):
    df = readings_df(spark, [(1, "Loop-1", T("2024-01-01 00:00:00"), "avg_speed", 1.0),
                             (2, "Loop-1", T("2024-01-02 00:00:00"), "avg_speed", 1.0),
                             (3, "Loop-1", T("2024-01-02 12:00:00"), "avg_speed", 1.0)])
    kept = WI.retained(df, 24)
    assert sorted(r.window_start.day for r in kept.collect()) == [2, 2]


def test_newest_n_bucketed_equals_plain(spark):
    """Large budgets use per-day cut-offs; same rows and ranks as a plain window."""
    import datetime as dt
    rnd = random.Random(3)
    data, eid = [], 0
    for sensor in ("Loop-1", "Loop-2", "Loop-3"):
        t = T("2024-01-01 00:00:00")
        for _ in range(rnd.choice([900, 1500, 2600])):
            t += dt.timedelta(minutes=rnd.choice([1, 2, 7, 90]))
            data.append((eid, sensor, t, "avg_speed", 1.0))
            eid += 1
    agg = WI.aggregates_minute(readings_df(spark, data))
    for n in (1500, 2000):
        big = sorted(rows(WI.newest_n(agg, n), "sensor_id", "window_start", "rn"))
        w = Window.partitionBy("sensor_id").orderBy(F.col("window_start").desc())
        plain = sorted(rows(agg.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n),
                            "sensor_id", "window_start", "rn"))
        assert big == plain and len(big) > 3000


def test_running_buffer_split_equals_plain(spark):
    """Hot keys split into hour buckets with a 19-row halo give the same
    running statistics as one window over the whole history."""
    import datetime as dt
    rnd = random.Random(11)
    data, eid = [], 0
    for sensor in ("Loop-1", "Loop-2"):
        t = T("2024-01-01 00:00:00")
        for _ in range(600):
            t += dt.timedelta(minutes=rnd.choice([1, 3, 20, 70, 300]))
            data.append((eid, sensor, t, rnd.choice(["avg_speed", "vehicle_count", "wait_time_s"]),
                         float(rnd.randint(0, 90))))
            eid += 1
    df = readings_df(spark, data)
    cols = ["event_id", "buffer_size", "avg_speed_avg", "avg_speed_count", "vehicle_count_avg", "wait_time_s_count"]
    split = sorted(rows(WI.running_buffer_stats(df, 20, hot_rows=100), *cols))
    plain = sorted(rows(WI.running_buffer_stats(df, 20), *cols))
    assert split == plain and len(split) == 1200


def test_sliding_windows_are_expanded_behind_the_exchange(spark):
    start = T("2024-01-01 08:00:00")
    df = readings_df(spark, [(i, "Loop-0001", start + dt.timedelta(minutes=7 * i % 200, seconds=i % 50), "avg_speed", float(i))
                             for i in range(150)])
    for size, slide in ((10, 1), (90, 15)):
        got = WI.sliding_windows(df, f"{size} minutes", f"{slide} minutes")
        plan = got._jdf.queryExecution().executedPlan().toString()
        last = plan.index("Exchange")      # top down: the last exchange comes before the expansion
        assert "Generate explode(sequence(at" in plan[:last] and "REPARTITION_BY_COL" in plan[last:].split("\n")[0]
        want = {}
        for r in df.collect():
            first = (r.ts - start) // dt.timedelta(minutes=slide) * slide
            for back in range(0, size, slide):
                want.setdefault(start + dt.timedelta(minutes=first - back), []).append(r.value)
        assert {r.window_start: (r["count"], r.min_value, r.max_value, round(r.avg_value, 9)) for r in got.collect()} == {
            k: (len(v), min(v), max(v), round(sum(v) / len(v), 9)) for k, v in want.items()}
        assert got.count() == len(want)
