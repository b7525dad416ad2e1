"""Two-phase scans against the windows over whole histories."""

import datetime as dt
import random

import pytest
from helpers import readings_df
from pyspark.sql import functions as F

from streetpulse.operators import quality as QU
from streetpulse.operators import windows as WI

START = dt.datetime(2024, 1, 1)


def made(seed, n=600, sensors=4):
    rng = random.Random(seed)
    return [(i, f"Loop-{rng.randrange(sensors)}", START + dt.timedelta(seconds=rng.choice([rng.randrange(90_000), 77, 3600])),
             rng.choice(["avg_speed", "wait_time_s"]), rng.choice([1.0, 2.0, 9.0, 0.0, -3.0])) for i in range(n)]


def plain(rows):
    out, seen = [], {}
    for i, sensor, ts, metric, value in sorted(rows, key=lambda r: (r[2], r[0])):
        last = seen.setdefault((sensor, metric), [])
        last.append(value)
        if len(last) >= 3 and value > (last[-3] + last[-2] + last[-1]) / 3.0 * 2:
            out.append((i, (last[-3] + last[-2] + last[-1]) / 3.0))
    return sorted(out)


@pytest.mark.parametrize("seed, unit", [(1, "minute"), (2, "hour"), (3, "day")])
def test_spikes_of_the_scan_are_those_of_the_whole_history(spark, seed, unit):
    rows = made(seed)
    got = WI.spikes_scanned(readings_df(spark, rows), unit)
    assert sorted((r.event_id, r.recent_avg) for r in got.collect()) == plain(rows)


def test_counters_in_one_scan(spark):
    rows = made(4)
    df = readings_df(spark, rows).withColumn("is_valid", F.col("event_id") % 5 != 0)
    valid = [r for r in rows if r[0] % 5]
    got = WI.counters_scanned(df).first().asDict()
    assert got == {"messages_processed": len(valid), "validation_errors": len(rows) - len(valid), "anomalies_detected": len(plain(valid))}
    old = QU.processing_counters(df, WI.spikes(df.where("is_valid"))).first().asDict()
    assert got == old
    assert list(WI.counters_scanned(df.limit(0)).first()) == [0, 0, 0]


def test_the_readings_are_read_once_and_a_hot_key_is_spread(spark, tmp_path):
    readings_df(spark, [(i, "Loop-0", START + dt.timedelta(seconds=i), "avg_speed", float(i % 7)) for i in range(5000)]) \
        .write.parquet(str(tmp_path / "r"))
    limit = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = WI.spikes_scanned(spark.read.parquet(str(tmp_path / "r")))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "ReusedExchange" in plan
        assert df.count() == len(plain([(i, "x", START + dt.timedelta(seconds=i), "m", float(i % 7)) for i in range(5000)]))
        s = WI.segments(spark.read.parquet(str(tmp_path / "r")), ["sensor_id", "metric"], ["ts", "event_id"],
                        WI.time_floor("ts", "minute"), 2, ["value"])
        assert s.agg(F.max(F.size("rows")), F.max(F.size("before"))).first() == (60, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", limit)
