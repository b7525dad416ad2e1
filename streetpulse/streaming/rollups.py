"""Hour rollups of the minute table, maintained as it changes.

One row per (sensor, hour): sum and count of the minutes' value of each measure.
A micro-batch that changes minutes recomputes the (sensor, hour) buckets it
touches, from the minute table's files of those days only, and appends them as
new versions; all other buckets stay. Hour, day and hour-of-day charts are sums
over these rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import time_floor
from ..operators.dashboards import bucket_label, bucket_start
from ..operators.windows import MEASURES
from .day_table import DayTable


def hour_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, ["sensor_id", "bucket_start"], "bucket_start")


def hour_rows(minutes: DataFrame) -> DataFrame:
    """sum_<measure> and n_<measure> per sensor and hour."""
    return minutes.groupBy("sensor_id", time_floor("window_start", "hour").alias("bucket_start")).agg(
        *[F.coalesce(F.sum(m), F.lit(0.0)).alias(f"sum_{m}") for m in MEASURES], *[F.count(m).alias(f"n_{m}") for m in MEASURES])


def refresh_hours(minutes: DayTable, hours: DayTable, changed: DataFrame, batch_id: int) -> list[str]:
    """Recomputes the hours of the changed minutes; returns the days read."""
    touched = changed.select("sensor_id", time_floor("window_start", "hour").alias("_hour")).distinct()
    days = [str(r[0]) for r in touched.select(F.to_date("_hour")).distinct().collect()]   # the days of one batch
    held = minutes.read(days=days).withColumn("_hour", time_floor("window_start", "hour"))
    hours.append(hour_rows(held.join(touched, ["sensor_id", "_hour"], "left_semi")), batch_id)
    return sorted(days)


def _of_types(hours: DataFrame, meta: DataFrame) -> DataFrame:
    return hours.join(meta.select("sensor_id", "type"), "sensor_id")


def vehicle_rollup(hours: DataFrame, meta: DataFrame, sensor_type: str, granularity: str = "1hour", period: str = "1week") -> DataFrame:
    """A13 from the hour rows; granularity is an hour or a day."""
    if granularity not in ("1hour", "1day"):
        raise ValueError(f"hour rows cannot give {granularity}")
    own = _of_types(hours, meta).where(F.col("type") == sensor_type)
    g = own.groupBy(bucket_start("bucket_start", granularity).alias("bucket_start")).agg(
        F.sum("sum_vehicle_count_per_min").alias("total"), F.sum("n_vehicle_count_per_min").alias("n")).where("n > 0")
    return g.select("bucket_start", (F.col("total") / F.col("n")).alias("avg_vehicles"), "n",
                    bucket_label(F.col("bucket_start"), granularity, period).alias("label"))


def hour_profiles(hours: DataFrame, meta: DataFrame, profiles) -> DataFrame:
    """A14 from the hour rows."""
    typed = _of_types(hours, meta)
    g = typed.groupBy(F.hour("bucket_start").alias("hour")).agg(
        *[F.sum(F.when(F.col("type") == t, F.col(f"{c}_{m}"))).alias(f"{c}_{m}") for t, m in profiles for c in ("sum", "n")])
    each = ", ".join(f"'{m}', sum_{m} / n_{m}, n_{m}" for _, m in profiles)
    return (g.selectExpr("hour", f"stack({len(profiles)}, {each}) AS (profile, avg_value, n)").where("n > 0")
            .withColumn("label", F.format_string("%02d:00", F.col("hour"))))
