"""Streaming alerts (T7) into the alert table and topic (S5), and the
critical notification feed (T9).

Alerting is stateless per reading: a stream-static join with the fixed limit
table (broadcast), no shuffle, so it scales with the input partitions. Alert
ids are a hash of the reading (R19), so a replayed micro-batch rewrites the
same rows into the same ``batch_id`` folder: each alert is stored once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.alerts import alerts_from_readings, notification_text
from .day_table import DayTable
from .sinks import write_alerts_and_messages


def alert_table(spark: SparkSession, path: str) -> DayTable:
    """D4 as a day table: one row an alert id; resolving an alert marks its id
    (S8), which is merged on read and folded in later."""
    return DayTable(spark, path, ["alert_id"], "timestamp", mark="resolved")


def alert_stream(readings: DataFrame, limits: DataFrame) -> DataFrame:
    return alerts_from_readings(readings, limits)


def critical_feed_stream(alerts: DataFrame, redelivery: str = "24 hours") -> DataFrame:
    """T9 stream form: each critical alert once, with its short text."""
    return notification_text(once_each(alerts.filter("severity = 'critical'"), redelivery))


def once_each(alerts: DataFrame, redelivery: str = "24 hours") -> DataFrame:
    """Each alert id once, however often its message is delivered within
    ``redelivery``: ids are kept as state until the watermark passes them. An
    alert without a time has no such state and may come again."""
    timed = alerts.withColumn("_at", F.col("timestamp").cast("timestamp")).withWatermark("_at", redelivery)
    return timed.dropDuplicatesWithinWatermark(["alert_id"]).drop("_at")


def start_alerts(readings: DataFrame, limits: DataFrame, alerts_path, messages_path: str,
                 checkpoint: str, trigger: dict | None = None):
    def sink(df: DataFrame, batch_id: int) -> None:
        write_alerts_and_messages(df, alerts_path, messages_path, batch_id)

    return (alert_stream(readings, limits).writeStream.outputMode("append").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
