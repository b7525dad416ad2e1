"""Streaming minute table (T1, T2, T5) with processing counters.

readings stream -> completeness (S2) -> range validation (P1, stream-static
broadcast join with the fixed range table) -> watermark -> one aggregation
per (sensor, 1-minute event-time window) with the wide means, status and
breaches (P9, B1) -> versioned sink (S4).

* append mode (T1): a window is emitted once, when the watermark (newest
  event time - grace) passes its end; later readings for it are dropped and
  counted (``numRowsDroppedByWatermark``).
* update mode (T2): changed windows are emitted again each micro-batch and the
  upsert view keeps the newest version, so a late reading updates its minute.
State is evicted by the watermark, so it stays bounded (T5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import split_complete, validate
from ..operators.windows import aggregates_minute, micros
from .day_table import DayTable
from .sinks import write_batch


def event_time(readings: DataFrame) -> DataFrame:
    """Stream form of readings: ``ts`` as TIMESTAMP (watermarks need it)."""
    return readings.withColumn("ts", F.col("ts").cast("timestamp"))


AHEAD = "1 hour"  # event times further ahead of the clock than this are quarantined


def _checked(readings: DataFrame, ranges: DataFrame) -> DataFrame:
    """Complete readings with their validity. Only valid readings may move a
    watermark: one reading from the far future would close all windows."""
    complete, _ = split_complete(event_time(readings))
    checked = validate(complete, ranges)
    ahead = F.col("ts") > F.current_timestamp() + F.expr(f"INTERVAL {AHEAD}")
    return checked.withColumn("is_valid", F.col("is_valid") & ~ahead)


def valid_stream(readings: DataFrame, ranges: DataFrame, grace: str = "1 minute") -> DataFrame:
    """Valid readings under a watermark of ``grace``."""
    return (_checked(readings, ranges).filter("is_valid").select("sensor_id", "ts", "metric", "value")
            .withWatermark("ts", grace))


def minute_stream(readings: DataFrame, ranges: DataFrame, grace: str = "1 minute", limits=None,
                  observe: bool = True) -> DataFrame:
    checked = _checked(readings, ranges)
    if observe:
        checked = checked.observe("counters", F.count_if("is_valid").alias("messages_processed"),
                                  F.count_if(~F.col("is_valid")).alias("validation_errors"))
    valid = checked.filter("is_valid").select("sensor_id", "ts", "metric", "value").withWatermark("ts", grace)
    return aggregates_minute(valid, limits, event_time_window=True)


def start_minute_table(readings: DataFrame, ranges: DataFrame, table_path: str, checkpoint: str,
                       mode: str = "append", grace: str = "1 minute", trigger: dict | None = None,
                       name: str | None = None):
    """Run T1 (append) or T2 (update) into the versioned table at ``table_path``."""
    agg = minute_stream(readings, ranges, grace)

    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(df, table_path, batch_id)

    w = (agg.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return w.start()


def minute_day_table(spark, path: str) -> DayTable:
    """D3 as a day table: the row written last per sensor and minute."""
    return DayTable(spark, path, ["sensor_id", "window_start"], "window_start")


def start_minute_days(readings: DataFrame, ranges: DataFrame, table: DayTable, checkpoint: str, mode: str = "update",
                      grace: str = "1 minute", trigger: dict | None = None, on_batch=None):
    """T2 (or T1) into a day table. ``on_batch(rows, batch_id)`` runs after each
    append: maintained views, folds."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()       # the batch's state is read once
        try:
            table.append(df, batch_id)
            if on_batch:
                on_batch(df, batch_id)
        finally:
            df.unpersist()

    return (minute_stream(readings, ranges, grace).writeStream.outputMode(mode).foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def dropped_late_rows(query) -> int:
    """Rows dropped as too late over the query's recent progress (T2, append)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else []:
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total


def sliding_stream(readings: DataFrame, ranges: DataFrame, size: str = "10 minutes", slide: str = "1 minute",
                   grace: str = "1 minute") -> DataFrame:
    """T3 stream form: sum, count, least and greatest value per sensor, metric
    and slide, for an update-mode sink that makes the windows (``start_sliding``
    of ``chained``). A slide stays open until the watermark (newest event time -
    grace) closes the last window that holds it."""
    held = micros(grace) + micros(size) - micros(slide)
    valid = _checked(readings, ranges).filter("is_valid").withWatermark("ts", f"{held} microseconds")
    return (valid.groupBy("sensor_id", "metric", F.window("ts", slide).alias("minute"))
            .agg(F.sum("value").alias("total"), F.count("*").alias("n"),
                 F.min("value").alias("least"), F.max("value").alias("most")))
