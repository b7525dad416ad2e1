"""Sliding windows (T3) from minute partials, and T1 and T3 from one stream.

A reading lies in ten windows. No state keeps a row per window: Spark's state has
one partial per sensor, metric and minute, and the windows are made from partials
in the sink, once, in the micro-batch whose watermark closes them. What later
windows still need, the partials of the last minutes, goes on as a folder of
``OpenMinutes``. A micro-batch's watermark is read from the checkpoint's offset
log, which is written before the batch runs, so a replayed batch has the same one,
reads the same folder of the batch before and rewrites its own.

``start_minutes_and_sliding`` chains two stateful operators: readings ->
watermark -> (sensor, metric, minute) partials -> (sensor, minute) rows of all
metrics. Both close on the same watermark, so all metrics of a sensor's minute
arrive in one micro-batch: the minute row (T1) is a projection of that row, and
the windows (T3) are made from its partials. The readings are read, checked and
grouped once; both tables come from one query, one checkpoint and one state.
Chains run in append mode only; minutes that are emitted again (T2) need the
stream of ``minutes``.

``start_sliding`` is T3 alone. Its partials stay open until the last window that
holds them closes, so a late reading counts in the windows that are still open.

Defined cases: unknown metrics have sliding windows and no column in a minute
row; readings behind the watermark are dropped and counted by the first
operator (in the chain: behind their minute); a replayed micro-batch rewrites its
own folders.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import dealt_windows, micros, minute_metrics, minute_rows, slide_number, slide_start
from ..session import started_with, state_partitions
from .day_table import _Files
from .minutes import sliding_stream, valid_stream
from .sinks import batch_path, write_batch

SLIDING_KEYS = ("sensor_id", "metric", "window_start")
PARTIAL_KEYS = ["sensor_id", "metric", "minute"]
PARTIAL = ["metric", "total", "n", "least", "most"]


def minute_partials(readings: DataFrame, ranges: DataFrame, grace: str = "1 minute") -> DataFrame:
    """First operator: sum, count, least and greatest value per (sensor, metric, minute)."""
    valid = valid_stream(readings, ranges, grace)
    return valid.groupBy("sensor_id", "metric", F.window("ts", "1 minute").alias("minute")).agg(
        F.sum("value").alias("total"), F.count("*").alias("n"),
        F.min("value").alias("least"), F.max("value").alias("most"))


def sensor_minutes(minutes: DataFrame) -> DataFrame:
    """Second operator: a sensor's minute, the partials of all its metrics in ``parts``."""
    return minutes.groupBy("sensor_id", "minute").agg(F.collect_list(F.struct(*PARTIAL)).alias("parts"))


def sliding_partials(minutes: DataFrame, size: str = "10 minutes", slide: str = "1 minute", closing=None) -> DataFrame:
    """The sliding windows of partials, with the total and count of the minute
    they end with (``last_*``, null without one). ``closing``: which windows, as
    a condition on their end (microseconds); others are not made."""
    wide = dealt_windows(minutes.withColumn("at", slide_number(F.col("minute")["start"], slide)), size, slide)
    end = F.col("first") * micros(slide) + micros(size)
    if closing is not None:
        wide = wide.where(closing(end))
    own = (F.col("at") + 1) * micros(slide) == end
    windows = (wide.groupBy("sensor_id", "metric", "block", "first")
               .agg(F.sum("total").alias("total"), F.sum("n").alias("count"),
                    F.min("least").alias("min_value"), F.max("most").alias("max_value"),
                    F.max(F.when(own, F.col("total"))).alias("last_total"),
                    F.max(F.when(own, F.col("n"))).alias("last_n")))
    start = slide_start(F.col("first"), slide)
    return windows.select("sensor_id", "metric", F.struct(start.alias("start"), (start + F.expr(f"INTERVAL {size}")).alias("end")).alias("w"),
                          "total", "count", "min_value", "max_value", "last_total", "last_n")


def sliding_rows(windows: DataFrame) -> DataFrame:
    """T3 rows of closed windows."""
    return windows.select(
        "sensor_id", "metric", F.col("w")["start"].alias("window_start"), F.col("w")["end"].alias("window_end"),
        (F.col("total") / F.col("count")).alias("avg_value"), "min_value", "max_value", "count")


def closed_minutes(minutes: DataFrame, limits=None) -> DataFrame:
    """T1 rows (D3) of ``sensor_minutes``."""
    def own(m: str) -> Column:
        part = F.get(F.filter("parts", lambda p: p["metric"] == m), F.lit(0))
        return (part["total"] / part["n"]).alias(m)
    start = F.col("minute")["start"].cast("timestamp_ntz").alias("window_start")
    return minute_rows(minutes.select("sensor_id", start, *[own(m) for m in minute_metrics(limits)]), limits)


class OpenMinutes:
    """The partials that windows still to be emitted need: a folder a
    micro-batch, the two newest kept. ``ahead``: how far (ms) windows close
    ahead of the query's own watermark; if they do, partials come again when
    they change."""

    def __init__(self, spark: SparkSession, checkpoint: str, size: str, slide: str = "1 minute", ahead: int = 0):
        self.spark, self.checkpoint, self.files = spark, checkpoint, _Files(spark, checkpoint)
        self.size, self.slide, self.ahead = size, slide, ahead

    def _path(self, table: str, batch_id: int) -> str:
        return batch_path(self.spark, f"{self.checkpoint}/{table}", batch_id)

    def take(self, df: DataFrame, batch_id: int) -> DataFrame:
        """A micro-batch's rows from a file: its state is evaluated once, and nothing is held in memory."""
        path = self._path("taken", batch_id)
        df.write.mode("overwrite").parquet(path)
        if batch_id > 0:
            self.files.delete(self._path("taken", batch_id - 1))
        return self.spark.read.schema(df.schema).parquet(path)

    def closed_to(self, batch_id: int) -> int:
        """Time (ms) up to which windows are closed in a micro-batch; 0: none yet."""
        if batch_id < 0:
            return 0
        log = self.files.read(f"{self.checkpoint}/offsets/{batch_id}").split("\n")
        watermark = json.loads(log[1])["batchWatermarkMs"]
        return watermark and watermark + self.ahead

    def close(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The windows that close in this micro-batch, from the partials before
        it and its ``rows``."""
        after, upto = (1000 * self.closed_to(i) for i in (batch_id - 1, batch_id))
        rows = rows.select("sensor_id", "minute", *PARTIAL)
        if batch_id > 0:
            before = self.spark.read.schema(rows.schema).parquet(self._path("open", batch_id - 1))
            rows = rows.unionByName(before.join(rows, PARTIAL_KEYS, "left_anti") if self.ahead else before)
        start = F.unix_micros(F.col("minute")["start"])
        last = start + micros(self.size)     # end of the last window that holds it
        rows.where(last > upto).write.mode("overwrite").parquet(self._path("open", batch_id))
        if batch_id > 1:
            self.files.delete(self._path("open", batch_id - 2))
        needed = rows.where((last > after) & (start + micros(self.slide) <= upto))
        return sliding_partials(needed, self.size, self.slide, lambda end: (end > after) & (end <= upto))


def start_sliding(readings: DataFrame, ranges: DataFrame, path: str, checkpoint: str, grace: str = "1 minute",
                  size: str = "10 minutes", slide: str = "1 minute", trigger: dict | None = None):
    """Run T3 into ``path``: each window once, when the watermark (newest event
    time - grace) passes its end."""
    spark = readings.sparkSession
    minutes = OpenMinutes(spark, checkpoint, size, slide, (micros(size) - micros(slide)) // 1000)

    def sink(df: DataFrame, batch_id: int) -> None:
        write_batch(sliding_rows(minutes.close(minutes.take(df, batch_id), batch_id)), path, batch_id)

    with state_partitions(spark):
        return (sliding_stream(readings, ranges, size, slide, grace).writeStream.outputMode("update").foreachBatch(sink)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def start_minutes_and_sliding(readings: DataFrame, ranges: DataFrame, minutes_path: str, sliding_path: str,
                              checkpoint: str, grace: str = "1 minute", size: str = "10 minutes", limits=None,
                              trigger: dict | None = None):
    """Run T1 into ``minutes_path`` and T3 into ``sliding_path`` as one query."""
    spark = readings.sparkSession
    minutes = OpenMinutes(spark, checkpoint, size)

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = minutes.take(df, batch_id)
        write_batch(closed_minutes(rows, limits), minutes_path, batch_id)
        write_batch(sliding_rows(minutes.close(rows.select("sensor_id", "minute", F.inline("parts")), batch_id)),
                    sliding_path, batch_id)

    rows = sensor_minutes(minute_partials(readings, ranges, grace))
    # ``parts`` are few metrics a group: collected in a hash map, not by a sort of all groups.
    with state_partitions(spark), started_with(spark, {"spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000"}):
        return (rows.writeStream.outputMode("append").foreachBatch(sink)
                .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
