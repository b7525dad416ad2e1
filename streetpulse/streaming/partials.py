"""Minutes from mergeable partial sums, late readings included.

Every micro-batch is aggregated to (sensor, minute, metric) -> sum and count.
Partials of minutes that the watermark (newest event time of earlier batches
minus the grace) has not closed go to the partials table; those behind it go to
a side table instead of being dropped. Minutes are the partials' sums divided by
their counts, so reconciliation only has to append the side table's partials:
the emitted minutes then equal those of a batch over all readings.

A batch writes its own folders, and the newest event time after it, so a replay
gives the same rows; reconciling a batch twice writes the same folder twice.
"""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import minute_floor
from ..operators.windows import minute_metrics, minute_rows
from .day_table import DayTable, summed
from .minutes import _checked

KEYS = ["sensor_id", "window_start", "metric"]


def minute_partials(valid: DataFrame) -> DataFrame:
    """sum, count and newest event time per sensor, minute and metric."""
    return valid.groupBy("sensor_id", minute_floor("ts").alias("window_start"), "metric").agg(
        F.sum("value").alias("total"), F.count("*").alias("n"), F.max("ts").cast("timestamp_ntz").alias("newest"))


def minutes_of(partials: DataFrame, limits=None) -> DataFrame:
    """D3 rows (P9, B1) from partial sums."""
    own = {m: F.col("metric") == m for m in minute_metrics(limits)}
    means = [(F.sum(F.when(c, F.col("total"))) / F.sum(F.when(c, F.col("n")))).alias(m) for m, c in own.items()]
    return minute_rows(partials.groupBy("sensor_id", "window_start").agg(*means), limits)


class LateMinutes:
    """The partials table, its side table, and the job that fills them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.partials = DayTable(spark, path + "/partials", KEYS, "window_start", summed(KEYS, ["total", "n"]))
        self.late = DayTable(spark, path + "/late", KEYS, "window_start", summed(KEYS, ["total", "n"]))

    def _newest(self, query: str, batch_id: int) -> dt.datetime | None:
        """Newest event time after a batch of a query."""
        found = self.partials.files.matching(f"{self.path}/newest/{query}/{batch_id:010d}")
        text = self.partials.files.read(found[0]) if found else ""
        return dt.datetime.fromisoformat(text) if text else None

    def take(self, valid: DataFrame, batch_id: int, grace: str) -> None:
        """One micro-batch of valid readings."""
        query = self.partials._query()
        before = self._newest(query, batch_id - 1)
        rows = minute_partials(valid).persist()
        try:
            behind = F.lit(False)
            if before is not None:
                closed = before - pd.Timedelta(grace).to_pytimedelta()
                behind = F.col("window_start") + F.expr("INTERVAL 1 MINUTE") <= F.lit(closed).cast("timestamp_ntz")
            self.partials.append(rows.where(~behind).drop("newest"), batch_id)
            self.late.append(rows.where(behind).drop("newest"), batch_id)
            newest = rows.agg(F.max("newest")).first()[0]
        finally:
            rows.unpersist()
        newest = max([t for t in (before, newest) if t is not None], default=None)
        self.partials.files.put(f"{self.path}/newest/{query}/{batch_id:010d}", newest.isoformat() if newest else "")

    def start(self, readings: DataFrame, ranges: DataFrame, checkpoint: str, grace: str = "1 minute", trigger: dict | None = None):
        valid = _checked(readings, ranges).filter("is_valid").select("sensor_id", "ts", "metric", "value")
        return (valid.writeStream.foreachBatch(lambda df, i: self.take(df, i, grace)).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def reconcile(self) -> int:
        """Merges what is new in the side table into the partials; returns the
        number of late batches merged. The side table keeps them as history."""
        pending = self.late._pending("tail", self.late.snapshot())
        for folder, p in pending.items():
            rows = self.late._tail("tail", [folder], None).select(*KEYS, "total", "n")
            self.partials.append(rows, p["batch"], f"late-{p['query']}")
        self.late.fold()
        return len(pending)

    def minutes(self, limits=None) -> DataFrame:
        return minutes_of(self.partials.read(), limits)
