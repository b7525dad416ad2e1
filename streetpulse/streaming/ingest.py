"""Messages into three tables in one pass.

Every message ends in exactly one of them, in one write per micro-batch:

* ``good``: parsed, complete, in range;
* ``invalid``: parsed and complete, out of range, with the message of P1;
* ``dead``: text that is no JSON object of the schema, or lacks a required
  value, with the reason and the raw text, so that it can be sent again.

All keep the columns the source gives beside the text (offset, file, ...).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schema
from ..operators.quality import REQUIRED_KEYS, completeness, parse_iso_ts, validate
from .sinks import _folder

OUTCOMES = ("good", "invalid", "dead")


def classified(messages: DataFrame, ranges: DataFrame, value_col: str = "value") -> DataFrame:
    """Reading columns, ``outcome``, ``reason`` and ``raw`` (dead letters only)."""
    keep = [c for c in messages.columns if c not in (value_col, "key")]
    kind = StructType([*schema.RAW_MESSAGE.fields, StructField("_bad", StringType())])
    text = F.col(value_col).cast("string")
    m = F.from_json(text, kind, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    read = messages.select(*keep, text.alias("raw"), m.alias("m")).select(
        *keep, "raw", "m.sensor_id", parse_iso_ts(F.col("m.ts")).alias("ts"), "m.metric", "m.value",
        (F.col("m").isNull() | F.col("m._bad").isNotNull()).alias("bad"))
    checked = validate(read, ranges)
    missing = F.concat_ws(", ", *[F.when(F.col(k).isNull(), F.lit(k)) for k in REQUIRED_KEYS])
    dead = F.when(F.col("bad"), "not a message").when(
        missing != "", F.concat(F.lit("missing or unreadable: "), missing)).when(~completeness(read), "value is no usable number")
    outcome = F.when(dead.isNotNull(), "dead").when(F.col("is_valid"), "good").otherwise("invalid")
    reason = F.coalesce(dead, F.when(~F.col("is_valid"), F.col("validation_msg")))
    return checked.select(*keep, "sensor_id", "ts", "metric", "value", F.when(outcome == "dead", F.col("raw")).alias("raw"),
                          reason.alias("reason"), outcome.alias("outcome"))


def start_ingest(messages: DataFrame, ranges: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Runs the three tables; a replayed batch rewrites its own folder."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").partitionBy("outcome").parquet(os.path.join(path, _folder(df.sparkSession, batch_id)))

    return (classified(messages, ranges).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """One of the three tables; only its folders are read."""
    if outcome not in OUTCOMES:
        raise ValueError(f"unknown outcome {outcome}")
    rows = spark.read.option("basePath", path).parquet(path).where(F.col("outcome") == outcome).drop("outcome", "query", "batch_id")
    return rows if outcome == "dead" else rows.drop("raw")
