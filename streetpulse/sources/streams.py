"""Message sources (S1): any DataFrame of message texts, batch or streaming.

The wire format is one JSON object per message (D1) with ``ts`` as ISO-8601
text. ``parse_messages`` is the same projection for a Kafka stream (``value``
cast to string), a file stream of JSON lines, or a batch table, so streaming
and batch share one code path. Kafka itself needs its connector jar on the
classpath; ``kafka_stream`` only builds the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators.quality import parse_iso_ts


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> reading columns (sensor_id, ts as UTC timestamp_ntz, metric,
    value, location); unparseable fields become null and are caught by the
    completeness gate (S2). Other input columns (e.g. event_id, offsets) are kept."""
    keep = [c for c in messages.columns if c not in (value_col, "key")]
    m = F.from_json(F.col(value_col).cast("string"), schema.RAW_MESSAGE)
    parsed = messages.select(*keep, m.alias("_m"))
    return parsed.select(*keep, "_m.sensor_id", parse_iso_ts(F.col("_m.ts")).alias("ts"),
                         "_m.metric", "_m.value", "_m.location")


def kafka_stream(spark: SparkSession, servers: str, topic: str = "traffic.raw",
                 starting: str = "latest") -> DataFrame:
    """S1 over Kafka: offsets are tracked by the query checkpoint (not a consumer
    group). Requires the Spark Kafka connector on the classpath."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                    "partition", "offset"))


def json_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over a folder of JSON-lines files (one message per line)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
