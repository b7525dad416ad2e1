"""Table sinks for micro-batches (S4, S5) and the upsert read view.

There is no transactional table format on the classpath, so an upsert is a
versioned append: every micro-batch is written, in overwrite mode, to its own
folder ``query=<id>/batch_id=<n>``. The id belongs to the checkpoint: a
replayed batch (``foreachBatch`` is at-least-once) rewrites the same folder, so
replays add no duplicates, and a job with a new checkpoint, whose batches start
at 0 again, never touches older folders. Readers keep the version written last
per key. Compaction rewrites the newest versions once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _folder(spark: SparkSession, batch_id: int) -> str:
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
    return f"query={query}/batch_id={int(batch_id)}"


def batch_path(spark: SparkSession, table_path: str, batch_id: int) -> str:
    """Folder of the running micro-batch's rows in the table."""
    return os.path.join(table_path, _folder(spark, batch_id))


VERSION = ["written_at", "query", "batch_id"]  # columns of a stored row's version


def write_batch(df: DataFrame, table_path: str, batch_id: int) -> None:
    (df.withColumn("written_at", F.current_timestamp())
       .write.mode("overwrite").parquet(batch_path(df.sparkSession, table_path, batch_id)))


def read_versions(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.option("basePath", table_path).parquet(table_path)


def newest_versions(versions: DataFrame, keys=("sensor_id", "window_start")) -> DataFrame:
    """S4 read view: the row written last per key (upsert semantics). A per-key
    group limit, planned before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in VERSION])
    return versions.withColumn("_v", F.row_number().over(w)).filter("_v = 1").drop("_v", *VERSION)


def newest_rows(versions: DataFrame, key: str = "sensor_id") -> DataFrame:
    """All rows of the version written last per key (a batch's whole state)."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in VERSION])
    return versions.withColumn("_v", F.rank().over(w)).filter("_v = 1").drop("_v", *VERSION)


def read_upserted(spark: SparkSession, table_path: str, keys=("sensor_id", "window_start"), time: str | None = None) -> DataFrame:
    """``time``: a column of the keys, for tables whose batches hold each key once
    at most. A batch whose range of it no other batch's meets then holds the only
    version of its keys; just the other batches' rows are ranked."""
    versions = read_versions(spark, table_path)
    if time is None:
        return newest_versions(versions, keys)
    batch = F.concat_ws("/", "query", "batch_id")
    spans = (versions.groupBy(batch.alias("batch"))
             .agg(F.min(time).alias("least"), F.max(time).alias("most"), F.count_if(F.col(time).isNull()).alias("without"))
             .orderBy("least", "most").collect())     # one row a batch
    shared, reach = set(), None      # reach: the batch that goes furthest so far
    for s in spans:
        if s.without:
            shared.update(x.batch for x in spans)
        if s.least is not None and reach is not None and s.least <= reach.most:
            shared.update((s.batch, reach.batch))
        if s.least is not None and (reach is None or s.most > reach.most):
            reach = s
    alone = versions.where(~batch.isin(*shared)).drop(*VERSION)
    return alone.unionByName(newest_versions(versions.where(batch.isin(*shared)), keys)) if shared else alone


def compact(spark: SparkSession, table_path: str, out_path: str,
            keys=("sensor_id", "window_start"), partition_by: str | None = "day") -> None:
    """Rewrite the newest versions as a plain table, partitioned by day for
    partition pruning (T5 retention drops whole day folders)."""
    df = read_upserted(spark, table_path, keys)
    if partition_by == "day":
        df = df.withColumn("day", F.to_date("window_start"))
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(partition_by) if partition_by else w).parquet(out_path)


def write_alerts_and_messages(df: DataFrame, alerts_path, messages_path: str, batch_id: int) -> None:
    """The alert rows to the table (a day table or a folder) and, as JSON text, to the alert topic
    (a folder of JSON lines here; a Kafka sink takes the same ``value``)."""
    df = df.persist()
    try:
        if isinstance(alerts_path, str):
            write_batch(df, alerts_path, batch_id)
        else:
            alerts_path.append(df, batch_id)
        msg = F.to_json(F.struct("alert_id", "sensor_id", "sensor_type", "metric", "value", "severity",
                                 "message", "location",
                                 F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                                 "resolved"))
        (df.select(F.col("sensor_id").alias("key"), msg.alias("value"))
           .write.mode("overwrite").json(os.path.join(messages_path, _folder(df.sparkSession, batch_id))))
    finally:
        df.unpersist()


def resolve_in_table(spark: SparkSession, alerts_path: str, ids: DataFrame, out_path: str) -> None:
    """S8 resolve on a stored alert table: newest alert versions left-joined
    with the id set, written as a new table version (a fresh path, then
    swapped by the caller), never rewriting the input in place."""
    from ..operators.alerts import resolve
    current = newest_versions(read_versions(spark, alerts_path), ("alert_id",))
    resolve(current, ids).write.mode("overwrite").parquet(out_path)


def clear_table(spark: SparkSession, path: str, schema) -> None:
    """S8 clear: replace a table by an empty one with the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
