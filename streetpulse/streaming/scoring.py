"""Streaming scoring (T8) with per-micro-batch statistics.

The minute stream (T1) of traffic sensors is scored in ``foreachBatch`` by the
hybrid scorer (M6): classifier transform and anomaly UDF run on the
executors; the models are trained beforehand from stored history (M10) and
reach the tasks as a broadcast. Per batch the scored rows go to a versioned
table and one statistics row (row count, state distribution, mean confidence,
anomaly rate, model versions) is computed by an aggregation: no row is
collected to the driver.

A micro-batch leaves its state in one partition per shuffle partition, however few
rows they hold. Its minutes are therefore written once, and scored and counted
from files in the caller's session, which sizes partitions by bytes; the folder of
minutes is overwritten by the next micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml.hybrid import ModelBundle, hybrid_score
from ..ml.registry import Registry
from ..operators.features import traffic_inputs
from ..sources.fixtures import sensor_type_from_id
from .sinks import batch_path, write_batch


def batch_statistics(scored: DataFrame, batch_id: int) -> DataFrame:
    """One row per micro-batch: rows, mean confidence, anomalies in percent,
    and the counts per state and model version (scalar subqueries)."""
    def counts(column):
        per = scored.groupBy(column).agg(F.count("*").alias("n"))
        return per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n"))))).scalar()
    states, versions = counts("ai_traffic_state"), counts("ai_model_version")
    return scored.agg(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.count("*").alias("rows"),
                      F.avg("ai_confidence").alias("mean_confidence"),
                      (F.avg(F.col("ai_anomaly_detected").cast("double")) * 100).alias("anomaly_rate")) \
        .withColumn("states", states).withColumn("model_versions", versions)


def _is_traffic():
    """P3 on a minute row: the id's type, else traffic if it has a traffic measure."""
    measured = F.coalesce("vehicle_count_per_min", "avg_speed_kmh", "avg_wait_time_s").isNotNull()
    return F.coalesce(sensor_type_from_id(F.col("sensor_id")) == "traffic_loop", measured)


def start_scoring(minute_rows: DataFrame, bundle: ModelBundle | Registry | None, scored_path: str, stats_path: str,
                  checkpoint: str, trigger: dict | None = None, fallback: str = "default", on_batch=None):
    """Score every emitted traffic minute; trigger defaults to availableNow
    (use ``{"processingTime": "20 seconds"}`` for a running service). With a
    registry each micro-batch is scored by the version current at its start."""
    traffic = minute_rows.filter(_is_traffic())
    spark = minute_rows.sparkSession
    inputs_path = scored_path.rstrip("/") + "-inputs"

    def sink(df: DataFrame, batch_id: int) -> None:
        model = bundle
        if isinstance(bundle, Registry):
            model = bundle.for_batch(df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct", batch_id)
        inputs, folder = traffic_inputs(df), batch_path(spark, inputs_path, 0)  # one folder a query
        inputs.write.mode("overwrite").parquet(folder)
        rows = hybrid_score(spark.read.schema(inputs.schema).parquet(folder), model, fallback)
        write_batch(rows, scored_path, batch_id)
        scored = spark.read.schema(rows.schema).parquet(batch_path(spark, scored_path, batch_id))
        write_batch(batch_statistics(scored, batch_id).drop("batch_id"), stats_path, batch_id)
        if on_batch:
            on_batch(scored, batch_id)

    return (traffic.writeStream.outputMode("append").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
