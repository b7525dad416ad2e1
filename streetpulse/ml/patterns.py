"""Pattern discovery (M1), pattern + confidence (M2), training set (M3) and
the cluster profile that names the clusters (A21).

Spark ML K-Means on the nine standardised features. The reference restarts
K-Means 10 times and keeps the best; here each restart takes its starting
centres from a seeded Spark ML K-Means, all restarts move on together, one pass
over the rows a step, and the lowest cost wins (ties: lowest seed). The model is
k centres of nine numbers, so the cluster and the distance-based confidence are
computed with array expressions against the centres as literals (JVM-side, no UDF).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.features import FEATURES

# Names given to clusters by descending mean speed.
PATTERN_NAMES = ["Free Flow", "Light Traffic", "Heavy Congestion", "Gridlock"]
MIN_SAMPLES = 20
CONFIDENCE_FLOOR = 0.1
ROWS_PER_TASK = 100_000
MAX_STEPS = 300
TOLERANCE = 1e-4  # centres that move no further stand still
SAME_COST = 1e-9  # restarts in one optimum differ by the rounding of their sums


@dataclass
class PatternModel:
    pipeline: PipelineModel
    labels: dict[int, str]
    centers: list[list[float]] = field(default_factory=list)
    training_cost: float = 0.0
    samples: int = 0


def _prep_stages():
    return [VectorAssembler(inputCols=FEATURES, outputCol="_raw", handleInvalid="keep"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)]


def dealt_for_passes(rows: DataFrame, n: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``n`` training rows in tasks of about ``rows_per_task``, without a shuffle:
    a fit makes hundreds of passes, and each pass starts a task per partition,
    however few rows a partition holds."""
    return rows.coalesce(max(1, -(-n // rows_per_task)))


def move_together(scaled: DataFrame, starts: list[np.ndarray], max_steps: int = MAX_STEPS) -> list[tuple]:
    """Lloyd's steps of all restarts from their starting centres until none of a
    restart's centres moves by more than ``TOLERANCE``: (cost, centres) of each. A step
    is one job over the rows for all restarts that still move; a task returns k rows
    of sums a restart. A centre without rows stays."""
    def step(rows: np.ndarray, restarts: list[np.ndarray]) -> list[np.ndarray]:
        """Of every restart, for every centre: the sum, number and squared distance of the rows nearest to it."""
        out, squares = [], (rows * rows).sum(axis=1)
        for centers in restarts:
            apart = (centers * centers).sum(axis=1) - 2.0 * rows @ centers.T
            near = apart.argmin(axis=1)
            held = (near[:, None] == np.arange(len(centers))).astype("float64")
            cost = np.maximum(squares + apart[np.arange(len(rows)), near], 0.0)
            out.append(held.T @ np.column_stack([rows, np.ones(len(rows)), cost]))
        return out

    def blocks(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"block": [np.stack(list(pdf["x"])).astype("float64").tobytes()]})
    width = len(FEATURES)
    rows = scaled.select(vector_to_array("_scaled").alias("x")).mapInPandas(blocks, "block binary").rdd.map(
        lambda r: np.frombuffer(r["block"], dtype="float64").reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)
    done, moving = [(0.0, c) for c in starts], list(range(len(starts)))
    try:
        for _ in range(max_steps):
            if not moving:
                break
            at = [done[i][1] for i in moving]
            sums = rows.map(lambda block, at=at: step(block, at)).reduce(lambda a, b: [x + y for x, y in zip(a, b)])
            for i, old, got in zip(list(moving), at, sums):
                n = got[:, width:width + 1]
                new = np.where(n > 0, got[:, :width] / np.maximum(n, 1.0), old)
                done[i] = (float(got[:, width + 1].sum()), new)
                if (((new - old) ** 2).sum(axis=1) <= TOLERANCE ** 2).all():
                    moving.remove(i)
        return done
    finally:
        rows.unpersist()


class NearestCenter(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``cluster``: the number of the centre nearest to ``_scaled`` (ties: the first)."""

    centers = Param(Params._dummy(), "centers", "centres, a list of numbers each")

    def __init__(self, centers: list[list[float]] | None = None):
        super().__init__()
        if centers is not None:
            self._set(centers=centers)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_cluster(dataset, self.getOrDefault("centers")).drop("_apart")


def fit_patterns(features: DataFrame, k: int = 4, seed: int = 42, restarts: int = 10,
                 min_samples: int = MIN_SAMPLES, parallelism: int = 5) -> PatternModel | None:
    """M1: best (lowest cost) of ``restarts`` seeded K-Means fits; None below
    ``min_samples``. The scaler is fitted once; the restarts' starting centres (k-means||)
    are found by concurrent Spark jobs; the row solver is named, as to choose one Spark
    makes a pass over the rows before each fit. The scaled rows are left uncached: the passes
    keep their own vectors (in memory, what does not fit on disk), while over a cached
    table each pass would decode all rows again."""
    from concurrent.futures import ThreadPoolExecutor
    data = features.select(*FEATURES).persist()
    try:
        n = data.count()
        if n < min_samples:
            return None
        prep = Pipeline(stages=_prep_stages()).fit(data)
        scaled = prep.transform(dealt_for_passes(data, n)).select("_scaled")

        def start(i):
            m = KMeans(k=k, seed=seed + i, featuresCol="_scaled", predictionCol="cluster", maxIter=0,
                       solver="row").fit(scaled)
            return np.array(m.clusterCenters())

        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, restarts))) as pool:
            fits = move_together(scaled, list(pool.map(start, range(restarts))))
        least = min(cost for cost, _ in fits)
        cost, best = next(f for f in fits if f[0] <= least * (1 + SAME_COST))
        centers = [list(map(float, c)) for c in best]
        model = PipelineModel(stages=list(prep.stages) + [NearestCenter(centers)])
        labels = name_clusters(model.transform(data))
        return PatternModel(model, labels, centers, float(cost), int(n))
    finally:
        data.unpersist()


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Mean speed/wait/count per cluster, ranked by speed (desc), named."""
    prof = assigned.groupBy("cluster").agg(F.avg("avg_speed").alias("avg_speed"),
                                           F.avg("wait_time_s").alias("avg_wait"),
                                           F.avg("vehicle_count").alias("avg_count"),
                                           F.count("*").alias("size"))
    # one row per cluster (k rows): a global order over k rows
    rank = F.row_number().over(Window.orderBy(F.col("avg_speed").desc(), F.col("cluster")))
    names = F.array(*[F.lit(x) for x in PATTERN_NAMES])
    return (prof.withColumn("speed_rank", rank)
            .withColumn("pattern", F.coalesce(F.get(names, F.col("speed_rank") - 1),
                                              F.concat(F.lit("Pattern "), F.col("cluster").cast("string")))))


def name_clusters(assigned: DataFrame) -> dict[int, str]:
    """Cluster id -> name; reads the k-row profile (bounded by k)."""
    return {int(r.cluster): r.pattern for r in cluster_profile(assigned).select("cluster", "pattern").collect()}


def _distance(x: Column, center: list[float]) -> Column:
    c = F.array(*[F.lit(float(v)) for v in center])
    sq = F.zip_with(x, c, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def with_cluster(rows: DataFrame, centers: list[list[float]]) -> DataFrame:
    """``_apart``, the distances of ``_scaled`` to all centres, and ``cluster``, the number
    of the nearest one (ties: the first). The distances are a column of their own:
    Spark does not share expressions with lambdas, so each use would work them out again."""
    return (rows.withColumn("_x", vector_to_array("_scaled"))
            .withColumn("_apart", F.array(*[_distance(F.col("_x"), c) for c in centers])).drop("_x")
            .withColumn("cluster", (F.array_position("_apart", F.array_min("_apart")) - 1).cast("int")))


def predict_patterns(model: PatternModel | None, features: DataFrame) -> DataFrame:
    """M2: ``pattern`` and ``pattern_confidence = max(0.1, 1 - d_min / d_max)``
    over the distances to all centres; 'Unknown', 0.0 without a model."""
    if model is None:
        return features.withColumn("cluster", F.lit(None).cast("int")) \
            .withColumn("pattern", F.lit("Unknown")).withColumn("pattern_confidence", F.lit(0.0))
    out = with_cluster(PipelineModel(stages=model.pipeline.stages[:-1]).transform(features), model.centers)
    dists = F.col("_apart")
    conf = F.greatest(F.lit(CONFIDENCE_FLOOR), F.coalesce(1.0 - F.try_divide(F.array_min(dists), F.array_max(dists)), F.lit(0.0)))
    names = F.create_map(*[F.lit(v) for kv in sorted(model.labels.items()) for v in kv])
    pattern = F.coalesce(names[F.col("cluster")], F.concat(F.lit("Pattern "), F.col("cluster").cast("string")))
    return (out.withColumn("pattern", pattern).withColumn("pattern_confidence", conf)
            .drop("_raw", "_scaled", "_apart"))


def training_set(patterned: DataFrame) -> DataFrame:
    """M3: labelled samples (D5), 'Unknown' patterns skipped."""
    tid = F.sha2(F.concat_ws("|", "sensor_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")), 256)
    return (patterned.filter(F.col("pattern") != "Unknown")
            .select(F.substring(tid, 1, 32).alias("training_id"), "sensor_id",
                    F.col("window_start").alias("timestamp"), "vehicle_count", "avg_speed", "wait_time_s",
                    F.col("hour").cast("int").alias("hour"), (F.col("is_rush_hour") == 1).alias("is_rush_hour"),
                    (F.col("is_weekend") == 1).alias("is_weekend"),
                    F.col("pattern").alias("discovered_pattern"), "pattern_confidence",
                    F.lit(True).alias("used_for_training")))
