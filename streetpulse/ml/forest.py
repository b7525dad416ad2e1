"""Traffic-state classifier (M4): Spark ML random forest, 100 trees, seed 42,
trained on the labelled samples of M3 (standardised nine features)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import FEATURES, duration_of, severity_of
from .patterns import dealt_for_passes

MIN_SAMPLES = 20
ROWS_PER_TASK = 20_000  # a level takes every row through all trees: more work a row than a K-Means step


@dataclass
class StateModel:
    pipeline: PipelineModel
    samples: int
    importances: dict[str, float]


def _prepare(samples: DataFrame) -> DataFrame:
    """Training rows of D5 -> the nine numeric features + label."""
    from ..operators.features import feature_columns
    base = samples.select("vehicle_count", "avg_speed", "wait_time_s", F.col("timestamp").alias("window_start"),
                          "discovered_pattern")
    return base.select("*", *feature_columns("window_start"))


def fit_states(samples: DataFrame, num_trees: int = 100, seed: int = 42,
               min_samples: int = MIN_SAMPLES) -> StateModel | None:
    data = _prepare(samples).persist()
    try:
        n = data.count()
        if n < min_samples:
            return None
        stages = [
            VectorAssembler(inputCols=FEATURES, outputCol="_raw", handleInvalid="keep"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            StringIndexer(inputCol="discovered_pattern", outputCol="_label", handleInvalid="keep"),
            RandomForestClassifier(featuresCol="_scaled", labelCol="_label", numTrees=num_trees, seed=seed,
                                   predictionCol="_pred", probabilityCol="_prob", rawPredictionCol="_rawpred"),
        ]
        model = Pipeline(stages=stages).fit(dealt_for_passes(data, n, ROWS_PER_TASK))
        labels = model.stages[2].labels
        model = PipelineModel(stages=model.stages + [
            IndexToString(inputCol="_pred", outputCol="predicted_state", labels=labels)])
        imp = model.stages[3].featureImportances.toArray()
        return StateModel(model, int(n), {f: float(v) for f, v in zip(FEATURES, imp)})
    finally:
        data.unpersist()


def predict_states(model: StateModel, features: DataFrame) -> DataFrame:
    """State, confidence = max class probability (3 decimals), severity and
    duration (P16)."""
    out = model.pipeline.transform(features)
    conf = F.round(F.array_max(vector_to_array("_prob")), 3)
    return (out.withColumn("traffic_state", F.col("predicted_state"))
            .withColumn("confidence", conf)
            .withColumn("severity", severity_of(F.col("predicted_state")))
            .withColumn("predicted_duration", duration_of(F.col("predicted_state")))
            .drop("_raw", "_scaled", "_label", "_pred", "_prob", "_rawpred", "predicted_state"))
