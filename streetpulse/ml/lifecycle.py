"""Model lifecycle: training from stored history (M10 retrain rule with its
minimums), model quality table (M9, D6) and save / load (M11).

Training is a scheduled batch job over the minute table; scoring never
trains (R15).
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import traffic_inputs, with_features
from ..session import scratch_path
from . import forest, isolation, patterns
from .hybrid import MODEL_VERSION, ModelBundle

# Fixed values of the reference retrain rule: (first fit at, then every, minimum)
RETRAIN_RULES = {
    "patterns": (100, 50, 20),
    "anomalies": (100, 50, 50),
    "states": (50, 25, 20),
}


@dataclass
class RetrainDecision:
    model: str
    samples: int
    due: bool
    reason: str


def retrain_due(model: str, samples: int, trained_at: int | None) -> RetrainDecision:
    """First fit once ``first`` samples exist, then after every ``every``
    new samples; never below the minimum."""
    first, every, minimum = RETRAIN_RULES[model]
    if samples < max(first, minimum):
        return RetrainDecision(model, samples, False, f"needs {max(first, minimum)} samples")
    if trained_at is None:
        return RetrainDecision(model, samples, True, "first fit")
    if samples - trained_at >= every:
        return RetrainDecision(model, samples, True, f"{samples - trained_at} new samples")
    return RetrainDecision(model, samples, False, "up to date")


def retrain_decisions(cases: DataFrame) -> DataFrame:
    """M10 over rows (model, samples, trained_at): adds ``due`` and ``reason``
    by the rule of ``retrain_due``."""
    need, every = F.lit(None).cast("long"), F.lit(None).cast("long")
    for model, (first, step, minimum) in RETRAIN_RULES.items():
        is_model = F.col("model") == model
        need = F.when(is_model, F.lit(max(first, minimum))).otherwise(need)
        every = F.when(is_model, F.lit(step)).otherwise(every)
    new = F.col("samples") - F.col("trained_at")
    short, never = F.col("samples") < need, F.col("trained_at").isNull()
    return cases.withColumn("due", ~short & (never | (new >= every))).withColumn(
        "reason", F.when(short, F.concat(F.lit("needs "), need.cast("string"), F.lit(" samples")))
        .when(never, "first fit").when(new >= every, F.concat(new.cast("string"), F.lit(" new samples")))
        .otherwise("up to date"))


def traffic_features(minutes: DataFrame) -> DataFrame:
    """Minute rows of traffic sensors -> inputs (P11) + features (P10)."""
    return with_features(traffic_inputs(minutes))


def _written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` through files of the shared checkpoint folder. A cached table keeps
    the partitions of the shuffle it came from, and every pass over it starts a task
    for each; files are written in partitions sized by their bytes and read that way."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def train_all(minutes: DataFrame, restarts: int = 10, trees: int = 100, seed: int = 42) -> ModelBundle:
    """M1 -> M3 -> M4, and M5, each behind its minimum sample guard. M5 takes
    nothing from the others, so its jobs run beside theirs."""
    from concurrent.futures import ThreadPoolExecutor
    feats = _written(traffic_features(minutes), "training-features")
    with ThreadPoolExecutor(max_workers=1) as beside:
        anomalies = beside.submit(isolation.fit_isolation, feats, ["sensor_id", "window_start"], seed=seed)
        pm = patterns.fit_patterns(feats, restarts=restarts, seed=seed)
        sm = None
        if pm is not None:
            labelled = patterns.training_set(patterns.predict_patterns(pm, feats))
            sm = forest.fit_states(labelled, num_trees=trees, seed=seed)
        return ModelBundle(pm, sm, anomalies.result(), MODEL_VERSION)


def model_quality(minutes: DataFrame, bundle: ModelBundle, seed: int = 42, trees: int = 100) -> DataFrame:
    """M9 (D6), one row per model type, dated by the newest event time:
    random forest: held-out accuracy, weighted precision and recall (80/20
    seeded split of the labelled samples); kmeans: silhouette; isolation
    forest: share of training rows flagged (target: the contamination), each in
    a column of its own."""
    spark = minutes.sparkSession
    feats = _written(traffic_features(minutes), "quality-features")
    labelled = _written(patterns.training_set(patterns.predict_patterns(bundle.patterns, feats)), "quality-samples")
    train, test = labelled.randomSplit([0.8, 0.2], seed=seed)
    sm = forest.fit_states(train, num_trees=trees, seed=seed)
    if sm is None:
        return spark.createDataFrame([], "model_type string, date date, training_samples int, accuracy_score double, "
                                         "precision_score double, recall_score double, silhouette double, "
                                         "flagged_share double, model_version string, last_updated timestamp_ntz")
    pred = _written(sm.pipeline.transform(forest._prepare(test)).select("_label", "_pred"), "quality-predictions")

    def metric(name):
        return MulticlassClassificationEvaluator(labelCol="_label", predictionCol="_pred", metricName=name).evaluate(pred)
    acc, prec, rec = metric("accuracy"), metric("weightedPrecision"), metric("weightedRecall")
    rows = [("random_forest", sm.samples, float(acc), float(prec), float(rec), None, None)]
    if bundle.patterns is not None:
        # K-Means: silhouette of the clustering on its training rows
        from pyspark.ml.evaluation import ClusteringEvaluator
        assigned = bundle.patterns.pipeline.transform(feats)
        sil = ClusteringEvaluator(featuresCol="_scaled", predictionCol="cluster").evaluate(assigned)
        rows.append(("kmeans", bundle.patterns.samples, None, None, None, float(sil), None))
    if bundle.anomalies is not None:
        # isolation forest: share of training rows flagged (target: contamination)
        flagged = isolation.score_isolation(bundle.anomalies, feats).agg(
            F.avg(F.col("is_anomaly").cast("double"))).first()[0]
        rows.append(("isolation_forest", bundle.anomalies.samples, None, None, None, None, float(flagged)))
    stats = spark.createDataFrame(rows, "model_type string, training_samples long, accuracy_score double, "
                                        "precision_score double, recall_score double, silhouette double, "
                                        "flagged_share double")
    newest = feats.agg(F.max("window_start")).scalar()
    return stats.select(
        "model_type", F.to_date(newest).alias("date"), F.col("training_samples").cast("int"),
        "accuracy_score", "precision_score", "recall_score", "silhouette", "flagged_share",
        F.lit(MODEL_VERSION).alias("model_version"), newest.alias("last_updated"))


# ------------------------------------------------------------------- M11
def save_bundle(spark: SparkSession, bundle: ModelBundle, path: str) -> None:
    meta = {"version": bundle.version}
    if bundle.patterns is not None:
        bundle.patterns.pipeline.write().overwrite().save(os.path.join(path, "patterns"))
        meta["patterns"] = {"labels": {str(k): v for k, v in bundle.patterns.labels.items()},
                            "centers": bundle.patterns.centers, "cost": bundle.patterns.training_cost,
                            "samples": bundle.patterns.samples}
    if bundle.states is not None:
        bundle.states.pipeline.write().overwrite().save(os.path.join(path, "states"))
        meta["states"] = {"samples": bundle.states.samples, "importances": bundle.states.importances}
    if bundle.anomalies is not None:
        a = bundle.anomalies
        isolation.to_frame(spark, a).write.mode("overwrite").parquet(os.path.join(path, "anomaly_trees"))
        meta["anomalies"] = {"means": a.means, "scales": a.scales, "psi": a.psi, "offset": a.offset,
                             "samples": a.samples, "contamination": a.contamination}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(
        os.path.join(path, "meta"))


def load_bundle(spark: SparkSession, path: str) -> ModelBundle:
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    pm = sm = am = None
    if "patterns" in meta:
        p = meta["patterns"]
        pm = patterns.PatternModel(PipelineModel.load(os.path.join(path, "patterns")),
                                   {int(k): v for k, v in p["labels"].items()}, p["centers"], p["cost"], p["samples"])
    if "states" in meta:
        s = meta["states"]
        sm = forest.StateModel(PipelineModel.load(os.path.join(path, "states")), s["samples"], s["importances"])
    if "anomalies" in meta:
        a = meta["anomalies"]
        nodes = spark.read.parquet(os.path.join(path, "anomaly_trees")).toPandas()
        am = isolation.from_frame(nodes, a["means"], a["scales"], a["psi"], a["offset"], a["samples"],
                                  a["contamination"])
    return ModelBundle(pm, sm, am, meta["version"])
