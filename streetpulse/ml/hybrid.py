"""Hybrid scoring (M6) of traffic inputs into the scoring struct (D7), scoring
of every traffic sensor's latest row (M8) and the prediction summary (A18).

Replaces the reference's per-row HTTP call: the classifier is a Spark ML
transform, the anomaly model a vectorised pandas UDF over broadcast trees, and
without models the rules are column expressions. No row leaves the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import (NO_MODEL_STATE, rule_anomaly, rule_classification, traffic_inputs,
                                  with_features)
from .forest import StateModel, predict_states
from .isolation import IsolationModel, score_isolation
from .patterns import PatternModel

MODEL_VERSION = "spark-ml-v1"
RULES_VERSION = "rules-v1"
FALLBACK_VERSION = "fallback-v1.0"


@dataclass
class ModelBundle:
    patterns: PatternModel | None = None
    states: StateModel | None = None
    anomalies: IsolationModel | None = None
    version: str = MODEL_VERSION


def hybrid_score(inputs: DataFrame, bundle: ModelBundle | None = None, fallback: str = "default",
                 no_model: tuple = NO_MODEL_STATE) -> DataFrame:
    """M6: inputs (vehicle_count, avg_speed, wait_time_s, window_start) ->
    inputs + D7 columns + ``ml_available``.

    State: the classifier when present; otherwise ``no_model``, by default
    'Unknown', 0.0, Low, '5-15 minutes', or, where a service runs without a
    fitted scaler (``fallback='rules'``), the P12 rules. Anomaly: the isolation
    forest when present; otherwise (False, 0.0), or the P15 rules."""
    feats = with_features(inputs)
    has_states = bundle is not None and bundle.states is not None
    has_anom = bundle is not None and bundle.anomalies is not None
    if has_states:
        s = predict_states(bundle.states, feats)
        state = F.struct(F.col("traffic_state"), F.col("confidence").cast("double").alias("confidence"),
                         F.col("severity"), F.col("predicted_duration"))
        s = s.withColumn("_state", state).drop("traffic_state", "confidence", "severity", "predicted_duration")
    elif fallback == "rules":
        s = feats.withColumn("_state", rule_classification(F.col("avg_speed"), F.col("wait_time_s")))
    else:
        st, conf, sev, dur = no_model
        s = feats.withColumn("_state", F.struct(F.lit(st).alias("traffic_state"), F.lit(conf).alias("confidence"),
                                                F.lit(sev).alias("severity"), F.lit(dur).alias("predicted_duration")))
    if has_anom:
        s = score_isolation(bundle.anomalies, s).withColumn(
            "_anom", F.struct(F.col("is_anomaly"), F.col("anomaly_score"))).drop(
            "is_anomaly", "anomaly_score", "anomaly_confidence")
    elif fallback == "rules":
        a = rule_anomaly(F.col("vehicle_count"), F.col("avg_speed"), F.col("wait_time_s"))
        s = s.withColumn("_anom", F.struct(a.is_anomaly.alias("is_anomaly"),
                                           a.anomaly_score.cast("double").alias("anomaly_score")))
    else:
        s = s.withColumn("_anom", F.struct(F.lit(False).alias("is_anomaly"), F.lit(0.0).alias("anomaly_score")))
    version = bundle.version if (has_states or has_anom) else (RULES_VERSION if fallback == "rules"
                                                                else FALLBACK_VERSION)
    return s.select(
        *inputs.columns,
        F.col("_state.traffic_state").alias("ai_traffic_state"),
        F.col("_state.confidence").alias("ai_confidence"),
        F.col("_state.severity").alias("ai_severity"),
        F.col("_state.predicted_duration").alias("ai_predicted_duration"),
        F.col("_anom.is_anomaly").alias("ai_anomaly_detected"),
        F.col("_anom.anomaly_score").alias("ai_anomaly_score"),
        F.lit(version).alias("ai_model_version"),
        F.lit(has_states or has_anom).alias("ml_available"))


# What the overview shows for a sensor that could not be scored.
UNAVAILABLE = ("Unknown", 0.0, "Low", "Unknown")


def score_latest(latest: DataFrame, bundle: ModelBundle | None = None, fallback: str = "default") -> DataFrame:
    """M8: latest row of every traffic sensor (J1 output), nulls -> 0, scored."""
    t = latest.filter(F.col("sensor_type") == "traffic_loop")
    return hybrid_score(traffic_inputs(t), bundle, fallback, UNAVAILABLE)


def prediction_summary(scored: DataFrame) -> DataFrame:
    """Totals, availability and anomaly percentages, mean of the
    confidences above 0 (3 decimals)."""
    n = F.count("*")
    avail = F.count_if("ml_available")
    anom = F.count_if(F.coalesce(F.col("ai_anomaly_detected"), F.lit(False)))
    pos = F.when(F.col("ai_confidence") > 0, F.col("ai_confidence"))
    return scored.agg(
        n.alias("total_sensors"), avail.alias("ml_available_count"),
        F.coalesce(F.try_divide(avail * 100.0, n), F.lit(0.0)).alias("ml_availability_rate"),
        anom.alias("anomaly_count"),
        F.coalesce(F.try_divide(anom * 100.0, n), F.lit(0.0)).alias("anomaly_rate"),
        F.round(F.coalesce(F.avg(pos), F.lit(0.0)), 3).alias("avg_confidence"))


def state_distribution(scored: DataFrame) -> DataFrame:
    """A18 state distribution as rows (state, sensors)."""
    return scored.groupBy(F.coalesce(F.col("ai_traffic_state"), F.lit("Unknown")).alias("traffic_state")) \
        .agg(F.count("*").alias("sensors"))


def state_distribution_map(scored: DataFrame) -> DataFrame:
    """A18 state distribution as one map column (bounded by the number of states)."""
    d = state_distribution(scored)
    return d.agg(F.map_from_entries(F.collect_list(F.struct("traffic_state", "sensors"))).alias("state_distribution"))
