import random

from pyspark.sql import functions as F

from streetpulse.ml import hybrid as H
from streetpulse.ml import isolation as I
from streetpulse.ml import patterns as P
from streetpulse.operators.features import with_features


def _traffic(spark, n=400, outliers=5, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((f"Loop-{i % 20:04d}", f"2024-01-0{1 + i % 5} {i % 24:02d}:{i % 60:02d}:00",
                     max(0.0, rnd.gauss(20, 3)), max(0.0, rnd.gauss(50, 5)), max(0.0, rnd.gauss(10, 2))))
    for j in range(outliers):
        rows.append((f"Loop-9{j:03d}", "2024-01-02 08:00:00", 100.0 + j, 2.0, 300.0 + j))
    df = spark.createDataFrame(rows, "sensor_id string, ts string, vehicle_count double, avg_speed double, "
                                     "wait_time_s double")
    return df.withColumn("window_start", F.col("ts").cast("timestamp_ntz")).drop("ts")


def test_isolation_forest_flags_planted_outliers(spark):
    df = _traffic(spark)
    model = I.fit_isolation(df, ["sensor_id", "window_start"])
    scored = I.score_isolation(model, df)
    planted = scored.filter(F.col("sensor_id").startswith("Loop-9")).collect()
    assert all(r.is_anomaly for r in planted)
    share = scored.agg(F.avg(F.col("is_anomaly").cast("double"))).collect()[0][0]
    assert 0.05 <= share <= 0.15
    again = I.score_isolation(I.fit_isolation(df, ["sensor_id", "window_start"]), df)
    assert scored.select("sensor_id", "window_start", "anomaly_score").exceptAll(
        again.select("sensor_id", "window_start", "anomaly_score")).count() == 0


def test_isolation_forest_minimum_samples(spark):
    assert I.fit_isolation(_traffic(spark, n=20, outliers=0), ["sensor_id", "window_start"]) is None


def test_patterns_named_by_speed_and_reproducible(spark):
    feats = with_features(_traffic(spark))
    m1 = P.fit_patterns(feats, restarts=2)
    m2 = P.fit_patterns(feats, restarts=2)
    assert m1.centers == m2.centers
    prof = {r.pattern: r.avg_speed for r in P.cluster_profile(m1.pipeline.transform(feats)).collect()}
    names = [n for n in P.PATTERN_NAMES if n in prof]
    assert [prof[n] for n in names] == sorted(prof.values(), reverse=True)
    pred = P.predict_patterns(m1, feats)
    c = pred.agg(F.min("pattern_confidence"), F.max("pattern_confidence")).collect()[0]
    assert 0.1 <= c[0] <= c[1] <= 1.0


def test_hybrid_defaults_without_models(spark):
    df = _traffic(spark, n=30, outliers=1)
    s = H.hybrid_score(df, None, fallback="default").collect()
    assert {r.ai_traffic_state for r in s} == {"Unknown"} and not any(r.ml_available for r in s)
    rules = H.hybrid_score(df, None, fallback="rules")
    out = rules.filter(F.col("sensor_id").startswith("Loop-9")).collect()[0]
    assert out.ai_traffic_state == "Gridlock" and out.ai_anomaly_detected and out.ai_model_version == "rules-v1"
    summ = H.prediction_summary(rules).collect()[0]
    assert summ.total_sensors == 31 and 0 <= summ.anomaly_rate <= 100 and summ.ml_available_count == 0


def test_retrain_rule_minimums_and_cadence():
    from streetpulse.ml.lifecycle import retrain_due
    assert not retrain_due("patterns", 99, None).due
    assert retrain_due("patterns", 100, None).due
    assert not retrain_due("patterns", 140, 100).due and retrain_due("patterns", 150, 100).due
    assert not retrain_due("states", 49, None).due and retrain_due("states", 50, None).due
    assert retrain_due("states", 75, 50).due and not retrain_due("states", 74, 50).due
    assert retrain_due("anomalies", 100, None).due and not retrain_due("anomalies", 60, None).due


def test_constant_history_has_no_division_by_zero(spark):
    from pyspark.sql import functions as F
    from streetpulse.ml import patterns as MP
    from streetpulse.ml.lifecycle import traffic_features
    rows = spark.range(120).selectExpr("'Loop-0001' AS sensor_id", "timestamp_ntz'2024-01-01 10:00:00' AS window_start",
                                       "20.0D AS vehicle_count_per_min", "40.0D AS avg_speed_kmh", "10.0D AS avg_wait_time_s")
    feats = traffic_features(rows)
    model = MP.fit_patterns(feats, restarts=2)
    out = MP.predict_patterns(model, feats).agg(F.min("pattern_confidence")).first()[0]
    assert out is not None and out >= 0.1


def test_passes_of_a_fit_do_not_start_a_task_per_shuffle_partition(spark, monkeypatch):
    from streetpulse.ml import forest as MF
    feats = with_features(_traffic(spark)).repartition(64).persist()
    seen = {}
    for owner in (P.KMeans, MF.Pipeline):
        def fit(self, rows, *args, _fit=owner.fit, _name=owner.__name__):
            seen.setdefault(_name, []).append((rows.rdd.getNumPartitions(), rows.count()))
            return _fit(self, rows, *args)
        monkeypatch.setattr(owner, "fit", fit)
    model = P.fit_patterns(feats, restarts=2)
    assert seen["KMeans"] == [(1, 405)] * 2
    assert MF.fit_states(P.training_set(P.predict_patterns(model, feats)), num_trees=3) is not None
    assert seen["Pipeline"][-1] == (1, 405)
    feats.unpersist()


def test_training_reads_files_not_a_partition_per_shuffle_partition(spark, monkeypatch):
    from streetpulse.ml import lifecycle as L
    seen = {}

    def patterns_fit(feats, **kw):
        seen["patterns"] = (feats.rdd.getNumPartitions(), feats.count())

    def isolation_fit(feats, key, **kw):
        seen["isolation"] = (feats.rdd.getNumPartitions(), feats.count())
    monkeypatch.setattr(L.patterns, "fit_patterns", patterns_fit)
    monkeypatch.setattr(L.isolation, "fit_isolation", isolation_fit)
    minutes = spark.range(120).repartition(64).selectExpr(
        "'Loop-0001' AS sensor_id", "timestamp_ntz'2024-01-01 10:00:00' AS window_start", "20.0D AS vehicle_count_per_min",
        "40.0D AS avg_speed_kmh", "10.0D AS avg_wait_time_s").repartition(64)
    L.train_all(minutes)
    assert all(parts <= 16 and n == 120 for parts, n in seen.values()) and len(seen) == 2


def test_restarts_keep_their_own_vectors(spark, monkeypatch):
    fit, cached = P.KMeans.fit, []

    def noted(self, rows, *args):
        cached.append(rows.storageLevel.useMemory)
        return fit(self, rows, *args)
    monkeypatch.setattr(P.KMeans, "fit", noted)
    P.fit_patterns(with_features(_traffic(spark)), restarts=2)
    assert cached == [False, False]


def test_scored_micro_batches_are_read_from_files(spark, tmp_path):
    from streetpulse.streaming import scoring as SS
    rows = spark.range(40).selectExpr("concat('Loop-', id) AS sensor_id", "timestamp_ntz'2024-01-01 10:00:00' AS window_start",
                                      "20.0D AS vehicle_count_per_min", "40.0D AS avg_speed_kmh", "10.0D AS avg_wait_time_s")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).repartition(64)
    seen = []
    SS.start_scoring(stream, None, str(tmp_path / "scored"), str(tmp_path / "stats"), str(tmp_path / "c"), fallback="rules",
                     on_batch=lambda df, i: seen.append((df.rdd.getNumPartitions() <= 16, df.count()))).awaitTermination()
    assert seen == [(True, 40)]
    stats = spark.read.parquet(str(tmp_path / "stats")).collect()
    assert [r.rows for r in stats] == [40] and spark.read.parquet(str(tmp_path / "scored")).count() == 40


def test_restarts_share_their_passes_and_end_as_single_fits(spark, monkeypatch):
    """Before, every restart ran its own passes: KMeans fitted to the end, some 40 steps of two stages each."""
    steps = []
    fit = P.KMeans.fit

    def noted(self, rows, *args):
        steps.append(self.getMaxIter())
        return fit(self, rows, *args)
    feats = with_features(_traffic(spark))
    with monkeypatch.context() as m:
        m.setattr(P.KMeans, "fit", noted)
        model = P.fit_patterns(feats, restarts=3)
    assert steps == [0, 0, 0]
    scaled = P.PipelineModel(model.pipeline.stages[:2]).transform(feats)
    alone = [P.KMeans(k=4, seed=42 + i, featuresCol="_scaled", predictionCol="cluster", maxIter=300).fit(scaled.coalesce(1))
             for i in range(3)]
    best = min(alone, key=lambda one: one.summary.trainingCost)
    assert abs(model.training_cost - best.summary.trainingCost) <= 1e-6 * best.summary.trainingCost
    assert all(abs(a - b) < 1e-6 for x, y in zip(sorted(model.centers), sorted(c.tolist() for c in best.clusterCenters()))
               for a, b in zip(x, y))
    ours = model.pipeline.transform(feats).select("_scaled", "cluster").collect()
    assert [r.cluster for r in ours] == [model.centers.index(min(model.centers, key=lambda c: sum(
        (a - b) ** 2 for a, b in zip(c, r._scaled)))) for r in ours]


def test_anomaly_trees_are_fitted_beside_the_patterns(spark, monkeypatch):
    import threading
    from streetpulse.ml import lifecycle as L
    begun = threading.Event()
    monkeypatch.setattr(L.isolation, "fit_isolation", lambda *a, **kw: begun.set())
    monkeypatch.setattr(L.patterns, "fit_patterns", lambda *a, **kw: begun.wait(20) or 1 / 0)
    rows = spark.range(30).selectExpr("'Loop-0001' AS sensor_id", "timestamp_ntz'2024-01-01 10:00:00' AS window_start",
                                      "20.0D AS vehicle_count_per_min", "40.0D AS avg_speed_kmh", "10.0D AS avg_wait_time_s")
    monkeypatch.setattr(L.patterns, "predict_patterns", lambda model, feats: feats)
    monkeypatch.setattr(L.patterns, "training_set", lambda rows: rows)
    monkeypatch.setattr(L.forest, "fit_states", lambda rows, **kw: rows)
    assert L.train_all(rows).patterns is True


def test_rows_walk_the_anomaly_trees_as_one_by_one():
    """Before, a row's walk was worked out again from six two-dimensional look-ups a level."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(5)
    samples = [pd.DataFrame(rng.normal(size=(64, 3)), columns=["_z0", "_z1", "_z2"]).assign(tree=t) for t in range(6)]
    samples[2][["_z0", "_z1", "_z2"]] = 1.0  # a tree of one leaf
    m = I.from_frame(pd.concat([I._grow(42, 64)(s) for s in samples]), [0.0] * 3, [1.0] * 3, 64, 0.0, 1000, 0.1)
    X = rng.normal(size=(300, 3)) * 2
    X[::7, 1] = np.nan

    def walk(x, t):
        node = depth = 0
        while m.feature[t, node] >= 0:
            node = (m.left if x[m.feature[t, node]] <= m.threshold[t, node] else m.right)[t, node]
            depth += 1
        return depth + I.c_factor([m.size[t, node]])[0]
    alone = [sum((walk(x, t) for t in range(6)), 0.0) / 6 for x in X]
    assert I._mean_path(X, I._walks(m)).tolist() == alone
    assert len(I._mean_path(X[:0], I._walks(m))) == 0


def test_starts_make_no_pass_to_choose_a_solver(spark, monkeypatch):
    fit, solvers = P.KMeans.fit, []

    def noted(self, rows, *args):
        solvers.append(self.getSolver())
        return fit(self, rows, *args)
    monkeypatch.setattr(P.KMeans, "fit", noted)
    model = P.fit_patterns(with_features(_traffic(spark)), restarts=2)
    assert solvers == ["row", "row"] and model.samples == 405


def test_distances_are_worked_out_once_a_row(spark):
    """Before, the cluster, the least and the greatest distance each worked out all of them."""
    feats = with_features(_traffic(spark))
    model = P.fit_patterns(feats, restarts=2)
    out = P.predict_patterns(model, feats)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == len(model.centers)
    assert "_apart" not in out.columns and "_apart" not in model.pipeline.transform(feats).columns
    scaled = P.PipelineModel(model.pipeline.stages[:2]).transform(feats).select(*P.FEATURES[:3], "_scaled")
    for r in out.join(scaled, P.FEATURES[:3]).collect():
        apart = [sum((a - b) ** 2 for a, b in zip(c, r._scaled)) ** 0.5 for c in model.centers]
        assert r.cluster == apart.index(min(apart)) and r.pattern == model.labels[r.cluster]
        assert abs(r.pattern_confidence - max(0.1, 1 - min(apart) / max(apart))) < 1e-12


def test_forest_rows_are_dealt_over_more_tasks_than_a_k_means_step(spark, monkeypatch):
    from streetpulse.ml import forest as MF
    feats = with_features(_traffic(spark)).repartition(64).persist()
    samples = P.training_set(P.predict_patterns(P.fit_patterns(feats, restarts=2), feats))
    fit, seen = MF.Pipeline.fit, []

    def noted(self, rows, *args):
        seen.append((rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows, *args)
    monkeypatch.setattr(MF.Pipeline, "fit", noted)
    monkeypatch.setattr(MF, "ROWS_PER_TASK", 100)
    assert MF.fit_states(samples, num_trees=3) is not None
    assert seen == [(5, 405)] and 100 < P.ROWS_PER_TASK
    feats.unpersist()
