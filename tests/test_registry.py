"""Model versions: published whole, resolved per micro-batch, pinned for replays."""

import pytest
from pyspark.sql import functions as F
from test_models import _traffic

from streetpulse.ml import isolation as I
from streetpulse.ml.hybrid import ModelBundle
from streetpulse.ml.registry import Registry
from streetpulse.streaming import scoring as SS
from streetpulse.streaming import sinks as SK


@pytest.fixture()
def bundle(spark):
    return ModelBundle(None, None, I.fit_isolation(_traffic(spark), ["sensor_id", "window_start"]))


def test_publish_use_and_replay(spark, tmp_path, bundle):
    r = Registry(spark, str(tmp_path / "m"))
    assert r.current() is None and r.for_batch("q", 0) is None
    assert r.publish(bundle, "v1") == 1 and r.for_batch("q", 1).version == "v1"
    r.publish(bundle, "v2")
    assert r.for_batch("q", 2).version == "v2" and r.for_batch("q", 1).version == "v1" and r.for_batch("q", 0) is None
    assert Registry(spark, r.path).for_batch("q", 1).version == "v1"      # another driver, a replayed batch
    r.use("v1")
    assert r.current()["version"] == "v1" and [h["version"] for h in r.history()] == ["v1", "v2", "v1"]
    with pytest.raises(ValueError):
        r.use("v9")
    df = _traffic(spark)
    cols = ["sensor_id", "window_start", "anomaly_score"]
    saved = I.score_isolation(r.load(r.current()).anomalies, df).select(cols)
    assert saved.exceptAll(I.score_isolation(bundle.anomalies, df).select(cols)).count() == 0


def test_one_stream_is_scored_by_two_versions(spark, tmp_path, bundle):
    r = Registry(spark, str(tmp_path / "m"))
    r.publish(bundle, "v1")
    src = str(tmp_path / "src")
    df = _traffic(spark, 30, 0).select("sensor_id", "window_start", F.col("vehicle_count").alias("vehicle_count_per_min"),
                                       F.col("avg_speed").alias("avg_speed_kmh"), F.col("wait_time_s").alias("avg_wait_time_s"))
    for _ in range(3):
        df.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    SS.start_scoring(stream, r, str(tmp_path / "scored"), str(tmp_path / "stats"), str(tmp_path / "c"),
                     on_batch=lambda rows, i: r.publish(bundle, "v2") if i == 0 else None).awaitTermination()
    got = SK.read_versions(spark, str(tmp_path / "scored")).groupBy("batch_id", "ai_model_version").count().collect()
    assert sorted(tuple(x) for x in got) == [(0, "v1", 30), (1, "v2", 30), (2, "v2", 30)]
