"""Session helpers: build a session for tests and benches, resolve the shared
checkpoint folder.

Library functions never create sessions; they take the caller's. The builder
here is for tests, the bench and local runs only.
"""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, AQE on (runtime broadcast
# decisions, partition coalescing, skew splitting).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "streetpulse",
                  extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``streetpulse`` importable by Python workers (pandas UDFs,
    applyInPandas, streaming state functions) wherever the driver runs from:
    the package is zipped once per application and added with ``addPyFile``,
    which distributes it to every executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: use spark.addArtifacts instead
        return
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.join("streetpulse", os.path.relpath(full, root)))
    data = buf.getvalue()
    out_dir = tempfile.mkdtemp(prefix="streetpulse-pyfiles-")
    path = os.path.join(out_dir, f"streetpulse-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    with open(path, "wb") as fh:
        fh.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, fault-tolerant folder and is used
    as is. Only when it is unset on a local master (tests) a fresh folder is
    made here; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="streetpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect client
        pass
    return path


def session_key(spark: SparkSession):
    """Identity of a session for per-session caches of lazy plans."""
    try:
        return (spark.sparkContext.applicationId, id(spark))
    except Exception:  # noqa: BLE001 - Spark Connect
        return ("connect", id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's output
    (stream checkpoints, materialised tables that cut lineage)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streetpulse", f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def started_with(spark: SparkSession, settings: dict[str, str]):
    """Streams started inside have these settings. A stream takes its settings when
    it starts, so the session's own are put back right after."""
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in the RocksDB store, which
    state variables and timers need."""
    return started_with(spark, {"spark.sql.streaming.stateStore.providerClass":
                                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})


STATE_PARTITIONS_PER_CORE = 8


def state_partitions(spark: SparkSession):
    """Streams started inside have ``STATE_PARTITIONS_PER_CORE`` state partitions a
    core, or the session's shuffle partitions if those are fewer. Every partition
    loads and writes its state each micro-batch, which costs some tenths of a
    second, however few rows it has. The number belongs to the checkpoint."""
    key = "spark.sql.shuffle.partitions"
    cores = spark.sparkContext.defaultParallelism
    return started_with(spark, {key: str(min(int(spark.conf.get(key)), STATE_PARTITIONS_PER_CORE * cores))})
