"""Isolation forest (M5), which Spark ML does not have (method: Liu, Ting and
Zhou, "Isolation Forest", ICDM 2008).

Training, distributed:
1. Standardise the three inputs with mean and population deviation (one
   aggregation).
2. Per tree, sample ``psi`` (<= 256) rows without a shuffle of the data: a
   hash of (row key, seed) keeps a uniform pool of ~3 x trees x psi rows;
   each pooled row draws a uniform number per tree from a hash of (row key,
   tree, seed); rows under ~3 psi / pool are candidates and a per-tree group
   limit keeps the ``psi`` smallest. Each tree's sample is a uniform subset
   of the data, does not depend on partitioning, and the per-tree work is
   the same whatever N is.
3. ``groupBy(tree).applyInPandas`` grows one random isolation tree per group
   (depth limit ceil(log2 psi)).
Scoring: the trees have at most trees x (2 psi - 1) nodes, a size fixed by the
parameters, so they are broadcast and evaluated by a vectorised pandas UDF.
The cut-off is the ``contamination`` quantile of the training scores
(``percentile_approx``); ``decision < 0`` marks an anomaly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INPUTS = ["vehicle_count", "avg_speed", "wait_time_s"]
EULER = 0.5772156649
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int"


def c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


@dataclass
class IsolationModel:
    means: list[float]
    scales: list[float]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray
    psi: int
    offset: float
    samples: int
    contamination: float


def _uniform(key: Column, tree, seed: int) -> Column:
    h = F.xxhash64(key, tree, F.lit(seed))
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def _grow(seed: int, psi: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        X = pdf[[f"_z{i}" for i in range(len(INPUTS))]].to_numpy(dtype="float64")
        rng = np.random.default_rng(seed + t)
        feat, thr, left, right, size = [], [], [], [], []

        def new_node():
            feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(0)
            return len(feat) - 1

        stack = [(new_node(), np.arange(len(X)), 0)]
        while stack:
            node, idx, depth = stack.pop()
            size[node] = len(idx)
            if depth >= max_depth or len(idx) <= 1:
                continue
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if len(usable) == 0:
                continue
            f = int(rng.choice(usable))
            s = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] <= s
            ln, rn = new_node(), new_node()
            feat[node], thr[node], left[node], right[node] = f, s, ln, rn
            stack.append((ln, idx[go_left], depth + 1))
            stack.append((rn, idx[~go_left], depth + 1))
        n = len(feat)
        return pd.DataFrame({"tree": np.full(n, t, dtype="int32"), "node": np.arange(n, dtype="int32"),
                             "feature": np.asarray(feat, dtype="int32"), "threshold": np.asarray(thr, dtype="float64"),
                             "left": np.asarray(left, dtype="int32"), "right": np.asarray(right, dtype="int32"),
                             "size": np.asarray(size, dtype="int32")})
    return grow


def _standardised(df: DataFrame, means, scales) -> list[Column]:
    return [((F.coalesce(F.col(f), F.lit(0.0)) - F.lit(m)) / F.lit(s)).alias(f"_z{i}")
            for i, (f, m, s) in enumerate(zip(INPUTS, means, scales))]


def _walks(model: IsolationModel) -> list[tuple]:
    """Every tree laid out for walking all rows a level at a time: (levels, feature,
    threshold, the two children of each node side by side, path length if the walk
    ends there). A leaf is its own child, so no row is looked at for having arrived."""
    out = []
    for feature, threshold, left, right, size in zip(model.feature, model.threshold, model.left, model.right, model.size):
        inner, nodes = feature >= 0, np.arange(len(feature))
        depth, level, levels = np.zeros(len(feature)), np.zeros(1, dtype="int64"), 0
        while len(level := level[inner[level]]):
            levels += 1
            level = np.concatenate([left[level], right[level]])
            depth[level] = levels
        children = np.column_stack([np.where(inner, right, nodes), np.where(inner, left, nodes)]).ravel()
        out.append((levels, np.where(inner, feature, 0).astype("int32"), threshold, children.astype("int32"),
                    depth + c_factor(size)))
    return out


def _mean_path(X: np.ndarray, walks: list[tuple]) -> np.ndarray:
    """Mean path length of every row of ``X`` over the trees."""
    n = len(X)
    values, rows = np.ascontiguousarray(X.T).ravel(), np.arange(n, dtype="int32")
    total = np.zeros(n)
    for levels, feature, threshold, children, length in walks:
        node = np.zeros(n, dtype="int32")
        starts = feature * n  # of each node's input in ``values``
        for _ in range(levels):
            left = values.take(starts.take(node) + rows) <= threshold.take(node)
            node = children.take(2 * node + left)
        total += length.take(node)
    return total / len(walks)


def _score_udf(spark: SparkSession, model: IsolationModel):
    payload = (_walks(model), model.psi, model.means, model.scales)
    try:
        shared = spark.sparkContext.broadcast(payload)

        def trees():
            return shared.value
    except Exception:  # noqa: BLE001 - Spark Connect: the bounded trees travel with the UDF

        def trees():
            return payload

    @F.pandas_udf("double")
    def score(vc: pd.Series, sp: pd.Series, wt: pd.Series) -> pd.Series:
        walks, psi, means, scales = trees()
        X = np.column_stack([vc.fillna(0.0).to_numpy(dtype="float64"), sp.fillna(0.0).to_numpy(dtype="float64"),
                             wt.fillna(0.0).to_numpy(dtype="float64")])
        X = (X - np.asarray(means)) / np.asarray(scales)
        # score_samples convention: the opposite of the anomaly score
        return pd.Series(-np.power(2.0, -_mean_path(X, walks) / float(c_factor([psi])[0])))
    return score


def fit_isolation(data: DataFrame, key: list[str], trees: int = 100, psi: int = 256, seed: int = 42,
                  contamination: float = 0.1, min_samples: int = 50) -> IsolationModel | None:
    spark = data.sparkSession
    d = data.select(*key, *INPUTS).persist()
    try:
        aggs = [F.count("*").alias("n")]
        for f in INPUTS:
            aggs += [F.avg(F.coalesce(F.col(f), F.lit(0.0))).alias(f"m_{f}"),
                     F.stddev_pop(F.coalesce(F.col(f), F.lit(0.0))).alias(f"s_{f}")]
        st = d.agg(*aggs).collect()[0]
        n = int(st["n"])
        if n < min_samples:
            return None
        means = [float(st[f"m_{f}"]) for f in INPUTS]
        scales = [float(st[f"s_{f}"]) if st[f"s_{f}"] else 1.0 for f in INPUTS]
        psi_eff = min(psi, n)
        # 1. a uniform pool of ~3 x trees x psi rows (one hash per row): the
        #    per-tree work below is then constant, whatever N is
        p_pool = min(1.0, 3.0 * trees * psi_eff / n)
        row_key = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
        pool = d.select(*_standardised(d, means, scales), row_key.alias("_key")) \
            .filter(_uniform(F.col("_key"), F.lit(-1), seed) < p_pool)
        # 2. per tree, candidates with a draw under ~3 psi / pool size
        q = min(1.0, 3.0 * psi_eff / (n * p_pool))
        cand = (pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
                .withColumn("u", _uniform(F.col("_key"), F.col("tree"), seed))
                .filter(F.col("u") < q).drop("_key"))
        from pyspark.sql import Window
        w = Window.partitionBy("tree").orderBy("u")
        sample = cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= psi_eff).drop("_r", "u")
        nodes = sample.groupBy("tree").applyInPandas(_grow(seed, psi_eff), NODE_SCHEMA)
        # bounded by trees * (2 psi - 1) rows: the model itself, not data
        pdf = nodes.toPandas()
        width = int(pdf["node"].max()) + 1
        shape = (trees, width)
        arr = {c: np.full(shape, -1 if c != "threshold" else 0.0,
                          dtype="float64" if c == "threshold" else "int64")
               for c in ["feature", "threshold", "left", "right", "size"]}
        arr["size"][:] = 0
        ti, ni = pdf["tree"].to_numpy(), pdf["node"].to_numpy()
        for c in arr:
            arr[c][ti, ni] = pdf[c].to_numpy()
        model = IsolationModel(means, scales, arr["feature"], arr["threshold"], arr["left"], arr["right"],
                               arr["size"], psi_eff, 0.0, n, contamination)
        score = _score_udf(spark, model)
        off = d.select(score(*[F.col(f) for f in INPUTS]).alias("s")) \
            .agg(F.percentile_approx("s", contamination, 100000).alias("o")).collect()[0]["o"]
        model.offset = float(off)
        return model
    finally:
        d.unpersist()


def score_isolation(model: IsolationModel, df: DataFrame) -> DataFrame:
    """Adds ``anomaly_score`` (decision value, 3 decimals), ``is_anomaly``
    (decision < 0) and ``anomaly_confidence`` = |decision|."""
    udf = _score_udf(df.sparkSession, model)
    dec = udf(*[F.col(f) for f in INPUTS]) - F.lit(model.offset)
    return (df.withColumn("_dec", dec)
            .withColumn("is_anomaly", F.col("_dec") < 0)
            .withColumn("anomaly_score", F.round("_dec", 3))
            .withColumn("anomaly_confidence", F.round(F.abs("_dec"), 3)).drop("_dec"))


def to_frame(spark: SparkSession, model: IsolationModel) -> DataFrame:
    """Tree table (for saving, M11); at most trees x (2 psi - 1) rows."""
    ti, ni = np.nonzero((model.size > 0) | (model.feature >= 0))
    pdf = pd.DataFrame({"tree": ti.astype("int32"), "node": ni.astype("int32"),
                        "feature": model.feature[ti, ni].astype("int32"),
                        "threshold": model.threshold[ti, ni].astype("float64"),
                        "left": model.left[ti, ni].astype("int32"), "right": model.right[ti, ni].astype("int32"),
                        "size": model.size[ti, ni].astype("int32")})
    return spark.createDataFrame(pdf, NODE_SCHEMA)


def from_frame(nodes: pd.DataFrame, means, scales, psi, offset, samples, contamination) -> IsolationModel:
    trees = int(nodes["tree"].max()) + 1
    width = int(nodes["node"].max()) + 1
    arr = {c: np.full((trees, width), -1 if c != "threshold" else 0.0,
                      dtype="float64" if c == "threshold" else "int64")
           for c in ["feature", "threshold", "left", "right", "size"]}
    arr["size"][:] = 0
    ti, ni = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    for c in arr:
        arr[c][ti, ni] = nodes[c].to_numpy()
    return IsolationModel(list(means), list(scales), arr["feature"], arr["threshold"], arr["left"], arr["right"],
                          arr["size"], int(psi), float(offset), int(samples), float(contamination))
