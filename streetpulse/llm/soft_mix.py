"""Soft-membership mixing of documents to target domain weights.

Domains are the four classes of the labels table (quality x toxic). Two
logistic regressions, fitted on a bounded sample of labelled rows, predict each
document's domain posteriors; every document of the corpus is scored on its
whole text. Rates x >= 0 are then fitted so that the expected tokens of each
domain, sum of rate * tokens * posterior, match the targets: least squares on
the relative errors of the domains plus ``RIDGE`` times the token-weighted
squares of rate - 1. Targets of zero cannot be met exactly with soft
posteriors; without the second term the best fit would put all weight on the
few documents least like the zero domains. With it the solution is unique.

At the solution the projected gradient is zero: rate = max(0, 1 - posteriors *
m) with one number m per domain. These four numbers minimise a convex function
and are found by Newton steps with halving. A pass is one aggregate of fifteen
numbers over the table. Passes end when no domain's total is off that condition
by more than ``TOLERANCE`` of all tokens; when ``STEPS`` passes do not get there,
the fit fails. Nothing of the size of the corpus is gathered anywhere.

Defined cases: a null text is empty, has no tokens and still gets a rate (its
posteriors' own); labels with a null, and several labels of one document, are
left out of or all used in the sample; without usable labels all posteriors are
equal; an empty table gives no rows; repeated rows are rows of their own with
equal rates.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetpulse.llm.qgram_decon import normalised
from streetpulse.llm.tables import stored

DOMAINS = ("good", "good_toxic", "poor", "poor_toxic")
# Share of the corpus tokens that each domain shall have after mixing.
TARGETS = {"good": 0.85, "good_toxic": 0.0, "poor": 0.15, "poor_toxic": 0.0}
SAMPLE = 10_000       # labelled rows to fit on, those with the smallest hash
WORDS = 256           # words used as features, those most telling by G-test
RIDGE = 0.01          # weight of staying at rate 1 against the errors of the domains
STEPS = 500           # safety limit; a handful of passes is usual
TOLERANCE = 1e-8      # of all tokens
_SYMBOLS, _DIGITS, _MARKS = b"#*$%&|<>", b"0123456789", b"!?"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def _without(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def shape(text: str | None) -> tuple[int, np.ndarray, set]:
    """(tokens, shape features, distinct words) of a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    tokens = data.split()
    words = normalised(text).split()
    distinct, lines = set(words), data.split(b"\n")
    n, size = max(1, len(tokens)), max(1, len(data))
    features = np.array([
        np.log1p(len(tokens)) / 10, len(data) / n / 10, len(distinct) / max(1, len(words)),
        _without(data, _SYMBOLS) / size * 10, _without(data, _DIGITS) / size * 10, _without(data, _MARKS) / size * 10,
        _without(data, _UPPER) / max(1, _without(data, _LETTERS)), len(set(lines)) / len(lines),
        float(len(tokens) < 50)])
    return len(tokens), features, distinct


N_SHAPE = 9


@dataclass
class Classifier:
    words: list = field(default_factory=list)
    quality: np.ndarray | None = None
    toxic: np.ndarray | None = None

    def __post_init__(self):
        self.place = {w: i for i, w in enumerate(self.words)}
        self.known = frozenset(self.words)

    def row(self, features: np.ndarray, distinct: set) -> np.ndarray:
        x = np.zeros(1 + N_SHAPE + len(self.words), np.float32)
        x[0], x[1:1 + N_SHAPE] = 1, features
        for w in self.known & distinct:
            x[1 + N_SHAPE + self.place[w]] = 1
        return x

    def posteriors(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and the posteriors of the four domains of each text. A text
        is scored from the weights of its own words, in their order, so that
        one text is held at a time and every pass gives the same sums."""
        tokens, scores = [], []
        for text in texts:
            n, features, distinct = shape(text)
            tokens.append(n)
            if self.quality is not None:
                own = 1 + N_SHAPE + np.sort(np.array([self.place[w] for w in self.known & distinct], np.int64))
                scores.append([w[0] + features @ w[1:1 + N_SHAPE] + w[own].sum() for w in (self.quality, self.toxic)])
        tokens = np.array(tokens, np.int64)
        if self.quality is None:
            return tokens, np.full((len(tokens), len(DOMAINS)), 1 / len(DOMAINS))
        good, toxic = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in np.array(scores, np.float64).reshape(-1, 2).T)
        return tokens, np.stack([good * (1 - toxic), good * toxic, (1 - good) * (1 - toxic), (1 - good) * toxic], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 15) -> np.ndarray:
    """Newton's method with a ridge on all weights but a weak one on the constant."""
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-2
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _word_counts(batches):
    counts: dict[bytes, Counter] = {}
    for pdf in batches:
        for text, q, t in zip(pdf["text"], pdf["quality"], pdf["toxic"]):
            for w in shape(text)[2]:
                counts.setdefault(w, Counter())[(int(q), int(t))] += 1
    rows = [(w, q, t, n) for w, c in counts.items() for (q, t), n in c.items()]
    yield pd.DataFrame(rows, columns=["word", "quality", "toxic", "n"])


def fit_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> Classifier:
    """Fit on at most ``sample`` labelled documents; everything collected is
    bounded by ``sample`` and ``words``."""
    chosen = labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND toxic IN (0, 1)").select(
        "doc_id", "quality", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample)
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "quality", "toxic"), "mix-sample")  # at most ``sample`` rows are broadcast
    totals = {(r["quality"], r["toxic"]): r["n"] for r in
              rows.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = sum(totals.values())
    if not size:
        return Classifier()
    counts = rows.repartition(8).mapInPandas(_word_counts, "word binary, quality int, toxic int, n long")
    per_word = counts.groupBy("word").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality") == 1, F.col("n")).otherwise(0)).alias("quality_n"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic_n")).where(F.col("n") >= 3)

    def told(label: str, of: int) -> Column:
        """G-test of a word's presence against a label."""
        n, k, all_n = F.col("n").cast("double"), F.col(f"{label}_n").cast("double"), float(size)

        def term(seen: Column, expected: Column) -> Column:
            return F.when((seen > 0) & (expected > 0), seen * F.log(seen / expected)).otherwise(0.0)
        cells = [(k, n * of), (n - k, n * (all_n - of)), (of - k, (all_n - n) * of),
                 ((all_n - n) - (of - k), (all_n - n) * (all_n - of))]
        return 2 * sum((term(seen, e / all_n) for seen, e in cells), F.lit(0.0))
    of = {"quality": sum(n for (q, _), n in totals.items() if q), "toxic": sum(n for (_, t), n in totals.items() if t)}
    best = {}
    for label in ("toxic", "quality"):
        for r in per_word.select("word", told(label, of[label]).alias("g")).where("g > 10").orderBy(
                F.desc("g"), "word").limit(words // 2).collect():
            best[bytes(r["word"])] = True
    model = Classifier(sorted(best))

    def vectors(batches):
        for pdf in batches:
            x = [model.row(f, d) for _, f, d in map(shape, pdf["text"])]
            yield pd.DataFrame({"x": [v.tobytes() for v in x], "quality": pdf["quality"], "toxic": pdf["toxic"]})
    got = rows.repartition(8).mapInPandas(vectors, "x binary, quality int, toxic int").collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got], np.float64)
    model.quality = logistic(x, np.array([r["quality"] for r in got], float))
    model.toxic = logistic(x, np.array([r["toxic"] for r in got], float))
    return model


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, n_tokens and the posteriors of every row."""
    fields = "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS)

    def score(batches):
        for batch in batches:
            tokens, p = model.posteriors(t.as_py() for t in batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens), *[pa.array(p[:, k]) for k in range(len(DOMAINS))]],
                names=[f.split()[0] for f in fields.split(", ")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, fields)


def _stepped(x: Column, step: np.ndarray) -> Column:
    move = sum((F.lit(float(s)) * F.col(f"p_{d}") for d, s in zip(DOMAINS, step)), F.lit(0.0))
    return F.greatest(F.lit(0.0), x - move)


def fit_rates(rows: DataFrame, targets: dict | None = None, steps: int = STEPS) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows with ``rate``, the steps that lead from rate 1 there) for scored, stored rows."""
    targets = targets or TARGETS
    p = [F.col(f"p_{d}") for d in DOMAINS]
    k = range(len(DOMAINS))

    def at(m: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        """Sum of tokens * rate^2, domain totals, second moments of the rows with a rate, all tokens."""
        rate, t = F.col("rate"), F.col("n_tokens")
        got = rows.withColumn("rate", _stepped(F.lit(1.0), m)).agg(
            F.sum(t).alias("all"), F.sum(t * rate * rate).alias("square"),
            *[F.sum(t * rate * a).alias(f"s{i}") for i, a in enumerate(p)],
            *[F.sum(F.when(rate > 0, t * p[i] * p[j]).otherwise(0.0)).alias(f"m{i}_{j}") for i in k for j in k[i:]]).first()
        if not got["all"]:
            return 0.0, np.zeros(len(p)), np.eye(len(p)), 0.0
        moments = np.array([[got[f"m{min(i, j)}_{max(i, j)}"] for j in k] for i in k], float)
        return float(got["square"]), np.array([got[f"s{i}"] for i in k], float), moments, float(got["all"])

    m = np.zeros(len(p))
    square, sums, moments, total = at(m)
    if not total:
        return rows.withColumn("rate", F.lit(1.0)), []
    want = np.array([targets[d] for d in DOMAINS]) * total
    scale = np.maximum(sums, 1e-9 * total)
    unit = np.sqrt(scale)

    def value(m: np.ndarray, square: float) -> float:
        return RIDGE * (scale * m * m).sum() / 2 + want @ m + square / 2

    def slope(m: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return RIDGE * scale * m + want - sums

    passes = 1
    while np.abs(slope(m, sums)).max() > TOLERANCE * total:
        g = slope(m, sums)
        move = -np.linalg.solve(moments / np.outer(unit, unit) + RIDGE * np.eye(len(p)), g / unit) / unit
        part, now = 1.0, value(m, square)
        while True:
            if passes >= steps:
                raise RuntimeError(f"rates not fitted in {steps} passes: totals off by {np.abs(g).max() / total:.1e} of all tokens")
            square, sums, moments, _ = at(m + part * move)
            passes += 1
            if value(m + part * move, square) <= now + 1e-4 * part * (g @ move) + 1e-12 * total:
                break
            part /= 2
        m = m + part * move
    return rows.withColumn("rate", _stepped(F.lit(1.0), m)), [m]


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict | None = None) -> DataFrame:
    """doc_id, n_tokens, posteriors and rate of every row of (doc_id, text)."""
    rows = stored(scored(docs, fit_classifier(docs, labels)), "mix-scored")
    return fit_rates(rows, targets)[0]


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict | None = None) -> DataFrame:
    """``docs`` with all columns and ``mix_rate``; rows with rate 0 go. A rate
    is a function of the posteriors and the steps taken, so it is computed
    while the texts are scored and nothing is joined back."""
    model = fit_classifier(docs, labels)
    _, taken = fit_rates(stored(scored(docs, model).drop("doc_id"), "mix-scored"), targets)
    steps = np.array(taken).reshape(-1, len(DOMAINS))
    name = "mix_rate"
    while name in docs.columns:
        name += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def rate(batches):
        for batch in batches:
            _, p = model.posteriors(t.as_py() for t in batch.column("text"))
            x = np.ones(len(p))
            for step in steps:
                x = np.maximum(0.0, x - p @ step)
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(x)], names=[*batch.schema.names, name])
            yield out.filter(pa.array(x > 0))
    return docs.mapInArrow(rate, schema)
