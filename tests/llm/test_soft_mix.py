import random

import edge_cases as E
import numpy as np
import pytest
from pyspark.sql import functions as F

from streetpulse.llm import soft_mix as S

POST = "doc_id long, n_tokens long, p_good double, p_good_toxic double, p_poor double, p_poor_toxic double"


def brute(tokens, p, targets, steps=20_000):
    """The same least squares by plain projected gradient in numpy."""
    total = tokens.sum()
    want = np.array([targets[d] for d in S.DOMAINS]) * total
    scale = np.maximum(p.T @ tokens, 1e-9 * total)
    a = (p * np.sqrt(tokens)[:, None]).T / np.sqrt(scale)[:, None]      # in y = x sqrt(t)
    y = np.sqrt(tokens).astype(float)
    eta = 1 / np.linalg.eigvalsh(a @ a.T).max()
    for _ in range(steps):
        y = np.maximum(0, y - eta * a.T @ (a @ y - want / np.sqrt(scale)))
    return y / np.sqrt(tokens)


def posteriors(n, seed=4, soft=0.02):
    rng = np.random.default_rng(seed)
    kind = rng.choice(4, n, p=[0.7, 0.08, 0.17, 0.05])
    p = np.eye(4)[kind] * (1 - 4 * soft) + soft
    p = p * rng.uniform(0.9, 1.1, p.shape)
    return kind, rng.integers(1, 900, n), p / p.sum(1, keepdims=True)


def table(spark, tokens, p):
    return spark.createDataFrame([(i, int(t), *map(float, q)) for i, (t, q) in enumerate(zip(tokens, p))], POST)


def test_rates_approach_the_least_squares_solution(spark):
    kind, tokens, p = posteriors(400)
    rows, taken = S.fit_rates(table(spark, tokens, p), steps=120)
    x = np.array([r.rate for r in rows.orderBy("doc_id").collect()])
    want = brute(tokens, p, S.TARGETS)
    assert np.abs(x @ (p * tokens[:, None]) - want @ (p * tokens[:, None])).max() < 0.01 * tokens.sum()
    assert (x[np.isin(kind, (1, 3))] == 0).all() and (x[np.isin(kind, (0, 2))] > 0).all()
    again = np.ones(len(p))
    for step in taken:
        again = np.maximum(0, again - p @ step)
    assert np.allclose(x, again)


def test_reachable_targets_are_met(spark):
    _, tokens, p = posteriors(300, 8, 0.05)
    targets = {"good": 0.5, "good_toxic": 0.2, "poor": 0.2, "poor_toxic": 0.1}
    rows, _ = S.fit_rates(table(spark, tokens, p), targets, steps=300)
    x = np.array([r.rate for r in rows.orderBy("doc_id").collect()])
    shares = x @ (p * tokens[:, None]) / tokens.sum()
    assert np.allclose(shares, [targets[d] for d in S.DOMAINS], atol=2e-3)


def labelled(spark, n=900):
    rng = random.Random(2)
    common = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(common, k=rng.randrange(40, 160))
        good, toxic = i % 5 != 0, i % 7 == 0
        if toxic:
            words += rng.choices(["moron", "scum", "clown"], k=3)
        if not good:
            words = [w + "%%%" for w in words]
        rng.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 1))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    labels += [(2, None, 1), (None, 1, 1), (4, 7, 0)]
    return spark.createDataFrame(docs, E.SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_rates(spark):
    docs, labels = labelled(spark)
    rows = S.mixing_rates(docs, labels).collect()
    assert len(rows) == 900
    unseen = [r for r in rows if r.doc_id % 2 == 0]
    right = [max(S.DOMAINS, key=lambda d, r=r: r[f"p_{d}"]) ==
             ("good" if r.doc_id % 5 else "poor") + ("" if r.doc_id % 7 else "_toxic") for r in unseen]
    assert np.mean(right) > 0.98
    assert np.mean([(r.rate == 0) == (r.doc_id % 7 == 0) for r in unseen]) > 0.98


def test_mixed_documents_have_the_same_rates(spark):
    docs, labels = labelled(spark, 300)
    rates = {r.doc_id: r.rate for r in S.mixing_rates(docs, labels).collect()}
    df = E.with_extra(docs).withColumn("mix_rate", F.lit("mine"))
    out = S.mixed_documents(df, labels)
    assert out.columns == [*df.columns, "mix_rate_"]
    got = {r.doc_id: r["mix_rate_"] for r in out.collect()}
    assert got == {i: pytest.approx(x) for i, x in rates.items() if x > 0}


def test_edge_cases_and_empty(spark):
    docs, labels = labelled(spark, 60)
    none = spark.createDataFrame([], labels.schema)
    for l in (labels, none):
        rows = S.mixing_rates(E.with_extra(E.documents(spark)), l).collect()
        assert len(rows) == len(E.ROWS) and all(r.rate >= 0 for r in rows)
        assert {r.n_tokens for r in rows if r.doc_id in (4, 5, 6)} == {0}
        assert S.mixing_rates(E.empty(spark), l).count() == 0 and S.mixed_documents(E.empty(spark), l).count() == 0
        both = [r.rate for r in rows if r.doc_id == 1]
        assert len(both) == 2 and both[0] == both[1]
    one = spark.createDataFrame([(i, 1, 0) for i in range(60)], labels.schema)
    assert S.mixing_rates(docs, one).count() == 60


def test_rates_are_those_of_the_minimum(spark):
    """Soft posteriors and zero targets: the projected gradient of the stated sum of squares is zero."""
    rng = np.random.default_rng(3)
    good, toxic = (1 / (1 + np.exp(-(np.where(rng.random(3000) < share, 2, -2) + rng.normal(0, 1, 3000)))) for share in (0.8, 0.1))
    p = np.stack([good * (1 - toxic), good * toxic, (1 - good) * (1 - toxic), (1 - good) * toxic], 1)
    tokens = rng.integers(1, 900, 3000)
    rows, _ = S.fit_rates(table(spark, tokens, p))
    x = np.array([r.rate for r in rows.orderBy("doc_id").collect()])
    start, total = p.T @ tokens, tokens.sum()
    error = (p.T @ (x * tokens) - np.array([S.TARGETS[d] for d in S.DOMAINS]) * total) / start
    slope = p @ error + S.RIDGE * (x - 1)
    assert np.abs(slope[x > 0]).max() < 1e-6 and slope[x == 0].min() > -1e-6 and (x == 0).any()
    with pytest.raises(RuntimeError):
        S.fit_rates(table(spark, tokens, p), steps=2)
