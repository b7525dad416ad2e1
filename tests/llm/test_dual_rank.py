"""The dual-tree search against a plain ranking of all pairs."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from edge_cases import documents, empty, with_extra
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streetpulse.llm import dual_rank as D

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranking(docs, items, k=10):
    """docs and items: (id, text) rows."""
    held = [(d, plain_terms(t)) for d, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = []
    for item, text in items:
        rows = []
        for doc, ts in held:
            tf, score = Counter(ts), 0
            m = 25 + 75 * len(ts) * n_docs // n_terms if ts else 0
            for t in plain_terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10):
    return sorted(map(tuple, D.ranked(spark, docs, items, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(df, name):
    return [(r[0], r[1]) for r in df.select(name, "text").collect()]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms_are_those_of_the_pattern(text):
    assert [t.decode("utf-8", "surrogatepass") for t in D.terms(D._utf8(text))] == plain_terms(text)


@pytest.mark.parametrize("exact", [D.EXACT, 0.0])
def test_search_finds_the_best_of_all_pairs_and_prunes(monkeypatch, exact):
    monkeypatch.setattr(D, "EXACT", exact)
    rng = np.random.default_rng(3)
    groups = rng.integers(0, 12, 3000)
    x = np.zeros((3000, 240), np.float32)
    for i, g in enumerate(groups):
        own = g * 20 + rng.choice(20, 6, replace=False)
        x[i, own] = rng.integers(1, 900_000, 6)
    x = x[np.argsort(groups, kind="stable")]
    items = []
    for g in range(12):
        own = np.sort(g * 20 + rng.choice(20, 8, replace=False))
        items.append((own, rng.integers(1, 20_000, 8).astype(float)))
    best = D.Best(np.ones(12, np.int64), 10)
    scored = []
    offer = best.offer
    monkeypatch.setattr(best, "offer", lambda item, scores, docs: (scored.append(len(scores)), offer(item, scores, docs)))
    D.search(D.item_tree(items), x, list(range(3000)), best)
    for i, (own, values) in enumerate(items):
        scores = x[:, own].astype(np.int64) @ values.astype(np.int64)
        want = sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:10]
        assert [(r[0], r[2]) for r in best.rows[i]] == want
    assert sum(scored) < 12 * 3000 / 8


def test_edge_cases(spark):
    docs = documents(spark)
    items = spark.createDataFrame([(1, "alpha1 alpha2 alpha2 ALPHA3!"), (1, "alpha1 alpha2 alpha2 ALPHA3!"), (2, None), (3, " .,"),
                                   (4, "nowhere to be found"), (None, "w5 one, two; w5"), (6, "x" * 200_000)],
                                  "item_id long, text string")
    want = plain_ranking(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert want and found(spark, docs, items) == want
    assert found(spark, with_extra(docs).withColumn("rank", F.lit(0)), with_extra(items)) == want
    assert found(spark, docs, items, 2) == plain_ranking(pairs(docs, "doc_id"), pairs(items, "item_id"), 2)


def test_ties_copies_blocks_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 100)
    monkeypatch.setattr(D, "BLOCK_BYTES", 20)
    monkeypatch.setattr(D, "SAMPLE", 3)
    texts = ["red green blue", "red green", "blue blue red", "é ü été", "green", "red red red red", ""]
    docs = spark.createDataFrame([(i, texts[(i * i + i // 50) % 7]) for i in range(400)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["red blue", "green été", "blue", "Blue été red green"])],
                                  "item_id long, text string")
    assert found(spark, docs, items) == plain_ranking(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "red")], "item_id long, text string")
    assert found(spark, empty(spark), items) == []
    assert found(spark, documents(spark), items.limit(0)) == []
    df = D.ranked(spark, documents(spark), items.limit(0))
    assert [t for _, t in df.dtypes] == ["bigint", "int", "bigint", "bigint"]
