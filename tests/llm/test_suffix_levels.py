"""Removed bytes against all 50-byte windows of all documents."""

import hashlib
import random

import numpy as np
import pytest
from edge_cases import documents, empty, with_extra

from streetpulse.llm import suffix_levels as S


def plain(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by a table of windows."""
    held = [(d, (t or "").encode()) for d, t in rows]
    key = lambda d: S.NO_ID if d is None else d
    first = {}
    for d, b in held:
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            first[w] = min(first.get(w, S.NO_ID), key(d))
    out = []
    for d, b in held:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < key(d):
                gone[i:i + 50] = True
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def found(spark, df, **more):
    return sorted(map(tuple, S.deduplicated(spark, df, **more).collect()), key=repr)


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(k):
        return " ".join(rng.choice(words) for _ in range(k))
    passages = [prose(rng.randint(10, 40)) for _ in range(8)]
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)                                      # copy
        elif texts and kind < 0.45:
            text = rng.choice(texts)                                      # near copy
            for _ in range(rng.randint(1, 4)):
                at = rng.randrange(len(text) + 1)
                text = text[:at] + rng.choice(["", "X", "zz"]) + text[at + rng.randint(0, 2):]
        else:
            text = prose(rng.randint(0, 90))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(passages)[rng.randint(0, 5):] + text[at:]
        texts.append(text)
        rows.append((rng.randrange(10 * n) if rng.random() < 0.97 else None, text))
    rows += rows[3:6] + [(i, "ab" * rng.randint(20, 200)) for i in range(5)] + [(7, "q" * 49), (8, "q" * 50), (9, "q" * 51)]
    return rows


@pytest.mark.parametrize("seed, changes, batches", [
    (1, {}, 4), (2, {"CHUNK_BYTES": 2000}, 5), (3, {"CHUNK_BYTES": 3000, "HOT": 3, "PART_ENTRIES": 100}, 3),
    (4, {"CHUNK_BYTES": 1, "HOT": 20, "BLOCK": 300, "ROWS": 16}, 2), (5, {"CHUNK_BYTES": 5000, "HOT": 0}, 1)])
def test_removed_bytes_are_those_of_all_windows(spark, monkeypatch, seed, changes, batches):
    for name, value in changes.items():
        monkeypatch.setattr(S, name, value)
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(spark, df, n_batches=batches) == plain(rows)


def test_edge_cases_and_clashing_columns(spark):
    df = documents(spark)
    want = plain([(r["doc_id"], r["text"]) for r in df.collect()])
    assert found(spark, df) == want
    assert found(spark, with_extra(df)) == want


def test_empty_table_and_no_text(spark):
    assert found(spark, empty(spark)) == []
    df = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert found(spark, df) == plain([(1, None), (2, ""), (None, None)])


def test_every_window_holds_an_anchor_at_the_same_place(monkeypatch):
    rng = np.random.default_rng(5)
    a = rng.integers(97, 101, 5000).astype(np.uint8)
    b = np.concatenate([rng.integers(97, 101, 777).astype(np.uint8), a[1000:3000], a[:50]])
    mine, other = S.anchors(a, np.empty(0, int)), S.anchors(b, np.empty(0, int))
    assert all(np.any((mine >= i) & (mine <= i + S.ROOM)) for i in range(len(a) - 49))
    inner = mine[(mine >= 1000 + S.ROOM) & (mine < 3000 - S.LENGTH)]
    assert set(inner - 1000 + 777) <= set(other)
    monkeypatch.setattr(S, "BLOCK", 97)
    assert np.array_equal(S.anchors(a, np.empty(0, int)), mine)


def test_levels_merge_geometrically():
    """A scan with carried levels keeps one entry a suffix, reports new hits
    once, and leaves other levels alone."""
    import pandas as pd

    def array(words):
        return np.array([[w, w] for w in words], np.uint64)

    def batch(chunk, words):
        w = array(words)
        return (0, -1, chunk, S._packed(S._planes(w), np.ones(len(w), np.uint8), np.zeros(len(w), bool)))

    def scan(rows, *rest):
        out = S._merge_scan(*rest)(pd.DataFrame(rows, columns=["part", "level", "chunk", "body"]))
        hits = {r.chunk: S._words_of(S._unpacked(r.body)[0])[:, 0].tolist() for r in out.itertuples() if r.kind == "hit"}
        return hits, [(0, r.level, -1, r.body) for r in out.itertuples() if r.kind == "level"]
    hits, level0 = scan([batch(1, [1, 2, 3]), batch(2, [3, 4])], frozenset(), 0, 100)
    assert hits == {1: [3], 2: [3]}
    hits, level1 = scan([batch(3, [2, 3, 9])] + level0, frozenset({0}), 1, 100)
    assert hits == {1: [2], 3: [2, 3]}
    planes, counts, known, index, chunks = S._unpacked(level1[0][3])
    assert level1[0][1] == 1 and S._words_of(planes)[:, 0].tolist() == [1, 2, 3, 4, 9]
    assert counts.tolist() == [1, 2, 3, 1, 1] and known.tolist() == [False, True, True, False, False]
    hits, none = scan([batch(4, [9, 3])] + level1, frozenset(), -1, 100)
    assert hits == {3: [9], 4: [3, 9]} or hits == {3: [9], 4: [9, 3]} and none == []


def test_texts_are_not_shuffled(spark):
    chunks, name = S._bucketed(spark.range(3).selectExpr("id AS chunk", "CAST('x' AS binary) AS body"))
    hits = spark.range(9).selectExpr("id % 3 AS chunk", "id AS hit").groupBy("chunk").count()
    plan = chunks.join(hits.hint("merge"), "chunk", "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(chunk") == 1 and "Bucketed: true" in plan
    spark.sql(f"DROP TABLE {name}")
