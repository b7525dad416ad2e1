"""Every stage of the corpus pipeline against a brute-force version of it, on
its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline as P
import edge_cases as E
import pytest
from conftest import SF
from test_adapt_join import brute as brute_components
from test_blob_ledger import brute as brute_secrets
from test_qgram_decon import distance

from streetpulse.llm import line_quality, qgram_decon
from streetpulse.llm.tables import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input of each stage and, last, the result."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), "pipeline-test"))
    return [[r.asDict() for r in d.collect()] for d in docs]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_rules(steps):
    before, after = steps[0], {r["doc_id"]: r for r in steps[1]}
    norm = lambda x: " ".join(words(re.sub("[0-9]", "0", x.lower())))
    holders = defaultdict(dict)
    for r in sorted(before, key=lambda r: r["doc_id"]):
        for line in (r["text"] or "").split("\n"):
            if words(line):
                holders[r["source"], norm(line)].setdefault(r["text"], r["doc_id"])
    for r in before:
        w = words(r["text"])
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeated = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        base = len(w) < 50 or 100 * len(repeated) > 50 * len(w)

        def frequent(line, r=r):
            held = holders.get((r["source"], norm(line)), {}) if words(line) else {}
            return len(held) > line_quality.MAX_DOCS and min(held, key=held.get) != r["text"]
        lines = (r["text"] or "").split("\n")
        gone = sum(len(words(x)) for x in lines if frequent(x))
        kept = not base and 100 * gone <= line_quality.MAX_REMOVED_PERCENT * len(w)
        assert kept == (r["doc_id"] in after)
        if kept:
            assert after[r["doc_id"]]["text"] == "\n".join(x for x in lines if not frequent(x))


def test_near_duplicates(steps):
    labels = brute_components([(r["doc_id"], r["text"]) for r in steps[1]])
    assert sorted(r["doc_id"] for r in steps[2]) == sorted({c for _, _, c in labels})
    assert len(steps[2]) < len(steps[1])


def test_decontamination(steps, spark):
    items = [qgram_decon.normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in steps[3]}
    for r in steps[2]:
        data = qgram_decon.normalised(r["text"])
        assert not (r["doc_id"] in kept and any(i in data for i in items))
        if r["doc_id"] not in kept:
            assert any(distance(i, data) <= len(i) // 10 for i in items)


def test_secret_scans(steps):
    before = {r["doc_id"]: r for r in steps[3]}
    assert set(before) == {r["doc_id"] for r in steps[4]}
    for r in steps[4]:
        assert not brute_secrets(r["text"])
        assert (r["text"] == before[r["doc_id"]]["text"]) == (not brute_secrets(before[r["doc_id"]]["text"]))
        assert r["n_chars"] == len(r["text"])


def test_source_mixing(steps, spark):
    assert all(r["mix_rate"] > 0 for r in steps[5])
    assert {r["doc_id"] for r in steps[5]} <= {r["doc_id"] for r in steps[4]}
    more = SF.replace("0.001", "0.01")                       # enough labels to learn from
    docs = spark.read.parquet(f"{more}/documents.parquet")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{more}/labels.parquet").collect()}
    kept = {r.doc_id for r in P.STAGES[-1][1](spark, docs, more).collect()}
    assert sum(i not in kept for i, t in toxic.items() if t) > 0.8 * sum(toxic.values())
    assert sum(i in kept for i, t in toxic.items() if not t) > 0.9 * sum(1 - t for t in toxic.values())


def test_columns_and_run(steps, spark):
    assert all(list(r) == COLUMNS for s in steps[:-1] for r in s[:1])
    out = P.run(spark, SF)
    assert out.columns == [*COLUMNS, "mix_rate"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(r["doc_id"] for r in steps[5])


@pytest.mark.parametrize("make", [E.documents, E.empty])
def test_stages_keep_columns_on_edge_cases(spark, make):
    docs = E.with_extra(make(spark))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
    assert P.STAGES[-1][1](spark, docs, SF).columns[:-1] == docs.columns
    assert [n for n, _ in P.STAGES][0] == "quality rules"
