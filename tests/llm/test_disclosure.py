import hashlib
import math
import random
import re
from collections import Counter

import edge_cases as E
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streetpulse.llm import disclosure as D

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="aZ9@.-+ %é\n", max_size=40))
def test_base_spans_of_any_text(text):
    assert [s[:3] for s in D.base_spans(text)] == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789 .-+()", max_size=60))
def test_base_spans_of_numbers(text):
    assert [s[:3] for s in D.base_spans(text)] == plain(text)


@pytest.mark.parametrize("text", ["a@b.c@d.e@f.g", "x@@y.z", "a.b@c a@b.co. 4111 1111 1111 1111", "+1 (017) 555-7713",
                                  "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.255", "@a.b", "é@x.yz a@é.b"])
def test_base_spans_of_hard_texts(text):
    assert [s[:3] for s in D.base_spans(text)] == plain(text)


def test_long_texts_take_linear_time():
    for text in ("9" * 300_000 + "@", "a" * 300_000 + "@", "1." * 150_000, "a@" * 100_000, "+" * 300_000, "a.@" * 99_999):
        D.base_spans(text)


def brute_terms(rows):
    """Added spans of each row by counting over all texts."""
    texts = [t or "" for _, t in rows]
    has = [set(D.normalised(t).decode().split()) for t in texts]
    near = [D.nearby_terms(t, D.base_spans(t)) for t in texts]
    n, out = len(rows), []
    of_term = Counter(t for h in has for t in h)
    of_entity = Counter(e for x in near for e in {y[0] for y in x})
    both = Counter(p for x in near for p in {y[:2] for y in x})
    for x in near:
        spans = set()
        for e, t, a, b in x:
            if both[e, t] >= D.SUPPORT and of_entity[e] < n:
                pmi = math.log2(n * both[e, t] / (of_entity[e] * of_term[t]))
                if pmi / math.log2(n / of_entity[e]) >= D.GENERALISE:
                    spans.add((a, b))
        out.append(sorted(spans))
    return out


def corpus():
    rng = random.Random(6)
    words = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = rng.choices(words, k=rng.randrange(5, 60))
        if i % 10 == 0:
            w[len(w) // 2:len(w) // 2] = ["Zebra", "Doctor", f"bob{i % 3}@mail.example.com", "of", "Springfield", "2024"]
        if i % 30 == 1:
            w += ["call", "+1 (017) 555-7713", "Unicorn"]
        if i % 4 == 0:
            w += ["doctor", "of"]
        rows.append((i, " ".join(w)))
    return rows + [rows[10], (None, rows[20][1]), (None, None), (500, "")]


def test_added_terms_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS term", "2 AS n", "3 AS base")
    got = sorted(((r.doc_id, r.spans) for r in D.personal_data(spark, df).collect()), key=repr)
    want, added = [], 0
    for (i, t), terms in zip(rows, brute_terms(rows)):
        added += len(terms)
        want.append((i, ",".join([":".join(map(str, s)) for s in plain(t or "")] + [f"term:{a}:{b}" for a, b in terms])))
    assert got == sorted(want, key=repr) and added > 20


def test_clean_documents_are_left_alone(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    for r in D.personal_data(spark, df).collect():
        if not r.n_email + r.n_ip + r.n_card + r.n_phone:
            assert r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest()
    out = {r.doc_id: r.text for r in D.sanitised_documents(spark, df).collect() if r.doc_id is not None}
    for i, t in corpus():
        if i is not None:
            assert (out[i] == t) == (not plain(t or ""))
            assert not plain(out[i] or "")
    assert "Springfield" not in out[10] and "[EMAIL]" in out[10]


def test_edge_cases_and_empty(spark):
    df = E.with_extra(E.documents(spark))
    assert D.personal_data(spark, df).count() == len(E.ROWS)
    out = D.sanitised_documents(spark, df)
    assert out.columns == df.columns and out.count() == len(E.ROWS)
    assert D.personal_data(spark, E.empty(spark)).count() == 0 and D.sanitised_documents(spark, E.empty(spark)).count() == 0


def test_all_occurrences_go_and_far_terms_count(spark):
    """A disclosing name goes wherever it stands in the text, also if it never stands near the mention."""
    filler = " ".join(f"plain{i}" for i in range(40))
    rows = [(i, f"Write Miller at miller@mail.example.com now {filler} Miller {filler} Quagmire") for i in range(3)]
    rows = [(i, f"{t} end{i}") for i, t in rows] + [(100 + i, f"{filler} now write at end") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in D.sanitised_documents(spark, df).collect()}
    for i in range(3):
        assert "Miller" not in out[i] and "Quagmire" not in out[i] and "plain7" in out[i] and f"end{i}" in out[i]


def test_texts_without_entities_enter_no_join(spark):
    """They have no key: joined on it they would all meet in one task."""
    rows = [(i, f"plain words {i}") for i in range(300)] + [(900 + i, f"Miller at miller@mail.example.com {i}") for i in range(3)]
    out = D.personal_data(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.splitlines()[0].startswith("Union") and "isnull(text_key" in plan and "isnotnull(text_key" in plan
    assert out.count() == len(rows) and out.where("n_email = 0 AND spans != ''").count() == 0
