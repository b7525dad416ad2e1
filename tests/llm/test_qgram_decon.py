import random

import edge_cases as E
import pytest

from streetpulse.llm import qgram_decon as Q


def distance(item, data):
    """Least edits of the whole item against any part of the data."""
    row = [0] * (len(data) + 1)
    for i in range(1, len(item) + 1):
        now = [i] + [0] * len(data)
        for j in range(1, len(data) + 1):
            now[j] = min(row[j - 1] + (item[i - 1] != data[j - 1]), row[j] + 1, now[j - 1] + 1)
        row = now
    return min(row)


def edited(rng, text, n):
    w = list(text)
    for _ in range(n):
        k, r = rng.randrange(len(w)), rng.random()
        if r < 1 / 3:
            w[k] = rng.choice("abcxyz")
        elif r < 2 / 3:
            w.insert(k, rng.choice("abcxyz"))
        elif len(w) > 1:
            del w[k]
    return "".join(w)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_whole_budget_is_found_and_nothing_above_it():
    rng = random.Random(3)
    found = 0
    for _ in range(80):
        item = words(rng, rng.randrange(6, 40))
        ix = Q.build_index([(5, item)])
        text = words(rng, rng.randrange(0, 12)) + " " + edited(rng, item, rng.randrange(0, len(item) // 7 + 1)) \
            + " " + words(rng, rng.randrange(0, 12))
        true = distance(Q.normalised(item), Q.normalised(text))
        got = Q.occurrences(text, ix)
        assert bool(got) == (true <= ix.edits[0])
        if got:
            found += true > 0
            assert got[0][0] == 5 and got[0][3] == true
            start, end = got[0][1:3]
            part = Q.normalised(text[start:end])
            assert distance(Q.normalised(item), part) == true
    assert found > 15


def test_spans_are_code_points_of_the_text():
    item = "The quick brown fox jumps over the lazy dog and runs away"
    text = "Ééé 😀!!  İ " + "THE quick,\n\nbrown...fox JUMPS over the lazy-dog and runs away" + " ök"
    (got,) = Q.occurrences(text, Q.build_index([(1, item)]))
    assert text[got[1]:got[2]] == "THE quick,\n\nbrown...fox JUMPS over the lazy-dog and runs away" and got[3] == 0


def test_bands_never_lose_the_lemma():
    rng = random.Random(9)
    for _ in range(40):
        item = words(rng, 30)
        ix = Q.build_index([(1, item), (2, words(rng, 9))])
        n = int(ix.edits[0])
        text = words(rng, 50) + " " + edited(rng, item, n)
        if distance(Q.normalised(item), Q.normalised(text)) <= n:
            assert any(i == 0 for i, _, _ in Q.candidate_bands(Q.normalised(text), ix))


ITEM = "alpha5 alpha6 alpha7 alpha8 alpha9 alpha10 alpha11 alpha12 alpha13 alpha14 alpha15"


def benchmark(spark):
    rows = [(1, ITEM), (2, ITEM.upper()), (3, None), (4, ""), (5, "short"), (None, ITEM), (6, "w5 w6 w7 w8 w9 w10 w11 w12"),
            (7, "nowhere to be found in any document of this table at all")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_edge_cases(spark):
    docs = E.documents(spark)
    got = sorted(((r.doc_id, r.item_id) for r in Q.find_matches(spark, docs, benchmark(spark)).collect()), key=repr)
    want = [(i, k) for i in (1, 1, 2, 3, None) for k in (1, 2)] + [(7, 6)]
    assert got == sorted(want, key=repr)
    for r in Q.find_matches(spark, docs, benchmark(spark)).where("item_id = 1").collect():
        assert r.edits == 0 and E.TEXT[r.start:r.end] == ITEM


def test_filter_keeps_all_columns_and_clean_rows(spark):
    df = E.with_extra(E.documents(spark))
    out = Q.without_matches(spark, df, benchmark(spark))
    assert out.columns == df.columns and out.schema == df.schema
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted([4, 5, 6, None, 8, 9, 10, 11], key=repr)


def test_blocks_give_the_same_rows(spark, monkeypatch):
    docs = E.documents(spark)
    whole = sorted(map(repr, Q.find_matches(spark, docs, benchmark(spark)).collect()))
    monkeypatch.setattr(Q, "index_blocks", lambda b, f=Q.index_blocks: f(b, 60))
    assert len(Q.index_blocks(benchmark(spark))) > 3
    assert sorted(map(repr, Q.find_matches(spark, docs, benchmark(spark)).collect())) == whole


@pytest.mark.parametrize("rows", [[], [(1, "")]])
def test_empty_tables(spark, rows):
    none = spark.createDataFrame(rows, "item_id long, text string")
    assert Q.find_matches(spark, E.documents(spark), none).count() == 0
    assert Q.without_matches(spark, E.documents(spark), none).count() == len(E.ROWS)
    assert Q.find_matches(spark, E.empty(spark), benchmark(spark)).count() == 0
