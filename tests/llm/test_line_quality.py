import duckdb
import edge_cases as E
import pytest

from streetpulse.llm import line_quality as L

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
           "n_removed_lines"]


def oracle(df):
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({L.LINE_FREQUENCY_SQL})").fetchall(), key=repr)


def rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def body(i, n=60):
    return " ".join(f"own{i}x{k}" for k in range(n))


LINE = "This  Page 12 was\tprinted " + " ".join(f"often{k}" for k in range(100))


def boilerplate(spark):
    docs = [(i, LINE.replace("12", str(10 + i)) + "\n" + body(i), "en", "h", 1) for i in range(14)]       # 36 % own words
    docs += [(20 + i, LINE + "\n" + body(20 + i, 30).replace(" ", "  ") + "\n\n", "en", "h", 1) for i in range(3)]
    docs += [(30 + i, LINE + "\n" + body(30 + i, 55), "en", f"h{i}", 1) for i in range(5)]              # other hosts
    docs += [(40 + i, "\n".join([body(99), body(98)]), "en", "h", 1) for i in range(40)]                 # exact copies
    return spark.createDataFrame(docs, E.SCHEMA)


def test_edge_cases_equal_sql(spark):
    df = E.documents(spark)
    assert rows(L.line_frequency(df)) == oracle(df)


def test_frequent_lines_deplete(spark):
    df = boilerplate(spark)
    got = L.line_frequency(df)
    assert rows(got) == oracle(df)
    by = {r.doc_id: r for r in got.collect()}
    assert by[0].kept and by[0].n_removed_lines == 0            # the first holder keeps its line
    assert by[5].kept and by[5].n_removed_lines == 1            # 60 of 165 words stay
    assert not by[20].kept and not by[20].base_failed           # 30 of 135 stay
    assert all(by[30 + i].kept and by[30 + i].n_removed_lines == 0 for i in range(5))
    assert all(by[40 + i].kept for i in range(40))              # copies of one text count once


def test_cleaned_documents(spark):
    df = boilerplate(spark)
    verdict = {r.doc_id: r for r in L.line_frequency(df).collect()}
    out = {r.doc_id: r for r in L.cleaned_documents(E.with_extra(df)).collect()}
    assert set(out) == {i for i, r in verdict.items() if r.kept}
    assert out[5].text == body(5) and out[5].n_chars == len(body(5))
    assert out[0].text.startswith("This") and out[30].text.startswith("This") and out[41].text == body(99) + "\n" + body(98)
    assert L.cleaned_documents(E.with_extra(df)).columns == E.with_extra(df).columns


@pytest.mark.parametrize("text, n", [("a b a b a b", 6), ("a b c a b c", 6), ("a a a a", 4), ("a b c d a b c", 6),
                                     ("a b c", 0), ("a b", 0), ("x a b c y a b c z", 6)])
def test_words_in_repeated_windows(spark, text, n):
    df = spark.createDataFrame([(1, text, "en", "a", 1)], E.SCHEMA)
    assert L.base_measures(df).first().n_repeat_words == n


def test_cleaned_edge_cases_and_empty(spark):
    df = E.with_extra(E.documents(spark))
    kept = [r for r in L.line_frequency(df).collect() if r.kept]
    out = L.cleaned_documents(df)
    assert out.columns == df.columns and out.count() == len(kept)
    assert L.line_frequency(E.empty(spark)).count() == 0 and L.cleaned_documents(E.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    df = E.documents(spark)
    for out in (L.line_frequency(df), L.cleaned_documents(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
