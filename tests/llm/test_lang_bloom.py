import zlib

import edge_cases as E
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from streetpulse.llm import lang_bloom as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    rows = L.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_filters_have_no_false_negatives_and_known_false_positives():
    rng = np.random.default_rng(1)
    grams = {lang: rng.integers(0, 1 << 63, 3000, dtype=np.uint64) for lang in ("de", "en", "fr")}
    f = L.build_filters(grams)
    for i, lang in enumerate(sorted(grams)):
        assert (f.lookup(grams[lang])[:, 0] >> i & 1 == 1).all()
        other = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)
        assert f.counts(other)[i] / len(other) == pytest.approx(f.false_rate[i], abs=5e-4)


@pytest.mark.parametrize("n", [3, 12, 130])
def test_masks_of_any_number_of_languages(n):
    rng = np.random.default_rng(n)
    grams = {f"l{i:03}": rng.integers(0, 1 << 63, 50, dtype=np.uint64) for i in range(n)}
    f = L.build_filters(grams)
    for i, lang in enumerate(f.languages):
        assert f.counts(grams[lang])[i] == 50 and int(np.argmax(f.counts(grams[lang]))) == i


def test_chosen_ids_are_those_of_least_hash(spark):
    ids = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "en").otherwise("de").alias("lang"))
    rows = ids.withColumn("h", F.xxhash64("doc_id")).collect()
    for sample in (1, 50, 400, 100_000):
        got = {(r.doc_id, r.lang) for r in L._least_hashes(ids, sample).collect()}
        want = {(r.doc_id, r.lang) for lang in ("en", "de")
                for r in sorted((r for r in rows if r.lang == lang), key=lambda r: (r.h, r.doc_id))[:sample]}
        assert got == want


def test_repeated_rows_teach_once(spark):
    rows = [(i, "the cat and the dog " + "x" * i, "en", "s", 1) for i in range(40)] + \
           [(100 + i, "der hund und die katze " + "y" * i, "de", "s", 1) for i in range(40)]
    once = L.fit_filters(spark.createDataFrame(rows, E.SCHEMA))
    often = L.fit_filters(spark.createDataFrame(rows + rows[:1] * 500, E.SCHEMA))
    assert once.languages == often.languages and (once.masks == often.masks).all()


def test_letters():
    assert "".join(map(chr, L.letters("  Ab1c--DÉ 9"))) == " ab c dé "
    assert len(L.letters(None)) == len(L.letters("12 !")) == len(L.letters("")) == 0
    assert "".join(map(chr, L.letters("x"))) == " x "


def test_edge_cases(spark):
    train = [(i, "the cat and the dog " * 3, "en", "s", 1) for i in range(40)] + \
            [(100 + i, "der hund und die katze " * 3, "de", "s", 1) for i in range(40)]
    more = E.ROWS + [(900, "die katze und der hund", None, None, None), (901, "12 34 !", "en", "s", 1),
                     (902, "the dog and the cat", "de", "s", 1)]
    df = E.with_extra(spark.createDataFrame(train + more, E.SCHEMA)).withColumn("lang_pred", F.lit("x"))
    got = {r.doc_id: r for r in L.identify(spark, df).collect()}
    assert L.identify(spark, df).count() == len(train) + len(more)
    assert got[900].lang_pred == "de" and got[902].lang_pred == "en"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (4, 5, 6, 901)) and got[None].held_out is False
    assert L.identify(spark, E.empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, "abc", None, None, 1), (None, "abc", "en", None, 1)], E.SCHEMA)
    assert {r.lang_pred for r in L.identify(spark, nothing).collect()} == {"und"}
