"""The registered queries on the small tables: contract columns and types, row
counts, and the SQL twins."""

import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as E

CONTRACT = {
    "op1_warc_segments": ("pages", "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
                                   "refers_to bigint"),
    "op2_line_frequency": ("documents", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
                                        "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"),
    "op3_disclosure": ("documents", "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                    "base_sha256 string, spans string"),
    "op4_soft_mixing": ("documents", "doc_id bigint, n_tokens bigint, rate double"),
    "op5_blob_ledger": ("documents", "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
                                     "spans string"),
    "op6_offset_masks": (None, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                               "loss_sha256 string, formatted_chars bigint"),
    "op7_bitmask_filters": ("documents", "doc_id bigint, held_out boolean, lang_pred string, score double"),
    "op8_wrapper_induction": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op9_adaptive_prefix_join": ("documents", "doc_id bigint, n_shingles bigint, component_id bigint"),
    "op10_qgram_decontamination": (None, "doc_id bigint, item_id bigint, start bigint, end bigint, edits bigint"),
    "op11_suffix_levels": ("documents", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    "op12_dual_tree": (None, "item_id bigint, rank int, doc_id bigint, score bigint"),
    "op13_persistent_audit": (None, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                                    "illegal bigint, cost bigint, audit string, repaired_sha256 string"),
}


@pytest.mark.parametrize("name", list(CONTRACT))
def test_contract_columns_and_rows(spark, name):
    table, columns = CONTRACT[name]
    df = E.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert all(kinds[c.split()[0]] == c.split()[1] for c in columns.split(", "))
    if table:
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_there_is_one_query_per_operator_and_the_pipeline():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", [n for n in CONTRACT if n in E.oracle_sql()])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t)}.parquet'")
    want = con.execute(E.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = E.queries()[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
