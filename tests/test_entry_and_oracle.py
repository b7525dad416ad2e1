import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FAST = ["S2", "P1", "P2", "A1", "P9", "Q1", "J1", "J2", "A2", "Q3", "Q4", "T3", "T5", "B1", "P5", "P6", "T7",
        "A4", "A7", "A11", "A13", "Q5", "L1", "P10", "P12", "P15", "M7", "A18", "flagship"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and df.columns[:2] == ["sensor_type", "sensor_count"]


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_spark_equals_sql_on_sf0001(spark, name):
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    sdf = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(dcols)

    def norm(v):
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    a = sorted((tuple(norm(r[c]) for c in order) for r in sdf.collect()), key=repr)
    b = sorted((tuple(norm(r[dcols.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    assert a == b
