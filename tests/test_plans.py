"""Plan properties as regression tests: for the relational queries, no
Cartesian or nested-loop joins, no Python UDF nodes, and column pruning at
the events scan (the unused ``props`` column is never read)."""

import pytest

from conftest import SF

from streetpulse.plans.catalog import QUERIES

STREAMING_OR_MODELS = {"T1", "T1_multi", "T2", "S4", "T4", "T4_multi", "T6", "T6_multi", "T7_stream", "S8_stored", "S5", "T9_stream", "T3_stream", "T1_chained", "T3_chained", "T8", "A19",
                       "M1", "A21", "M2", "M3", "M4", "M4_importances", "M5", "M6", "M8", "A18_models", "M9",
                       "M11"}
RELATIONAL = [k for k in QUERIES if k not in STREAMING_OR_MODELS]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_relational_plan_properties(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    for line in plan.splitlines():
        if "FileScan parquet" in line and "events.parquet" in line:
            assert "props" not in line.split("ReadSchema:")[-1], f"{name}: events scan reads props"


@pytest.mark.parametrize("name, scans, exchanges", [("A1", 1, 1), ("T3", 1, 2), ("T5", 3, 3), ("Q3", 1, 1), ("P2", 2, 1),
                                                    ("Q4", 7, 9)])
def test_scans_and_exchanges(spark, name, scans, exchanges):
    """At most this many reads of ``events`` and shuffles (scalar subqueries included, where they are printed)."""
    plan = _plan(QUERIES[name](spark, SF))
    assert plan.count("FileScan parquet") <= scans and plan.count("Exchange ") - plan.count("BroadcastExchange ") <= exchanges
