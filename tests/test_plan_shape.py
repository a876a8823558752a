"""Plan-shape guards: no row-at-a-time Python, no cartesian or nested-loop joins,
and scans read only what the query needs."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PYTHON_ALLOWED = {"xlsx_scan", "cell_type_inference"}  # the workbook decoder (mapInPandas)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_rows_no_pairwise_joins(spark, name):
    df = E.queries()[name](spark, SF)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    if name not in PYTHON_ALLOWED:
        assert "MapInPandas" not in plan and "PythonMapInArrow" not in plan


def test_projection_reaches_the_scan(spark):
    plan = _plan(E.queries()["select_rename"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["merge_upsert"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan
