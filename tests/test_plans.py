"""Plan properties: no cross join and no Python UDF in any registered
plan, and the pushdowns the design relies on."""

import __spark_entry__ as E

# Operators no registered plan may contain (checked for every query in
# test_registry_oracles, on the same DataFrame that is compared).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def forbidden_in(df) -> list[str]:
    plan = plan_of(df)
    return [f for f in FORBIDDEN if f in plan]


_plan = plan_of


def test_pushdowns(spark, sf):
    q = E.queries()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in \
        _plan(q["extract_incremental"](spark, sf))
    assert "EqualTo(l_suppkey,17)" in _plan(q["optional_filter_on"](spark, sf))
    assert "EqualTo(job_inst_id,7)" in _plan(q["run_scope"](spark, sf))
    cat = _plan(q["task_catalog"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in cat
