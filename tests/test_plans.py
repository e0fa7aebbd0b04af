"""Properties of the plans of all registered queries that matter at scale."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# The operators for training data have tests of their own.
QUERIES = sorted(n for n in entry.queries() if not n.startswith(("op", "pipeline")))


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_rows_no_pairs(spark, name):
    plan = plan_of(spark, name)
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in plan, node


def test_quality_run_scans_twice(spark):
    """One scan for plain metrics, one for all that ask for value frequencies, whatever their sets of columns."""
    for name in ("a22_analysis_run", "a13_mutual_information"):
        plan = plan_of(spark, name)
        assert plan.count("FileScan") == (2 if name == "a22_analysis_run" else 1), name
        assert plan.count("Expand") == 1


def test_states_are_merged_without_the_rows(spark):
    assert "lineitem.parquet" not in plan_of(spark, "a22_states_of_batches")


def test_cascade_joins_once_per_key_column(spark):
    """Two rules, one of them dated, look up by one column."""
    plan = plan_of(spark, "v10_derive_cascade")
    assert plan.count("LeftOuter") == 1


def test_documents_are_parsed_once(spark):
    for name in ("f04_flatten_custom", "f04_flatten_generic", "f04_flatten_conversations"):
        assert "parse_json" not in plan_of(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["s01_file_scan"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,400000.0)" in plan
    assert "o_orderpriority" not in plan


def test_partitioned_table_is_pruned(spark):
    plan = entry.queries()["k03_partitioned_table"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_year" in plan
