"""Physical-plan properties that matter at scale, checked on every query."""
import pytest

import __spark_entry__ as E
from aurum.plans.catalog import QUERIES
from conftest import SF_SMALL

# Queries whose callables write tables eagerly or train models; their plans
# are covered by the oracle tests.
EAGER = {"compact_table", "latest_version", "idempotent_overwrite", "incremental_landing", "inject_defect",
         "defect_drill", "run_record", "train_gbt", "feature_lift", "csv_landing", "json_lines_landing",
         "layered_build", "twice_landed_verdicts", "csv_corrupt_kept", "json_array_documents", "document_profile", "second_landing", "multi_file_landing", "apparatus_check"}
NAMES = sorted(set(QUERIES) - EAGER)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_fact_scan_is_column_pruned(spark):
    plan = E.queries()["gold_fact"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.splitlines() if "lineitem.parquet" in l]
    assert scan and all("l_returnflag" not in l and "l_linestatus" not in l for l in scan)


def test_small_dimensions_are_broadcast(spark):
    plan = _plan(E.queries()["gold_fact"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 3         # two zone roles + daily


def test_defect_profile_is_one_aggregate(spark):
    plan = _plan(E.queries()["defect_profile"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 4            # lineitem, orders, customer, supplier once each
    assert "Union" not in plan


def test_dedup_limits_groups_before_the_window(spark):
    plan = _plan(E.queries()["dedup_row_number"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan


def test_dedup_reads_only_what_the_consumer_needs(spark):
    plan = _plan(E.queries()["relationships_check"](spark, SF_SMALL))
    scan = [x for x in plan.splitlines() if "FileScan" in x and "lineitem.parquet" in x]
    assert scan and all("l_returnflag" not in x and "l_comment" not in x for x in scan)
    window = [x for x in plan.splitlines() if " Sort " in x and "order_key" in x]
    assert window and all("payment_type" not in x for x in window)


def test_reference_check_moves_distinct_values(spark):
    plan = _plan(E.queries()["relationships_check"](spark, SF_SMALL))
    assert "partial_count" in plan and "LeftAnti" in plan
