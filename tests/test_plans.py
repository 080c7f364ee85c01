"""What the physical plans of the registered queries must and must not hold."""

from __future__ import annotations

import re

import pytest

from packhorse.plans import QUERIES
from packhorse.sources.contracts import CONTRACTS

FOLDER = "/root/testdata/sf0.001"
# Where the queries with one large key have more rows of it than `SMALL_CUT`.
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plans(spark):
    found = {}

    def plan(name: str, folder: str = FOLDER) -> str:
        if (name, folder) not in found:
            query = QUERIES[name](spark, folder)._jdf.queryExecution()
            found[name, folder] = query.executedPlan().toString()
        return found[name, folder]

    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(plans, name):
    plan = plans(name)
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert operator not in plan


def test_mart_reads_only_its_columns(plans):
    plan = plans("p09_revenue_mart")
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "l_orderkey:bigint,l_extendedprice:double,l_discount:double" in read
    assert "c_custkey:bigint,c_nationkey:int" in read


def test_mart_sums_lines_before_their_only_shuffle(plans):
    plan = plans("p09_revenue_mart")
    lines = [line for line in plan.splitlines() if "l_orderkey" in line and "Exchange" in line]
    assert len(lines) == 1


@pytest.mark.parametrize("name", ["p03_valid", "p03_rejected", "p04_customer", "p05_flatten"])
def test_row_operators_do_not_shuffle(plans, name):
    assert "Exchange" not in plans(name)


def test_rules_reach_the_scan(plans):
    plan = plans("p03_valid")
    assert "GreaterThanOrEqual(l_quantity,1.0)" in plan[plan.index("PushedFilters"):]


@pytest.mark.parametrize("name", ["p11_running", "p14_history", "p14_history_of_changes", "p15_as_of"])
def test_ordered_windows_take_one_shuffle(plans, name):
    assert plans(name).count("Exchange hashpartitioning") == 1


def test_latest_rows_are_limited_before_the_shuffle(plans):
    plan = plans("p06_dedupe")
    after = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in after and "Partial" in after


def test_purchases_and_views_are_filtered_in_the_scan(plans):
    plan = plans("p15_as_of")
    assert "EqualTo(event_type,purchase)" in plan and "EqualTo(event_type,view)" in plan


@pytest.mark.parametrize(
    "name", ["p11_running", "p14_history", "p15_as_of", "p20_sessions"]
)
def test_a_large_key_is_cut(plans, name):
    assert "_chunk" not in plans(name)
    assert "_chunk" in plans(f"{name}_one_large_key", LARGER)


def test_rows_of_a_large_key_are_not_shuffled(plans):
    """They meet their parents, one row per large key, in a broadcast."""
    plan = plans("p07_orphans_one_large_key", LARGER)
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 3


@pytest.mark.parametrize("name", ["p02_csv_accepted", "p02_csv_quarantine", "p02_csv_required", "p02_csv_records"])
def test_csv_is_parsed_once(plans, name):
    plan = plans(name)
    assert plan.count("from_csv(") == 1 or (name == "p02_csv_records" and plan.count("from_csv(") <= 3)


@pytest.mark.parametrize("name", ["p02_json_accepted", "p02_json_quarantine", "p02_json_required", "p05_flatten_torn"])
def test_json_is_parsed_once(plans, name):
    assert plans(name).count("from_json(") == 1


def test_distinct_values_of_all_columns_take_one_scan(plans):
    """One for the bounds, one for the distinct values, and no sort."""
    plan = plans("p22_profile")
    assert plan.count("FileScan") == 2 * len(CONTRACTS)
    assert len([line for line in plan.splitlines() if "Exchange hashpartitioning(number" in line]) == 2 * len(CONTRACTS)


def test_changes_are_found_without_a_sort(plans):
    plan = plans("p13_changes")
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
