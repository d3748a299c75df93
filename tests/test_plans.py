"""Plan-shape checks: the properties the scale design relies on."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from larder.oracle import oracle_queries
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


KEYS = sorted(oracle_queries())


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_join_python_or_unpartitioned_window(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)
    # every window has a partition spec: "Window [...], [<partition keys>], [<order>]"
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"\], \[\], \[", line) and not line.rstrip().endswith("], []"), line


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["difference_days"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    orders = [s for s in schemas if "o_orderkey" in s]
    assert orders and all("o_orderpriority" not in s for s in orders)
    assert "lineitem" not in plan  # the participant list is not needed, its join is pruned


def test_big_side_aggregates_are_partial_hash_aggregates(spark):
    # every aggregate over the joined invoice rows (the ones summing prices) is a
    # hash aggregate with a map-side partial step; string minima only run later,
    # on reduced rows
    for key in ("customer_stats", "company_metrics", "company_metrics_by_meal",
                "customer_purchases", "sales_rep_performance"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        lines = [ln.strip(" +-:") for ln in plan.splitlines()]
        partial = [ln for ln in lines if "partial_sum(Meal_Price" in ln]
        assert partial, key
        assert all(ln.startswith("HashAggregate") for ln in partial), (key, partial)


LIMIT_IS_THE_FEATURE = {"top_converted", "preview_difference_days"}


@pytest.mark.parametrize("key", KEYS)
def test_no_row_caps_outside_report_limits(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    capped = any(op in plan for op in ("GlobalLimit", "CollectLimit", "TakeOrderedAndProject", "LocalLimit"))
    assert capped == (key in LIMIT_IS_THE_FEATURE), key
    assert ("LIMIT" in E.oracle_sql()[key].upper().split("WITH", 1)[-1]) == (key in LIMIT_IS_THE_FEATURE), key


def test_references_and_unique_keys_take_one_exchange_a_key_column(spark):
    # Order_Id and Company_Id, then one sum of the violations each; no joins
    plan = _plan(E.queries()["check_fk"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning(_k") == 2
    assert "Join" not in plan.split("Union")[0]
    whole = _plan(E.queries()["integrity_violations"](spark, SF_SMALL))
    assert whole.count("Exchange hashpartitioning(_k") == 2 and "LeftAnti" not in whole


def test_integrity_violations_build_the_sources_once(spark):
    plan = _plan(E.queries()["integrity_violations"](spark, SF_SMALL))
    assert "l_partkey" not in plan and "o_custkey" not in plan  # the rules read a stored copy
