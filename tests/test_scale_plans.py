"""Scale audit: the physical plan of every registered query.

Rules that must hold at any data size, checked on the plan Catalyst picks:

* no join, cartesian product or broadcast (the job has no joins, so nothing
  may grow a broadcast with the data);
* no Python evaluation (every expression stays in the JVM);
* a single-partition exchange only moves pre-aggregated rows: the operator
  right under it is an aggregate, never raw rows;
* every shuffle the planner inserts for a grouping sits on a partial
  aggregate, so a hot key (a third of the rows, say) is collapsed inside
  each task before anything moves;
* no round-robin exchange (it sorts every partition to be retry-safe);
* the driver table is read through the pruned four-column schema at most.
"""

import re

import pytest

import __spark_entry__ as E
from ordwise.queries import QUERIES
from ordwise.sources import fixture
from tests.conftest import SF_SMALL, plan_text

KEYS = sorted(QUERIES)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "SortMergeJoin",
             "ShuffledHashJoin", "BroadcastExchange", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas", "RoundRobinPartitioning"]
AGGREGATES = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")


def _operators(plan: str) -> list[str]:
    """Operator names of a 'simple' physical plan, top to bottom."""
    ops = []
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-|]*(?:\*\(\d+\)\s*)?([A-Z][A-Za-z]+)", line)
        if m and m.group(1) not in ("AdaptiveSparkPlan",):
            ops.append(line.strip(" :+-|"))
    return ops


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(E.queries()[k](spark, SF_SMALL), "simple") for k in KEYS}


@pytest.mark.parametrize("key", KEYS)
def test_plan_rules(plans, key):
    plan = plans[key]
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op} in plan"
    ops = _operators(plan)
    for i, op in enumerate(ops):
        if op.startswith("Exchange SinglePartition"):
            below = re.sub(r"^\*\(\d+\)\s*", "", ops[i + 1])
            assert below.startswith(AGGREGATES), f"{key}: raw rows into one partition: {below[:80]}"
        if op.startswith("Exchange hashpartitioning") and "ENSURE_REQUIREMENTS" in op:
            below = re.sub(r"^\*\(\d+\)\s*", "", ops[i + 1])
            assert below.startswith(AGGREGATES) and "partial_" in below, f"{key}: no map-side combine: {below[:80]}"
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        cols = {c.split(":")[0] for c in schema.split(",") if c}
        if cols & set(fixture.SOURCE_COLUMNS):
            assert cols <= set(fixture.SOURCE_COLUMNS), f"{key}: wide scan {cols}"


def test_narrow_report_prunes_the_scan(plans):
    """A report over two derived columns reads only what they derive from."""
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plans["tier_counts"]).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_totalprice"}


def test_row_count_reads_no_column_and_moves_counts_only(plans):
    assert "ReadSchema: struct<>" in plans["row_count"]
    assert plans["row_count"].count("Exchange") == 1


def test_catalogue_reads_no_data(plans):
    assert "FileScan" not in plans["schema_profile"]


def test_single_partition_rule_is_exercised(plans):
    """Global aggregates and shares of total do put an exchange into one partition."""
    hits = [k for k, p in plans.items() if "Exchange SinglePartition" in p]
    assert {"row_count", "status_distribution", "constraint_report"} <= set(hits)


def test_map_side_combine_rule_is_exercised(plans):
    hits = [k for k, p in plans.items() if re.search(r"Exchange hashpartitioning\(\w+#\d+, \d+\), ENSURE", p)]
    assert {"status_counts", "pk_duplicates", "tier_breakdown"} <= set(hits)
