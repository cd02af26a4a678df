"""Every named query: its plan, and its result against the SQL twin."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as entry_module
from check import compare, duck
from ledgerloom.catalog import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLES = registry.oracles()


def run(spark, connection, name: str) -> tuple[str, str]:
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, compare(df, connection.cursor().execute(ORACLES[name]))


@pytest.fixture(scope="module")
def outcomes(spark, request):
    """The selected queries, run side by side: each is small, so one alone leaves cores idle."""
    connection = duck(FOLDER)
    selected = [item.callspec.params["name"] for item in request.session.items if hasattr(item, "callspec") and "name" in item.callspec.params]
    with ThreadPoolExecutor(6) as pool:
        return {name: pool.submit(run, spark, connection, name) for name in selected if name in QUERIES}


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["category", "store_state", "sale_year", "total_sales_amount", "total_quantity"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(outcomes, name):
    plan, outcome = outcomes[name].result()
    # No pairing of all rows and no Python in the data path.
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", plan)
    assert outcome.startswith("ok (") and "types" not in outcome, outcome


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["sales_over_amount"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_tax" not in lineitem and "PushedFilters: [IsNotNull(l_" in lineitem
    plan = QUERIES["claims_per_customer"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "EqualTo(l_returnflag,R)" in lineitem


@pytest.mark.parametrize("name,scans", [("validation_suite", 6), ("fk_orphan_report", 1)])
def test_facts_are_read_once_per_kind_of_check(spark, name, scans):
    """validation_suite: three times for the facts, and for the days and products, which come from the events too."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    source = "events.parquet" if name == "validation_suite" else "classified-facts"
    assert len(re.findall(rf"FileScan[^\n]*{source}", plan)) <= scans


def test_shared_results_follow_their_input(spark, tmp_path):
    from ledgerloom.catalog import Stages

    stages, made = Stages(), []
    table = str(tmp_path / "t.parquet")
    get = lambda: stages.get(spark, str(tmp_path), "n", lambda: made.append(1) or len(made))
    spark.range(3).write.parquet(table)
    assert (get(), get()) == (1, 1)
    spark.range(4).write.mode("overwrite").parquet(table)
    assert get() == 2
