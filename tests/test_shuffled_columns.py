"""Reports shuffle and write what they show, not what other reports on the same step would show."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import insurance, registry
from ledgerloom.operators import facts
from ledgerloom.plans import value
from ledgerloom.session import stage_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def plan(spark):
    """The plan of a named query where no side is small enough to be broadcast, and the stage tables made for it."""
    folder = Path(stage_folder(spark).removeprefix("file:"))

    def stages() -> set[str]:
        return {p.name for p in folder.iterdir()} if folder.exists() else set()

    def planned(name: str) -> tuple[str, set[str]]:
        before = stages()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        return text, {re.sub("-[0-9a-f]{32}$", "", made) for made in stages() - before}

    return planned


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _scanned(text: str) -> str:
    """The columns read from the claims' line items."""
    return "".join(line for line in text.splitlines() if "FileScan" in line and "l_suppkey" in line)


def _load(spark, store: bool):
    """Repeated, NULL and loaded keys, unknown and repeated lookup keys, invalid and NULL amounts."""
    incoming = spark.createDataFrame(
        [
            ("f1", "a", 5), ("f1", "a", 3), ("f2", "x", 1), ("f3", "b", -1), ("f4", "b", 2), ("f4", "x", 1), ("f5", "a", 9),
            ("f5", "a", -9), (None, "a", 4), (None, "a", 2), ("f6", None, 1), ("f7", "a", None), ("f8", "c", 7),
        ],
        "fid string, id string, amount int",
    )
    dimension = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 3)], "id string, sk bigint")
    loaded = spark.createDataFrame([("f5",), ("f5",), (None,)], "fid string")
    valid = [(F.col("amount") > 0, "invalid amount")]
    return facts.load_facts(incoming, "fid", {"id": (dimension, "sk")}, valid, ["amount"], loaded, store=store)


def test_counters_planned_alone_are_those_of_the_stored_load(spark):
    stored, alone = _load(spark, True), _load(spark, False)
    assert rows(alone.counters) == rows(stored.counters) == [(14, 4, 5, 5)]
    assert rows(alone.rejects) == rows(stored.rejects)


def test_load_success_rate_carries_no_fact_columns(plan):
    text, made = plan("load_success_rate")
    assert not made and "classified-facts" not in text
    assert not re.search("l_discount|l_linestatus|l_shipdate", _scanned(text))


def test_facts_planned_alone_are_those_of_the_stored_load(spark):
    stored, alone = _load(spark, True).facts, _load(spark, False).facts
    assert alone.columns == stored.columns
    assert rows(alone) == rows(stored)
    assert rows(alone.select("fid", "sk", "amount")) == [("f1", 1, 3), ("f4", 2, 2), ("f8", 3, 7), (None, 1, 2)]


def test_fact_claim_ratio_drops_rejects_before_the_lookups(plan):
    text, made = plan("fact_claim_ratio")
    assert not made and "LeftOuter" not in text


@pytest.mark.parametrize("name", ["fact_claim_ratio", "fk_orphan_report", "resolve_surrogate_keys"])
def test_claims_meet_the_policies_as_they_come(plan, name):
    """By policy are shuffled line items, orders and policies; claims of known policies and agents then go to customer and claim id."""
    text, _ = plan(name)
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert keys.count("policy_id") == 3 and "l_orderkey" not in keys
    assert keys.count("customer_id") == 2 and keys.count("claim_id") == 2


@pytest.mark.parametrize("store", [True, False])
def test_order_of_lookups_leaves_reasons_and_columns(spark, store):
    incoming = spark.createDataFrame([("f1", "x", "x", 1), ("f2", "a", "x", 2), ("f3", "a", "b", 3)], "fid string, id string, at string, amount int")
    lookups = {
        "id": (spark.createDataFrame([("a", 1)], "id string, sk bigint"), "sk"),
        "at": (spark.createDataFrame([("b", 2)], "at string, tk bigint"), "tk"),
    }
    plain, swapped = (facts.load_facts(incoming, "fid", lookups, [], ["amount"], store=store, first=first) for first in ((), ["at"]))
    assert swapped.facts.columns == plain.facts.columns
    assert rows(swapped.facts) == rows(plain.facts)
    assert rows(swapped.rejects) == rows(plain.rejects) == [("f1", "unknown id", 1), ("f2", "unknown at", 1)]


def test_claims_by_policy_are_the_claims(spark):
    roles = insurance.Roles(spark, FOLDER)
    assert roles.claims_by_policy.schema == roles.claims.schema
    assert rows(roles.claims_by_policy) == rows(roles.claims)


def test_fk_orphan_report_reads_no_stored_load(plan):
    text, made = plan("fk_orphan_report")
    assert not made and "classified-facts" not in text


def test_resolve_surrogate_keys_reads_no_stored_load(plan):
    text, made = plan("resolve_surrogate_keys")
    assert not made and "classified-facts" not in text


PER_CUSTOMER = {"customer-risk", "lifetime-value", "quantile-counts"}


@pytest.mark.parametrize("name", ["revenue_recommendations", "high_value_share", "high_risk_claims", "clpv_insights"])
def test_only_customer_tables_are_written(plan, name):
    _, made = plan(name)
    assert made == PER_CUSTOMER


def test_claims_meet_their_policy_without_a_further_shuffle(plan):
    """Line items and orders, policies, claims by customer and customers."""
    text, _ = plan("high_risk_claims")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5


def test_scored_claims_with_repeated_policies_and_unknown_customers(spark):
    day = "date '2001-01-01'"
    claims = spark.sql(
        f"select * from values ('c1', 1, 7, 10.0, {day}, true, 3), ('c2', 1, 8, 60000.0, {day}, false, 9), ('c3', 2, 7, 1.0, {day}, false, 9)"
        " as t(claim_id, customer_id, policy_id, claim_amount, claim_date, fraud_indicator, days_to_settle)"
    )
    worth = spark.sql("select 1 as customer_id, 'Low' as risk_category, 1.0D as composite_risk_score, 1L as total_claims, 0.5D as payment_reliability_score")
    policies = spark.sql("select * from values (7, date '2000-12-31'), (7, date '2000-12-30') as t(policy_id, start_date)")
    scored = value.claim_fraud_score(claims, worth, policies)
    assert scored.columns[:3] == ["policy_id", "customer_id", "claim_id"]
    found = rows(scored.select("claim_id", "fraud_risk_score", "days_policy_to_claim"))
    assert found == [("c1", 5, 1), ("c1", 5, 2), ("c2", 4, None)]
