from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import banking, bookstore, dashboard, fraud, insurance, retail, risk, value


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- retail --------------------------------------------------------------------------------


def test_loyalty_text(spark):
    feed = spark.createDataFrame(
        [(i, 1, "A", "B", "NY", flag, 1, "S", "NY", 1, "P", "Toys", 1.0, date(2024, 1, 1), 1, Decimal("2.00")) for i, flag in enumerate(["1", "0", "", None, "x"])],
        "sale_id int, customer_id int, first_name string, last_name string, state string, loyalty_member string, store_id int, store_name string, "
        "store_state string, product_id int, product_name string, category string, unit_price double, sale_date date, quantity int, total_amount decimal(12,2)",
    )
    parts = retail.split_flat_feed(feed)
    assert rows(parts["customers"].select("loyalty_member")) == [(0,), (1,), (None,)]
    assert parts["stores"].count() == 1 and parts["sales"].count() == 5


def test_sales_reports_from_states_after_added_changed_and_removed_periods(spark, tmp_path):
    import shutil

    from ledgerloom.operators.daystates import DayPartitions
    from ledgerloom.sources.writers import replace_period

    products = spark.createDataFrame([(p, "AB"[p % 2]) for p in range(4)], "product_id bigint, category string")
    stores = spark.createDataFrame([(s, f"S{s % 2}") for s in range(3)], "store_id bigint, store_state string")

    def month(number, factor=1):
        ids = spark.range(number * 1000, number * 1000 + 300)
        return ids.select(
            (F.col("id") % 5).alias("product_id"), (F.col("id") % 4).alias("store_id"), F.col("id").alias("sale_id"),
            F.make_date(F.lit(2023), F.lit(number), (F.col("id") % 28 + 1).cast("int")).alias("sale_date"), (F.col("id") % 3).cast("int").alias("quantity"),
            F.when(F.col("id") % 11 > 0, F.col("id") % 97 * factor).cast("decimal(12,2)").alias("total_amount"), F.lit(202300 + number).alias("period"),
        )

    undated = month(9).withColumns({"sale_date": F.lit(None).cast("date"), "period": F.lit(None).cast("int")})
    path, store = str(tmp_path / "sales"), str(tmp_path / "states")
    table = DayPartitions(spark, path, "period", month(1).schema)

    def same_as_full(read, stores=stores, version=""):
        assert retail.refresh_sales_states(table, store, products, stores, version) == [f"period={p}" for p in read]
        whole = spark.read.schema(table.schema).parquet(path)
        report = retail.sales_report_from_states(spark, store, "period")
        assert not any("/sales/" in f for f in report.inputFiles())
        full = retail.sales_report(products, stores, whole)
        assert report.columns == full.columns and rows(report) == rows(full)
        assert rows(retail.monthly_sales_from_states(spark, store, "period")) == rows(retail.monthly_sales(whole))
        return report

    def write(df):
        replace_period(df, path, ["period"])

    write(month(1).unionByName(month(2)).unionByName(undated))
    same_as_full([202301, 202302, "__HIVE_DEFAULT_PARTITION__"])
    assert retail.refresh_sales_states(table, store, products, stores) == []
    write(month(3))
    same_as_full([202303])
    write(month(2, factor=5).limit(40))
    same_as_full([202302])
    shutil.rmtree(f"{path}/period=202301")
    same_as_full([])
    moved = stores.withColumn("store_state", F.lit("S9"))
    assert {r.store_state for r in same_as_full([202302, 202303, "__HIVE_DEFAULT_PARTITION__"], moved, "stores 2").collect()} == {"S9"}


# --- fraud ---------------------------------------------------------------------------------

CARDS = (
    "customer_id string, customer_name string, age int, credit_score int, annual_income double, state string, account_type string, "
    "previous_fraud_incidents int"
)
PAYMENTS = (
    "transaction_id string, customer_id string, amount double, transaction_date timestamp, merchant_category string, transaction_type string, "
    "location string, is_fraud int"
)


@pytest.fixture
def cards(spark):
    return spark.createDataFrame(
        [("weak", "W", 40, 550, 1.0, "NY", "x", 0), ("young", "Y", 20, 700, 1.0, "NY", "x", 5), ("repeat", "R", 50, 700, 1.0, "CA", "x", 1)], CARDS
    )


@pytest.fixture
def payments(spark):
    when = datetime(2024, 1, 1, 10)
    data = [(f"t{i}", "weak", 2000.0, when, "GAMBLING", "debit", "UNKNOWN", i % 2) for i in range(4)]
    data += [("u1", "young", 1.0, when, "FOOD", "debit", "NY", 0), ("u2", "repeat", 1000.0, when, "ONLINE", "debit", "ONLINE", 1), ("u3", "ghost", 5.0, when, "FOOD", "debit", "NY", 0)]
    return spark.createDataFrame(data, PAYMENTS)


def test_rule_scores(payments, cards):
    scored = {r.transaction_id: r for r in fraud.score_rules(payments, cards).collect()}
    top = scored["t0"]
    assert (top.risk_score, top.risk_category, top.is_high_risk) == (61, "MEDIUM", 0)
    assert (top.customer_risk_factor, top.final_risk_score, top.final_risk_category, top.is_final_high_risk) == (20, 81, "HIGH", 1)
    assert top.triggered_rules == ["high_amount", "velocity", "merchant", "location"]
    assert scored["u1"].customer_risk_factor == 15 and scored["u2"].customer_risk_factor == 30
    assert scored["u2"].risk_score == 16
    assert (scored["u3"].customer_name, scored["u3"].final_risk_score) == (None, 0)
    assert len(scored) == payments.count()


def test_stage_one_cannot_be_high(spark):
    """Every combination of rules: at most 61 before, 91 after the customer factor."""
    settings = fraud.RuleSettings()
    for hits in product([0, 1], repeat=4):
        exact = sum(Decimal(str(w)) * s * h for w, s, h in zip(settings.weights, settings.scores, hits))
        as_float = sum(w * s * h for w, s, h in zip(settings.weights, settings.scores, hits))
        assert int(exact) == int(as_float) <= 61
    assert 61 + 30 == 91


def test_flat_score_is_capped(payments, cards):
    flat = {r.transaction_id: (r.risk_score, r.risk_category) for r in fraud.score_flat(payments, cards).collect()}
    assert flat["t1"] == (100, "High Risk") and flat["t0"] == (50, "Medium Risk") and flat["u1"] == (40, "Medium Risk")


def test_age_unknown_has_its_own_band(payments, cards):
    bands = {r.age_group: r.total_transactions for r in fraud.age_group_risk(fraud.score_rules(payments, cards)).collect()}
    assert bands == {"35-44": 4, "18-24": 1, "45-54": 1, "Unknown": 1}


def test_score_stats_equal_brute_force(payments, cards):
    flat = fraud.score_flat(payments, cards)
    scores = sorted(r.risk_score for r in flat.collect())
    stats = fraud.risk_score_stats(flat).first()
    assert (stats.min_risk_score, stats.max_risk_score, stats.median_risk_score) == (scores[0], scores[-1], scores[(len(scores) - 1) // 2])
    assert stats.risk_score_std_dev == pytest.approx(flat.agg(F.stddev("risk_score")).first()[0], abs=0.005)


# --- insurance star ------------------------------------------------------------------------


def test_star_load_twice(spark):
    raw = {
        "customers": spark.createDataFrame(
            [("C1", " ann ", "o'neil", "A@X.com", "1234567890", "2000-01-01", "NY", "NY", "3.5", "2020-01-01"), ("C2", "BOB", "lee", "", "", "bad", "", "", "", "")],
            "customer_id string, first_name string, last_name string, email string, phone string, birth_date string, city string, state string, "
            "risk_score string, customer_since string",
        ),
        "policies": spark.createDataFrame(
            [("P1", "C1", "auto", "1000", "2500", "10", "2024-01-01", "2025-01-01", "")],
            "policy_id string, customer_id string, policy_type string, coverage_amount string, annual_premium string, deductible string, "
            "effective_date string, expiration_date string, status string",
        ),
        "claims": spark.createDataFrame(
            [
                ("K1", "P1", "C1", "AGT007", "500", "1000", "0", "450", "2024-02-01", "2024-02-11", "closed"),
                ("K2", "P1", "C1", "AGT012", "5000", "1000", "0", "0", "2024-02-01", "", "open"),
                ("K3", "P9", "C1", "X1", "5", "1000", "0", "0", "2024-02-01", "", "odd"),
                ("K4", "P1", "C1", "AGT007", "5", "1000", "0", "0", "", "", "open"),
            ],
            "claim_id string, policy_id string, customer_id string, agent_id string, claim_amount string, coverage_amount string, "
            "deductible_amount string, payout_amount string, filed_date string, closed_date string, claim_status string",
        ),
    }
    prepared = insurance.prepare_customers(raw["customers"], date(2024, 6, 1))
    empty = {
        "dim_customer": spark.createDataFrame([], prepared.select(F.lit(1).cast("bigint").alias("customer_key"), "*").schema),
        "dim_policy": spark.createDataFrame([], insurance.prepare_policies(raw["policies"]).select(F.lit(1).cast("bigint").alias("policy_key"), "*").schema),
        "dim_agent": spark.createDataFrame([], insurance.derive_agents(raw["claims"]).select(F.lit(1).cast("bigint").alias("agent_key"), "*").schema),
    }
    dims, load = insurance.load_star(raw, empty, None, date(2024, 6, 1))
    customer = dims["dim_customer"].where("customer_id = 'C1'").first()
    assert (customer.full_name, customer.phone, customer.age, customer.risk_tier) == ("Ann O'Neil", "(123) 456-7890", 24, "High")
    assert {r.agent_id: r.region for r in dims["dim_agent"].collect()} == {"AGT007": "South", "AGT012": "Central", "X1": "North"}
    fact = load.facts.first()
    assert (fact.claim_id, fact.closed_date_key, fact.processing_days, fact.claim_status, fact.claim_to_coverage_ratio) == ("K1", 20240211, 10, "Closed", 0.5)
    assert rows(load.rejects) == [("K2", "invalid amount", 1), ("K3", "unknown policy_id", 1), ("K4", "invalid filed date", 1)]
    again, second = insurance.load_star(raw, dims, load.facts.select("claim_id"), date(2024, 6, 1))
    for name in dims:
        assert rows(again[name]) == rows(dims[name])
    assert second.facts.count() == 0


# --- bookstore -----------------------------------------------------------------------------


def test_books(spark):
    books = spark.createDataFrame(
        [("  the   Title ", "x", "9781", "saga", "Yes"), ("", "x", "9782", "", "No"), ("b", "x", "9783", None, "maybe")],
        "title string, genre string, isbn string, series string, recommended string",
    )
    assert rows(bookstore.transform_books(books)) == [("B", "X", "9783", None, ""), ("The   Title", "X", "9781", "Saga", "Yes")]
    without_series = bookstore.transform_books(books.drop("series"))
    assert without_series.columns == ["title", "genre", "isbn", "recommended"] and without_series.count() == 2
    assert bookstore.with_normalized_series(books.drop("series")).first().series_normalized is None


def test_lists_and_missing_columns(spark):
    people = spark.createDataFrame([("Ann", ["x", "y"], None)], "name string, reading_history array<string>, genre_preferences array<string>")
    assert bookstore.with_reading_count(people).first().reading_count == 2
    assert bookstore.with_num_genres(people).first().num_genres == 0
    assert bookstore.with_collab_count(people).first().collab_count == 0
    assert bookstore.with_recommended_score(people).first().recommended_score == 1.0


def test_authors_and_orders(spark):
    authors = spark.createDataFrame(
        [("bob", "a@b.com", "(123) 456-7890", ["x", "y"]), ("ann", "a@b.com", "1234567890", []), ("cid", "bad", "1234567890", None)],
        "name string, email string, phone string, genres array<string>",
    )
    assert rows(bookstore.transform_authors(authors)) == [("Ann", "a@b.com", "1234567890", None)]
    orders = spark.createDataFrame([(1, "2", "$5.505"), (1, "9", "1"), (2, "-1", None), (3, "x", "-4")], "order_id int, quantity string, price string")
    assert rows(bookstore.transform_orders(orders)) == [
        (1, 2, Decimal("5.51")), (2, 0, Decimal("0.00")), (3, 0, Decimal("0.00")),
    ]


# --- insurance analytics -------------------------------------------------------------------


@pytest.fixture
def portfolio(spark):
    as_of = date(2024, 1, 1)
    customers = spark.createDataFrame(
        [("good", date(1980, 1, 1), 800, "NY", date(2014, 1, 1), "G", "G"), ("bad", date(2003, 1, 1), 500, "CA", date(2023, 9, 1), "B", "B"), ("idle", None, None, "CA", None, "I", "I")],
        "customer_id string, birth_date date, credit_score int, state string, acquisition_date date, first_name string, last_name string",
    )
    policies = spark.createDataFrame(
        [
            ("p1", "good", "Auto", 4000.0, 1e5, date(2020, 1, 1), date(2024, 2, 1), "Active", "Web"),
            ("p2", "good", "Home", 500.0, 1e5, date(2020, 1, 1), date(2024, 9, 1), "Renewed", "Web"),
            ("p3", "bad", "Auto", 6000.0, 1e5, date(2023, 9, 1), date(2024, 3, 1), "Active", "Agent"),
        ],
        "policy_id string, customer_id string, policy_type string, premium_amount double, coverage_amount double, start_date date, renewal_date date, "
        "policy_status string, acquisition_channel string",
    )
    claims = spark.createDataFrame(
        [(f"c{i}", "bad", "p3", 60000.0, date(2023, 12, i + 1), i == 0, 2) for i in range(3)],
        "claim_id string, customer_id string, policy_id string, claim_amount double, claim_date date, fraud_indicator boolean, days_to_settle int",
    )
    payments = spark.createDataFrame(
        [("y1", "good", 10.0, date(2023, 1, 1), "Card", "Paid", False), ("y2", "bad", 10.0, date(2023, 1, 1), "Card", "Failed", True)],
        "payment_id string, customer_id string, payment_amount double, payment_date date, payment_method string, payment_status string, late_payment_flag boolean",
    )
    interactions = spark.createDataFrame(
        [("i1", "good", 5.0, "Resolved"), ("i2", "bad", 1.0, "Open")],
        "interaction_id string, customer_id string, satisfaction_score double, resolution_status string",
    )
    profiles = risk.with_value_segment(risk.customer_risk(customers, claims, policies, payments, as_of), [Decimal(4500), Decimal(6000)])
    worth = value.with_clpv_segment(value.lifetime_value(profiles, interactions, as_of), [Decimal(1), Decimal(100), Decimal(10000)])
    return {"policies": policies, "claims": claims, "profiles": profiles, "value": worth, "renewals": value.renewal_score(value.renewal_features(policies, worth, as_of))}


def test_customer_risk(portfolio):
    found = {r.customer_id: r for r in portfolio["profiles"].collect()}
    assert len(found) == 3
    good, bad, idle = found["good"], found["bad"], found["idle"]
    # 0.30*1 + 0.25*1 + 0.15*1 + 0.15*2 + 0.15*1
    assert (good.composite_risk_score, good.risk_category, good.policy_types, good.policy_type_counts) == (1.15, "Low", ["Auto", "Home"], [1, 1])
    # 0.30*4 + 0.25*5 + 0.15*3 + 0.15*3 + 0.15*4
    assert (bad.composite_risk_score, bad.risk_category, bad.payment_reliability_score, bad.value_segment) == (3.95, "High", -2.0, "High Value")
    assert (idle.total_claims, idle.total_premium, idle.payment_reliability_score, idle.credit_risk_score) == (0, 0.0, 1.0, 5.0)


def test_boundary_of_the_low_category(spark):
    """Scores that add up to 1.75 exactly are still low."""
    total = Decimal("0.30") * 1 + Decimal("0.25") * 4 + Decimal("0.15") * 3
    assert total == Decimal("1.75")


def test_value_and_renewals(portfolio):
    worth = {r.customer_id: r for r in portfolio["value"].collect()}
    assert worth["good"].adjusted_retention_probability == 0.95
    assert worth["bad"].adjusted_retention_probability == pytest.approx(0.65 * 0.8 * 0.9)
    assert worth["idle"].avg_satisfaction_score == 3.5
    renewals = {r.policy_id: r for r in portfolio["renewals"].collect()}
    assert renewals["p1"].renewal_probability_score == 0.98 and renewals["p1"].renewal_risk_category == "Low Risk"
    assert renewals["p3"].renewal_risk_category == "High Risk" and renewals["p3"].days_to_renewal == 60
    assert rows(value.at_risk_policies(portfolio["renewals"]).select("policy_id")) == [("p3",)]


def test_investment_keeps_one_row_per_customer(portfolio):
    investment = dashboard.retention_investment(portfolio["value"], portfolio["renewals"])
    found = {r.customer_id: (r.retention_investment_priority, r.renewal_risk_category) for r in investment.collect()}
    assert found["bad"] == ("Critical", "High Risk")
    assert found["good"][1] == "Low Risk" and found["idle"] == ("Low", None)
    assert dashboard.executive_dashboard(portfolio["value"], portfolio["renewals"]).count() == 3


def test_cross_sell_priority(portfolio):
    found = {r.customer_id: (r.cross_sell_priority, r.estimated_additional_premium) for r in dashboard.cross_sell_analysis(portfolio["value"]).collect()}
    assert found["good"] == ("High Priority", pytest.approx(4500 * 0.6))
    assert found["bad"][0] == "Low Priority"
    assert rows(dashboard.high_priority_cross_sell(dashboard.cross_sell_analysis(portfolio["value"])).select("customer_id")) == [("good",)]
    assert rows(risk.cross_sell_targets(portfolio["profiles"]).select("customer_id")) == [("bad",)]


def test_claim_fraud(portfolio):
    scored = value.claim_fraud_score(portfolio["claims"], portfolio["value"], portfolio["policies"])
    found = {r.claim_id: (r.fraud_risk_score, r.fraud_risk_category, r.days_policy_to_claim) for r in scored.collect()}
    assert found["c0"] == (8, "High Risk", 91) and found["c1"] == (5, "High Risk", 92)
    measured = value.claim_fraud_score(portfolio["claims"], portfolio["value"], portfolio["policies"], None, None)
    assert {r.claim_amount_zscore for r in measured.collect()} == {None}  # no spread, so no z-score


def test_customers_at_risk_are_counted_once(spark):
    """One customer with three policies at risk, one with one."""
    at_risk = spark.createDataFrame(
        [("a", f"p{i}", 100.0, 0.2, "High Value", "High") for i in range(3)] + [("b", "q", 50.0, 0.4, "High Value", "High")],
        "customer_id string, policy_id string, premium_amount double, renewal_probability_score double, clpv_segment string, risk_category string",
    )
    summary = value.at_risk_summary(at_risk).first()
    assert (summary.customer_count, summary.policy_count, summary.premium_at_risk) == (2, 4, 350.0)
    assert summary.avg_renewal_prob == pytest.approx(0.25)
    assert rows(value.customers_at_risk(at_risk)) == [("a", 3, 300.0), ("b", 1, 50.0)]


def test_transaction_load_accounts_for_every_row(spark):
    staging = spark.createDataFrame(
        [
            ("h1", "Ann", "p1", 1, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", 1, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", 1, "CC0", Decimal("7.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", 2, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h9", "Bob", "p1", 3, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p9", 4, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", 5, "CC1", Decimal("5.00"), "buy", date(2024, 2, 1)),
            (None, "Ann", "p1", 6, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", " ", "p1", 7, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", 8, "CC1", Decimal("99999.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", "p1", None, "CC1", Decimal("5.00"), "buy", date(2024, 1, 1)),
            ("h1", "Ann", None, 10, "CC1", Decimal("5.00"), "buy", None),
        ],
        "account_holder_id string, account_holder_name string, banking_product_id string, transaction_id int, account_number string, "
        "transaction_amount decimal(12,2), transaction_type string, transaction_date date",
    )
    holders = spark.createDataFrame([("h1", 11, True), ("h1", 10, False)], "account_holder_id string, account_holder_key int, is_current boolean")
    products = spark.createDataFrame([("p1", 21)], "banking_product_id string, banking_product_key int")
    dates = spark.createDataFrame([(20240101,)], "date_key int")
    load = banking.transaction_load(staging, holders, products, dates, staging.where("transaction_id = 2"))
    assert rows(load.facts.select("transaction_id", "account_number", "account_holder_key")) == [(1, "CC0", 11)]
    rejected = {(r.transaction_id, r.reject_reason): r.row_count for r in load.rejects.collect()}
    assert rejected == {
        (1, "duplicate"): 2, (2, "duplicate"): 1, (3, "unknown account_holder_id"): 1, (4, "unknown banking_product_id"): 1,
        (5, "unknown date_key"): 1, (6, "no holder"): 1, (7, "no holder"): 1, (8, "invalid amount"): 1, (None, "no transaction id"): 1,
        (10, "unknown banking_product_id"): 1,
    }
    counters = load.counters.first()
    assert counters.total_processed == counters.successfully_loaded + counters.failed_validation + counters.duplicate_facts == staging.count()


def test_limits_are_named_in_the_message(spark):
    facts = spark.createDataFrame([(1, 1, 20240101, 1, "CC123456", Decimal("500.00"))], "account_holder_key int, banking_product_key int, date_key int, transaction_id int, account_number string, transaction_amount decimal(12,2)")
    holders = spark.createDataFrame([(1, "a", date(2020, 1, 1), None, True)], "account_holder_key int, account_holder_id string, effective_date date, expiration_date date, is_current boolean")
    products, dates = spark.createDataFrame([(1,)], "banking_product_key int"), spark.createDataFrame([(20240101,)], "date_key int")
    found = banking.validation_suite(facts, holders, products, dates, date(2024, 6, 1), (-3, 4), date(2024, 6, 2)).collect()
    assert [r.error_details for r in found if "Range" in r.rule_name] == ["Found Transactions outside valid range (-3-4)"]
    assert {r.check_date for r in found} == {date(2024, 6, 2)}
