"""Insurance analytics queries: orders are policies, line items claims and payments, events interactions.

Customer risk and lifetime value, of one row per customer, are stage tables: written once, read
by every later report. Renewals and scored claims, of one row per policy and claim, are planned within
each report, which so shuffles its own columns only. One ``Stages`` object, and so one set of stage tables, belongs to each call of
``queries()``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..plans import dashboard, risk, value
from ..session import stage_table, tune
from . import Query, Stages, davg, dsum, metric_rows, r2, table

AS_OF = date(2001, 12, 31)


class Roles:
    """The insurance frames over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, stages: Stages) -> None:
        self.read = lambda name: table(spark, folder, name)
        self.stage = lambda name, build: stages.get(spark, folder, name, build)

    @property
    def customers(self) -> DataFrame:
        joined = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        first_order = self.read("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.min(F.col("o_orderdate").cast("date")).alias("acquisition_date")
        )
        balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@example.com")).alias("email"),
            F.date_add(F.lit(date(1930, 1, 1)), ((F.col("c_custkey") * 7919) % 18000).cast("int")).alias("birth_date"),
            F.when(nation < 12, "F").otherwise("M").alias("gender"),
            F.when(balance < 4000, "Single").otherwise("Married").alias("marital_status"),
            (balance * 10 + 20000).cast("decimal(12,2)").cast("double").alias("income"),
            (500 + F.floor((balance + 1000) / 11000 * 350)).cast("int").alias("credit_score"),
            F.when(balance < 0, "Unemployed").otherwise("Employed").alias("employment_status"),
            F.initcap("c_mktsegment").alias("education"),
            F.col("n_name").alias("state"),
            F.lpad(nation.cast("string"), 5, "0").alias("zip_code"),
        ).join(first_order, "customer_id", "left")

    @property
    def policies(self) -> DataFrame:
        price, start = F.col("o_totalprice").cast("decimal(12,2)"), F.col("o_orderdate").cast("date")
        return self.read("orders").select(
            F.col("o_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            case_bucket([(price >= 450_000, "Life"), (price >= 400_000, "Home")], "Auto").alias("policy_type"),
            (price * F.lit(Decimal("0.01"))).alias("premium_amount"),
            price.alias("coverage_amount"),
            start.alias("start_date"),
            F.date_add(start, 365).alias("renewal_date"),
            case_bucket([(F.col("o_orderstatus") == "O", "Active"), (F.col("o_orderstatus") == "P", "Renewed")], "Lapsed").alias("policy_status"),
            case_bucket([(F.quarter(start) == 1, "Agent"), (F.quarter(start) == 2, "Online"), (F.quarter(start) == 3, "Broker")], "Referral").alias("acquisition_channel"),
        )

    def _lines(self, condition: str, **columns) -> DataFrame:
        """Line items and the customers of their orders. ``columns`` are derived before the join, so that no more is shuffled."""
        lines = self.read("lineitem").where(condition).select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in columns.items()])
        owners = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
        return lines.join(owners, "l_orderkey")

    @property
    def claims(self) -> DataFrame:
        lines = self._lines(
            "l_returnflag = 'R'",
            claim_amount=F.col("l_extendedprice").cast("decimal(12,2)"),
            claim_date=F.col("l_shipdate").cast("date"),
            fraud_indicator=(F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.09),
            days_to_settle=F.col("l_quantity").cast("int"),
        )
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
            "customer_id",
            F.col("l_orderkey").alias("policy_id"),
            "claim_amount",
            "claim_date",
            "fraud_indicator",
            "days_to_settle",
        )

    @property
    def payments(self) -> DataFrame:
        lines = self._lines(
            "l_returnflag <> 'R'",
            payment_amount=F.col("l_extendedprice").cast("decimal(12,2)"),
            payment_date=F.col("l_shipdate").cast("date"),
            by_card=F.col("l_linestatus") == "F",
            failed=F.col("l_tax") >= 0.08,
            late_payment_flag=F.col("l_discount") >= 0.08,
        )
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payment_id"),
            "customer_id",
            "payment_amount",
            "payment_date",
            F.when(F.col("by_card"), "Card").otherwise("Transfer").alias("payment_method"),
            F.when(F.col("failed"), "Failed").otherwise("Paid").alias("payment_status"),
            "late_payment_flag",
        )

    @property
    def interactions(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("interaction_id"),
            F.col("user_id").alias("customer_id"),
            F.least(F.lit(5), F.floor(F.col("value") / 25) + 1).cast("double").alias("satisfaction_score"),
            F.when(F.col("event_type") == "error", "Open").otherwise("Resolved").alias("resolution_status"),
        )

    @property
    def risk(self) -> DataFrame:
        def build() -> DataFrame:
            return stage_table(
                risk.customer_risk(self.customers, self.claims, self.policies, self.payments, AS_OF), "customer-risk"
            )

        return self.stage("risk", build)

    @property
    def profiles(self) -> DataFrame:
        return self.stage("profiles", lambda: risk.with_value_segment(self.risk, risk.value_thresholds(self.risk)))

    @property
    def value(self) -> DataFrame:
        def build() -> DataFrame:
            stored = stage_table(value.lifetime_value(self.profiles, self.interactions, AS_OF), "lifetime-value")
            return value.with_clpv_segment(stored, value.value_thresholds(stored))

        return self.stage("value", build)

    @property
    def renewals(self) -> DataFrame:
        return value.renewal_score(value.renewal_features(self.policies, self.value, AS_OF))

    @property
    def at_risk(self) -> DataFrame:
        return value.at_risk_policies(self.renewals)

    @property
    def scored_claims(self) -> DataFrame:
        return value.claim_fraud_score(self.claims, self.value, self.policies)

    @property
    def investment(self) -> DataFrame:
        return dashboard.retention_investment(self.value, self.renewals)

    @property
    def cross_sell(self) -> DataFrame:
        return dashboard.cross_sell_analysis(self.value)

    @property
    def figures(self) -> DataFrame:
        return dashboard.portfolio_figures(
            self.customers,
            self.policies,
            self.claims,
            self.value,
            self.at_risk,
            value.segment_pricing(self.value),
            self.cross_sell,
            self.scored_claims,
            self.investment,
        )


def _threshold(source: str, column: str, p: float) -> str:
    return f"""(SELECT min(v) FILTER (WHERE cd >= {p}) FROM (SELECT CAST({column} AS DECIMAL(18,4)) AS v,
      cume_dist() OVER (ORDER BY CAST({column} AS DECIMAL(18,4))) AS cd FROM {source}))"""


ROLES_SQL = f"""
WITH customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    'c' || c_custkey || '@example.com' AS email, DATE '1930-01-01' + CAST((c_custkey * 7919) % 18000 AS INT) AS birth_date,
    CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS gender, CASE WHEN c_acctbal < 4000 THEN 'Single' ELSE 'Married' END AS marital_status,
    CAST(CAST(c_acctbal * 10 + 20000 AS DECIMAL(12,2)) AS DOUBLE) AS income,
    CAST(500 + floor((c_acctbal + 1000) / 11000 * 350) AS INT) AS credit_score,
    CASE WHEN c_acctbal < 0 THEN 'Unemployed' ELSE 'Employed' END AS employment_status,
    upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS education, n_name AS state,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code, acquisition_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS acquisition_date
    FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey),
policies AS (
  SELECT o_orderkey AS policy_id, o_custkey AS customer_id,
    CASE WHEN o_totalprice >= 450000 THEN 'Life' WHEN o_totalprice >= 400000 THEN 'Home' ELSE 'Auto' END AS policy_type,
    CAST(o_totalprice AS DECIMAL(12,2)) * 0.01 AS premium_amount, CAST(o_totalprice AS DECIMAL(12,2)) AS coverage_amount,
    CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + 365 AS renewal_date,
    CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'P' THEN 'Renewed' ELSE 'Lapsed' END AS policy_status,
    CASE quarter(o_orderdate) WHEN 1 THEN 'Agent' WHEN 2 THEN 'Online' WHEN 3 THEN 'Broker' ELSE 'Referral' END AS acquisition_channel
  FROM orders),
claims AS (
  SELECT l_orderkey || '-' || l_linenumber AS claim_id, o_custkey AS customer_id, l_orderkey AS policy_id,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS claim_amount, CAST(l_shipdate AS DATE) AS claim_date,
    l_linestatus = 'F' AND l_discount >= 0.09::DOUBLE AS fraud_indicator, CAST(l_quantity AS INT) AS days_to_settle
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'),
payments AS (
  SELECT o_custkey AS customer_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_amount, CAST(l_shipdate AS DATE) AS payment_date,
    CASE l_linestatus WHEN 'F' THEN 'Card' ELSE 'Transfer' END AS payment_method,
    CASE WHEN l_tax >= 0.08::DOUBLE THEN 'Failed' ELSE 'Paid' END AS payment_status, l_discount >= 0.08::DOUBLE AS late_payment_flag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'),
interactions AS (
  SELECT user_id AS customer_id, CAST(least(5, floor(value / 25) + 1) AS DOUBLE) AS satisfaction_score,
    CASE event_type WHEN 'error' THEN 'Open' ELSE 'Resolved' END AS resolution_status FROM events),
claims_pc AS (
  SELECT customer_id, count(*) AS total_claims, {dsum("claim_amount")} AS total_claim_amount, {davg("claim_amount")} AS avg_claim_amount,
    CAST(max(claim_amount) AS DOUBLE) AS max_claim_amount, count(DISTINCT policy_id) AS policies_with_claims FROM claims GROUP BY customer_id),
policy_pc AS (
  SELECT customer_id, count(*) AS total_policies, {dsum("premium_amount")} AS total_premium, {davg("premium_amount")} AS avg_premium,
    {dsum("coverage_amount")} AS total_coverage, count(DISTINCT policy_type) AS policy_types_count,
    string_agg(DISTINCT policy_type, ',' ORDER BY policy_type) AS policy_types FROM policies GROUP BY customer_id),
payment_pc AS (
  SELECT *, 1 - CAST(late_payments_count + 2 * failed_payments_count AS DOUBLE) / total_payments AS payment_reliability_score FROM (
  SELECT customer_id, count(*) AS total_payments, {dsum("payment_amount")} AS total_payment_amount, {davg("payment_amount")} AS avg_payment_amount,
    count(*) FILTER (WHERE late_payment_flag) AS late_payments_count, count(*) FILTER (WHERE payment_status = 'Failed') AS failed_payments_count
  FROM payments GROUP BY customer_id)),
metrics AS (
  SELECT c.*, coalesce(total_claims, 0) AS total_claims, coalesce(total_claim_amount, 0) AS total_claim_amount,
    coalesce(avg_claim_amount, 0) AS avg_claim_amount, coalesce(max_claim_amount, 0) AS max_claim_amount,
    coalesce(policies_with_claims, 0) AS policies_with_claims, coalesce(total_policies, 0) AS total_policies,
    coalesce(total_premium, 0) AS total_premium, coalesce(avg_premium, 0) AS avg_premium, coalesce(total_coverage, 0) AS total_coverage,
    coalesce(policy_types_count, 0) AS policy_types_count, policy_types, coalesce(total_payments, 0) AS total_payments,
    coalesce(total_payment_amount, 0) AS total_payment_amount, coalesce(avg_payment_amount, 0) AS avg_payment_amount,
    coalesce(late_payments_count, 0) AS late_payments_count, coalesce(failed_payments_count, 0) AS failed_payments_count,
    coalesce(payment_reliability_score, 1) AS payment_reliability_score,
    CAST(floor(date_diff('day', birth_date, DATE '2001-12-31') / 365.25) AS INT) AS age
  FROM customers c LEFT JOIN claims_pc USING (customer_id) LEFT JOIN policy_pc USING (customer_id) LEFT JOIN payment_pc USING (customer_id)),
scores AS (
  SELECT *, CASE WHEN total_claims = 0 THEN 1 WHEN total_claims = 1 THEN 2 WHEN total_claims = 2 THEN 3 ELSE 4 END AS s1,
    CASE WHEN credit_score >= 750 THEN 1 WHEN credit_score >= 700 THEN 2 WHEN credit_score >= 650 THEN 3 WHEN credit_score >= 600 THEN 4 ELSE 5 END AS s2,
    CASE WHEN age < 25 THEN 3 WHEN age <= 65 THEN 1 WHEN age <= 75 THEN 2 ELSE 3 END AS s3,
    CASE WHEN total_premium >= 5000 THEN 3 WHEN total_premium >= 2000 THEN 2 ELSE 1 END AS s4,
    CASE WHEN payment_reliability_score >= 0.95::DOUBLE THEN 1 WHEN payment_reliability_score >= 0.85::DOUBLE THEN 2
      WHEN payment_reliability_score >= 0.75::DOUBLE THEN 3 ELSE 4 END AS s5 FROM metrics),
base AS (
  SELECT *, CAST(s1 AS DOUBLE) AS claims_risk_score, CAST(s2 AS DOUBLE) AS credit_risk_score, CAST(s3 AS DOUBLE) AS age_risk_score,
    CAST(s4 AS DOUBLE) AS premium_risk_score, CAST(s5 AS DOUBLE) AS payment_risk_score,
    (s1 * 30 + s2 * 25 + s3 * 15 + s4 * 15 + s5 * 15) / 100 AS composite_risk_score,
    CASE WHEN s1 * 30 + s2 * 25 + s3 * 15 + s4 * 15 + s5 * 15 <= 175 THEN 'Low'
      WHEN s1 * 30 + s2 * 25 + s3 * 15 + s4 * 15 + s5 * 15 <= 275 THEN 'Medium' ELSE 'High' END AS risk_category FROM scores),
profiles AS (
  SELECT *, CASE WHEN CAST(total_premium AS DECIMAL(18,4)) >= {_threshold("base", "total_premium", 0.9)} THEN 'High Value'
    WHEN CAST(total_premium AS DECIMAL(18,4)) >= {_threshold("base", "total_premium", 0.7)} THEN 'Medium Value' ELSE 'Low Value' END
    AS value_segment FROM base),
satisfaction AS (
  SELECT customer_id, {davg("satisfaction_score")} AS avg_satisfaction_score, count(*) AS total_interactions,
    count(*) FILTER (WHERE resolution_status = 'Resolved') AS resolved_interactions FROM interactions GROUP BY customer_id),
tenure AS (
  SELECT p.*, CAST(date_diff('day', acquisition_date, DATE '2001-12-31') AS INT) AS customer_tenure_days,
    date_diff('day', acquisition_date, DATE '2001-12-31') / 365.25::DOUBLE AS customer_tenure_years,
    CASE WHEN acquisition_date < DATE '2001-12-31' THEN total_premium / (date_diff('day', acquisition_date, DATE '2001-12-31') / 365.25::DOUBLE)
      ELSE total_premium END AS annualized_premium,
    coalesce(avg_satisfaction_score, 3.5) AS avg_satisfaction_score, coalesce(total_interactions, 0) AS total_interactions,
    coalesce(resolved_interactions, 0) AS resolved_interactions,
    coalesce(CAST(resolved_interactions AS DOUBLE) / total_interactions, 1) AS satisfaction_resolution_rate
  FROM profiles p LEFT JOIN satisfaction USING (customer_id)),
retention AS (
  SELECT *, CASE risk_category WHEN 'Low' THEN 0.85::DOUBLE WHEN 'Medium' THEN 0.75::DOUBLE ELSE 0.65::DOUBLE END AS retention_probability,
    CASE WHEN avg_satisfaction_score >= 4 THEN 1.15::DOUBLE WHEN avg_satisfaction_score >= 3.5 THEN 1::DOUBLE
      WHEN avg_satisfaction_score >= 3 THEN 0.9::DOUBLE ELSE 0.8::DOUBLE END AS satisfaction_adjustment,
    CASE WHEN payment_reliability_score >= 0.95::DOUBLE THEN 1.1::DOUBLE WHEN payment_reliability_score >= 0.85::DOUBLE THEN 1::DOUBLE
      ELSE 0.9::DOUBLE END AS payment_reliability_adjustment,
    CASE risk_category WHEN 'Low' THEN 0.9::DOUBLE WHEN 'Medium' THEN 1::DOUBLE ELSE 1.2::DOUBLE END AS risk_premium_multiplier
  FROM tenure),
kept AS (
  SELECT *, least(retention_probability * satisfaction_adjustment * payment_reliability_adjustment, 0.95::DOUBLE) AS adjusted_retention_probability,
    annualized_premium * risk_premium_multiplier AS predicted_annual_premium FROM retention),
clpv AS (
  SELECT *, 3::DOUBLE * adjusted_retention_probability + (1::DOUBLE - adjusted_retention_probability) * 1.5::DOUBLE AS expected_lifetime_years,
    predicted_annual_premium * (3::DOUBLE * adjusted_retention_probability + (1::DOUBLE - adjusted_retention_probability) * 1.5::DOUBLE)
      AS customer_lifetime_premium_value FROM kept),
value AS (
  SELECT *, CASE WHEN CAST(customer_lifetime_premium_value AS DECIMAL(18,4)) >= {_threshold("clpv", "customer_lifetime_premium_value", 0.95)} THEN 'Premium'
    WHEN CAST(customer_lifetime_premium_value AS DECIMAL(18,4)) >= {_threshold("clpv", "customer_lifetime_premium_value", 0.85)} THEN 'High Value'
    WHEN CAST(customer_lifetime_premium_value AS DECIMAL(18,4)) >= {_threshold("clpv", "customer_lifetime_premium_value", 0.6)} THEN 'Medium Value'
    ELSE 'Low Value' END AS clpv_segment FROM clpv),
features AS (
  SELECT p.*, v.* EXCLUDE (customer_id), CAST(date_diff('day', DATE '2001-12-31', renewal_date) AS INT) AS days_to_renewal,
    CAST(premium_amount AS DOUBLE) / (customer_lifetime_premium_value / customer_tenure_years) AS premium_to_income_ratio,
    date_diff('day', start_date, DATE '2001-12-31') / 365.25::DOUBLE AS policy_age_years
  FROM policies p JOIN value v USING (customer_id)),
adjustments AS (
  SELECT *, CASE WHEN customer_tenure_years >= 5 THEN 1.15::DOUBLE WHEN customer_tenure_years >= 3 THEN 1.1::DOUBLE
      WHEN customer_tenure_years >= 1 THEN 1::DOUBLE ELSE 0.9::DOUBLE END AS tenure_adjustment,
    CASE WHEN total_policies >= 3 THEN 1.2::DOUBLE WHEN total_policies >= 2 THEN 1.1::DOUBLE ELSE 1::DOUBLE END AS policy_count_adjustment,
    CASE WHEN total_claims = 0 THEN 1.05::DOUBLE WHEN total_claims <= 1 THEN 1::DOUBLE WHEN total_claims <= 2 THEN 0.95::DOUBLE
      ELSE 0.9::DOUBLE END AS claims_adjustment FROM features),
renewals AS (
  SELECT *, least(adjusted_retention_probability * tenure_adjustment * policy_count_adjustment * claims_adjustment, 0.98::DOUBLE) AS renewal_probability_score,
    CASE WHEN least(adjusted_retention_probability * tenure_adjustment * policy_count_adjustment * claims_adjustment, 0.98::DOUBLE) >= 0.8::DOUBLE THEN 'Low Risk'
      WHEN least(adjusted_retention_probability * tenure_adjustment * policy_count_adjustment * claims_adjustment, 0.98::DOUBLE) >= 0.6::DOUBLE THEN 'Medium Risk'
      ELSE 'High Risk' END AS renewal_risk_category FROM adjustments),
at_risk AS (
  SELECT customer_id, policy_id, first_name, last_name, policy_type, CAST(premium_amount AS DOUBLE) AS premium_amount, renewal_probability_score,
    days_to_renewal, risk_category, clpv_segment, customer_lifetime_premium_value, avg_satisfaction_score, total_claims, payment_reliability_score,
    customer_lifetime_premium_value * 0.6::DOUBLE + CAST(premium_amount AS DOUBLE) * 0.4::DOUBLE - renewal_probability_score * 1000 AS priority_score
  FROM renewals WHERE renewal_risk_category = 'High Risk' AND days_to_renewal <= 120 AND policy_status = 'Active'),
segment_pricing AS (
  SELECT *, CASE clpv_segment WHEN 'Premium' THEN 'Premium Pricing' WHEN 'High Value' THEN 'Value-Based Pricing'
      WHEN 'Medium Value' THEN 'Competitive Pricing' ELSE 'Penetration Pricing' END AS pricing_strategy,
    customer_count * (recommended_premium - current_avg_premium) AS segment_revenue_impact FROM (
  SELECT clpv_segment, risk_category, count(*) AS customer_count, {davg("annualized_premium")} AS current_avg_premium,
    {davg("predicted_annual_premium * CASE clpv_segment WHEN 'Premium' THEN 0.8::DOUBLE WHEN 'High Value' THEN 0.9::DOUBLE WHEN 'Medium Value' THEN 1.1::DOUBLE ELSE 1.2::DOUBLE END")} AS recommended_premium,
    {davg("customer_lifetime_premium_value")} AS avg_clpv, {davg("adjusted_retention_probability", 10)} AS avg_retention_prob
  FROM value GROUP BY ALL)),
claim_scores AS (
  SELECT c.*, v.risk_category, v.payment_reliability_score, (CAST(claim_amount AS DOUBLE) - 5000) / 10000 AS claim_amount_zscore,
    CAST(date_diff('day', start_date, claim_date) AS INT) AS days_policy_to_claim,
    CASE WHEN claim_amount > 50000 THEN 2 ELSE 0 END + CASE WHEN fraud_indicator THEN 3 ELSE 0 END
      + CASE WHEN (CAST(claim_amount AS DOUBLE) - 5000) / 10000 > 2 THEN 1 ELSE 0 END + CASE WHEN days_to_settle < 5 THEN 1 ELSE 0 END
      + CASE WHEN v.payment_reliability_score < 0.8::DOUBLE THEN 1 ELSE 0 END AS fraud_risk_score
  FROM claims c JOIN value v USING (customer_id) LEFT JOIN (SELECT policy_id, start_date FROM policies) USING (policy_id)),
scored_claims AS (
  SELECT *, CASE WHEN fraud_risk_score >= 5 THEN 'High Risk' WHEN fraud_risk_score >= 3 THEN 'Medium Risk' ELSE 'Low Risk' END
    AS fraud_risk_category FROM claim_scores),
outlook AS (
  SELECT customer_id, min(renewal_probability_score) AS renewal_probability_score, CASE WHEN min(renewal_probability_score) >= 0.8::DOUBLE THEN 'Low Risk'
    WHEN min(renewal_probability_score) >= 0.6::DOUBLE THEN 'Medium Risk' ELSE 'High Risk' END AS renewal_risk_category FROM renewals GROUP BY customer_id),
priorities AS (
  SELECT customer_id, first_name, last_name, risk_category, clpv_segment, customer_lifetime_premium_value, renewal_probability_score, renewal_risk_category,
    CASE WHEN clpv_segment IN ('Premium', 'High Value') AND renewal_risk_category IN ('Medium Risk', 'High Risk') THEN 'Critical'
      WHEN clpv_segment = 'Medium Value' AND renewal_risk_category = 'High Risk' THEN 'High'
      WHEN clpv_segment IN ('Premium', 'High Value') AND renewal_risk_category = 'Low Risk' THEN 'Medium' ELSE 'Low' END AS retention_investment_priority
  FROM value LEFT JOIN outlook USING (customer_id)),
investment AS (
  SELECT *, customer_lifetime_premium_value * CASE retention_investment_priority WHEN 'Critical' THEN 0.05::DOUBLE WHEN 'High' THEN 0.03::DOUBLE
    WHEN 'Medium' THEN 0.02::DOUBLE ELSE 0.01::DOUBLE END AS recommended_retention_investment FROM priorities),
cross_sell AS (
  SELECT *, total_premium * CASE cross_sell_priority WHEN 'High Priority' THEN 0.6::DOUBLE WHEN 'Medium Priority' THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END
    AS estimated_additional_premium FROM (
  SELECT customer_id, first_name, last_name, risk_category, clpv_segment, policy_types_count, total_premium, customer_lifetime_premium_value,
    CASE WHEN clpv_segment IN ('Premium', 'High Value') AND risk_category = 'Low' THEN 'High Priority'
      WHEN clpv_segment = 'Medium Value' AND risk_category IN ('Low', 'Medium') THEN 'Medium Priority' ELSE 'Low Priority' END AS cross_sell_priority
  FROM value WHERE policy_types_count < 3)),
figures AS (
  SELECT * FROM (SELECT count(*) AS customers FROM customers),
  (SELECT count(*) AS policies, {dsum("premium_amount")} AS premium, {davg("premium_amount")} AS avg_policy_premium, {dsum("coverage_amount")} AS coverage,
    count(*) FILTER (WHERE policy_status = 'Active') AS active FROM policies),
  (SELECT count(*) AS claims, {dsum("claim_amount")} AS claimed, {davg("claim_amount")} AS avg_claim FROM claims),
  (SELECT {dsum("customer_lifetime_premium_value")} AS clpv, {davg("customer_lifetime_premium_value")} AS avg_clpv, {davg("total_premium")} AS avg_customer_premium,
    count(*) FILTER (WHERE clpv_segment IN ('Premium', 'High Value')) AS top,
    coalesce({dsum("CASE WHEN clpv_segment IN ('Premium', 'High Value') THEN customer_lifetime_premium_value END")}, 0) AS top_clpv,
    count(*) FILTER (WHERE risk_category = 'High') AS high_risk,
    coalesce({dsum("CASE WHEN policy_types_count = 1 THEN total_premium END")}, 0) AS single_premium,
    {davg("floor(customer_tenure_years)")} AS avg_tenure FROM value),
  (SELECT count(DISTINCT customer_id) AS at_risk, count(*) AS at_risk_policies, coalesce({dsum("premium_amount")}, 0) AS at_risk_premium FROM at_risk),
  (SELECT coalesce({dsum("customer_count * (recommended_premium - current_avg_premium)")}, 0) AS pricing_impact FROM segment_pricing),
  (SELECT coalesce({dsum("estimated_additional_premium")}, 0) AS potential, count(*) FILTER (WHERE cross_sell_priority = 'High Priority') AS cross_high FROM cross_sell),
  (SELECT count(*) FILTER (WHERE fraud_risk_category = 'High Risk') AS fraud_high,
    coalesce({dsum("CASE WHEN fraud_risk_category = 'High Risk' THEN claim_amount END")}, 0) AS fraud_exposure FROM scored_claims),
  (SELECT count(*) FILTER (WHERE retention_investment_priority = 'Critical') AS critical, {dsum("recommended_retention_investment")} AS invested,
    {dsum("customer_lifetime_premium_value")} AS protected FROM investment))
"""

_PROFILE_COLUMNS = (
    "customer_id, first_name, last_name, email, birth_date, age, gender, marital_status, income, credit_score, employment_status, education, "
    "state, zip_code, acquisition_date, risk_category, value_segment, composite_risk_score, claims_risk_score, credit_risk_score, age_risk_score, "
    "premium_risk_score, payment_risk_score, payment_reliability_score, total_policies, total_premium, avg_premium, total_coverage, "
    "policy_types_count, policy_types, total_claims, total_claim_amount, avg_claim_amount, max_claim_amount, policies_with_claims, "
    "total_payments, total_payment_amount, avg_payment_amount, late_payments_count, failed_payments_count"
)
_CLPV_COLUMNS = (
    "customer_id, customer_tenure_years, annualized_premium, retention_probability, adjusted_retention_probability, expected_lifetime_years, "
    "risk_premium_multiplier, predicted_annual_premium, customer_lifetime_premium_value, clpv_segment, satisfaction_adjustment, "
    "payment_reliability_adjustment, avg_satisfaction_score, satisfaction_resolution_rate"
)
_RENEWAL_COLUMNS = (
    "customer_id, policy_id, policy_type, days_to_renewal, renewal_probability_score, renewal_risk_category, tenure_adjustment, "
    "policy_count_adjustment, claims_adjustment, policy_age_years, policy_status"
)
_SCORED_COLUMNS = (
    "claim_id, customer_id, policy_id, claim_date, fraud_risk_score, fraud_risk_category, fraud_indicator, days_to_settle, claim_amount_zscore, "
    "days_policy_to_claim"
)


def _names(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


def _types_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("policy_types", F.array_join("policy_types", ","))


_BUILDERS: dict[str, Callable[[Roles], DataFrame]] = {
    "claims_per_customer": lambda r: risk.claims_per_customer(r.claims),
    "policy_metrics": lambda r: _types_as_text(risk.policy_metrics(r.policies)).withColumn(
        "policy_type_counts", F.array_join("policy_type_counts", ",")
    ),
    "payment_behavior": lambda r: risk.payment_behavior(r.payments),
    "composite_customer_risk": lambda r: r.risk.select(
        "customer_id", "age", "claims_risk_score", "credit_risk_score", "age_risk_score", "premium_risk_score",
        "payment_risk_score", "composite_risk_score", "risk_category",
    ),
    "risk_category": lambda r: risk.risk_distribution(r.profiles),
    "value_segment": lambda r: risk.value_distribution(r.profiles),
    "risk_value_matrix": lambda r: risk.risk_value_matrix(r.profiles),
    "policy_type_distribution": lambda r: risk.policy_type_distribution(r.policies),
    "policy_diversity": lambda r: risk.policy_diversity(r.profiles),
    "cross_sell_opportunities": lambda r: _types_as_text(risk.cross_sell_opportunities(r.profiles)),
    "cross_sell_targets": lambda r: risk.cross_sell_targets(r.profiles),
    "policy_risk_concentration": lambda r: risk.policy_risk_concentration(r.policies, r.profiles),
    "geo_concentration": lambda r: risk.geo_concentration(r.profiles),
    "monthly_claims": lambda r: risk.monthly_claims(r.claims),
    "seasonal_claims": lambda r: risk.seasonal_claims(r.claims),
    "monthly_payments": lambda r: risk.monthly_payments(r.payments),
    "payment_method_analysis": lambda r: risk.payment_method_analysis(r.payments),
    "customer_risk_profiles": lambda r: _types_as_text(r.profiles).select(*_names(_PROFILE_COLUMNS)),
    "risk_insights": lambda r: risk.risk_insights(r.profiles, r.policies, r.claims, r.payments),
    "tenure_premium": lambda r: value.tenure_premium(r.profiles, AS_OF).select(
        "customer_id", "customer_tenure_days", "customer_tenure_years", "annualized_premium", "premium_growth_rate"
    ),
    "customer_satisfaction": lambda r: value.customer_satisfaction(r.interactions),
    "retention_probability": lambda r: r.value.select(
        "customer_id", "retention_probability", "satisfaction_adjustment", "payment_reliability_adjustment",
        "adjusted_retention_probability",
    ),
    "lifetime_value": lambda r: r.value.select(*_names(_CLPV_COLUMNS)),
    "clpv_by_risk": lambda r: value.clpv_by_risk(r.value),
    "clpv_segments": lambda r: value.clpv_segments(r.value),
    "risk_clpv_matrix": lambda r: value.risk_clpv_matrix(r.value),
    "renewal_features": lambda r: value.renewal_features(r.policies, r.value, AS_OF).select(
        "policy_id", "days_to_renewal", "renewal_within_90_days", "renewed_successfully", "premium_to_income_ratio",
        "policy_age_years", "claims_frequency",
    ),
    "renewal_score": lambda r: r.renewals.select(*_names(_RENEWAL_COLUMNS)),
    "renewal_distribution": lambda r: value.renewal_distribution(r.renewals),
    "at_risk_policies": lambda r: r.at_risk,
    "at_risk_summary": lambda r: value.at_risk_summary(r.at_risk),
    "pricing_by_risk": lambda r: value.pricing_by_risk(r.value),
    "pricing_recommendations": lambda r: value.pricing_recommendations(value.pricing_by_risk(r.value)),
    "segment_pricing": lambda r: value.segment_pricing(r.value),
    "claim_fraud_score": lambda r: r.scored_claims.select(*_names(_SCORED_COLUMNS)),
    "claim_fraud_distribution": lambda r: value.fraud_distribution(r.scored_claims),
    "high_risk_claims": lambda r: value.high_risk_claims(r.scored_claims),
    "claims_patterns_quarter": lambda r: value.claims_by_quarter_and_risk(r.claims, r.value),
    "claims_patterns_weekday": lambda r: value.claims_by_weekday(r.claims, r.value),
    "claims_patterns_type": lambda r: value.claims_by_type_and_risk(r.claims, r.value, r.policies),
    "clpv_insights": lambda r: value.clpv_insights(r.value, r.at_risk, r.scored_claims),
    "executive_kpis": lambda r: dashboard.executive_kpis(r.figures),
    "retention_kpis": lambda r: dashboard.retention_kpis(r.figures),
    "tenure_distribution": lambda r: dashboard.tenure_distribution(r.profiles, AS_OF),
    "acquisition_channels": lambda r: dashboard.acquisition_channels(r.policies),
    "policy_profitability": lambda r: dashboard.policy_profitability(r.policies, r.claims),
    "growth_metrics": lambda r: dashboard.growth_metrics(r.figures),
    "high_value_customers": lambda r: dashboard.high_value_customers(r.value),
    "high_value_characteristics": lambda r: dashboard.high_value_characteristics(dashboard.high_value_customers(r.value)),
    "high_value_share": lambda r: dashboard.high_value_share(r.figures),
    "top_customers": lambda r: dashboard.top_customers(dashboard.high_value_customers(r.value)),
    "retention_investment": lambda r: r.investment,
    "retention_investment_summary": lambda r: dashboard.retention_investment_summary(r.investment),
    "critical_retention_customers": lambda r: dashboard.critical_retention_customers(r.investment),
    "cross_sell_analysis": lambda r: r.cross_sell,
    "cross_sell_summary": lambda r: dashboard.cross_sell_summary(r.cross_sell),
    "high_priority_cross_sell": lambda r: dashboard.high_priority_cross_sell(r.cross_sell),
    "portfolio_risk": lambda r: dashboard.portfolio_risk(r.profiles),
    "high_risk_share": lambda r: dashboard.high_risk_share(r.profiles),
    "fraud_exposure": lambda r: dashboard.fraud_exposure(r.scored_claims),
    "fraud_monthly_patterns": lambda r: dashboard.fraud_monthly_patterns(r.scored_claims),
    "executive_dashboard": lambda r: dashboard.executive_dashboard(r.value, r.renewals),
    "kpi_summary": lambda r: dashboard.kpi_summary(r.figures),
    "dashboard_matrix": lambda r: dashboard.dashboard_matrix(risk.risk_value_matrix(r.profiles)),
    "action_items": lambda r: dashboard.action_items(r.figures),
    "revenue_recommendations": lambda r: dashboard.revenue_recommendations(r.figures),
    "business_impact": lambda r: dashboard.business_impact(r.figures),
}


def queries() -> dict[str, Query]:
    """The queries, sharing one set of stage tables."""
    stages = Stages()

    def bind(build: Callable[[Roles], DataFrame]) -> Query:
        return lambda spark, folder: build(Roles(tune(spark), folder, stages))

    return {name: bind(build) for name, build in _BUILDERS.items()}


_CLAIM_SUMS = f"""count(*) AS claims_count, {dsum("claim_amount")} AS total_claim_amount, {davg("claim_amount")} AS avg_claim_amount"""
_CLAIM_SUMS_2 = f"""count(*) AS claim_count, {dsum("claim_amount")} AS total_claim_amount, {davg("claim_amount")} AS avg_claim_amount"""
_PAYMENT_SUMS = f"""count(*) AS payment_count, {dsum("payment_amount")} AS total_amount, {davg("payment_amount")} AS avg_amount,
  count(*) FILTER (WHERE late_payment_flag) AS late_payments, count(*) FILTER (WHERE payment_status = 'Failed') AS failed_payments"""
_CLPV_SUMS = f"""count(*) AS customer_count, {davg("customer_lifetime_premium_value")} AS avg_clpv"""
_RETENTION = f"""{davg("adjusted_retention_probability", 10)} AS avg_retention_prob"""
_LOSS = f"""count(*) AS customer_count, {dsum("total_premium")} AS total_premium, {dsum("total_claim_amount")} AS total_claims,
  {davg("composite_risk_score")} AS avg_risk_score"""
_MATRIX = f"""SELECT risk_category, value_segment, count(*) AS customer_count, {davg("composite_risk_score")} AS avg_risk_score,
  {dsum("total_premium")} AS total_premium_segment, {davg("total_premium")} AS avg_premium_segment FROM profiles GROUP BY ALL"""
_PRICING = f"""SELECT risk_category, count(*) AS customer_count,
  {davg("CASE WHEN total_premium > 0 THEN total_claim_amount / total_premium ELSE 0 END", 10)} AS avg_claims_ratio,
  {davg("total_premium - total_claim_amount")} AS avg_profitability, {davg("annualized_premium")} AS current_avg_premium,
  {davg("predicted_annual_premium")} AS recommended_avg_premium FROM value GROUP BY ALL"""


def _share(count: str, digits: int | None = 2) -> str:
    expression = f"CAST({count} AS DOUBLE) / CAST(sum({count}) OVER () AS DOUBLE) * 100"
    return r2(expression, digits) if digits is not None else expression


_SQL = {
    "claims_per_customer": "SELECT * FROM claims_pc",
    "policy_metrics": """SELECT p.*, c.policy_type_counts FROM policy_pc p JOIN (SELECT customer_id, string_agg(n, ',' ORDER BY policy_type)
        AS policy_type_counts FROM (SELECT customer_id, policy_type, count(*) AS n FROM policies GROUP BY ALL) GROUP BY customer_id) c USING (customer_id)""",
    "payment_behavior": "SELECT * FROM payment_pc",
    "composite_customer_risk": """SELECT customer_id, age, claims_risk_score, credit_risk_score, age_risk_score, premium_risk_score,
        payment_risk_score, composite_risk_score, risk_category FROM base""",
    "risk_category": f"SELECT *, {_share('customer_count')} AS percentage FROM (SELECT risk_category, count(*) AS customer_count FROM base GROUP BY ALL)",
    "value_segment": f"SELECT *, {_share('customer_count')} AS percentage FROM (SELECT value_segment, count(*) AS customer_count FROM profiles GROUP BY ALL)",
    "risk_value_matrix": f"SELECT *, {_share('customer_count')} AS segment_percentage FROM ({_MATRIX})",
    "policy_type_distribution": f"""SELECT *, {_share("policy_count")} AS policy_percentage, {_share("total_premium")} AS premium_percentage FROM (
        SELECT policy_type, count(*) AS policy_count, {dsum("premium_amount")} AS total_premium, {davg("premium_amount")} AS avg_premium,
        {dsum("coverage_amount")} AS total_coverage, count(DISTINCT customer_id) AS unique_customers FROM policies GROUP BY ALL)""",
    "policy_diversity": f"""SELECT policy_types_count, count(*) AS customer_count, {davg("total_premium")} AS avg_premium,
        {davg("composite_risk_score")} AS avg_risk_score FROM profiles GROUP BY ALL""",
    "cross_sell_opportunities": """SELECT customer_id, first_name, last_name, risk_category, value_segment, total_premium, policy_types_count,
        policy_types, composite_risk_score FROM profiles WHERE policy_types_count = 1""",
    "cross_sell_targets": """SELECT customer_id, first_name, last_name, risk_category, value_segment, total_premium, policy_types_count,
        composite_risk_score FROM profiles WHERE policy_types_count = 1 AND value_segment <> 'Low Value'""",
    "policy_risk_concentration": f"""SELECT policy_type, risk_category, count(*) AS policy_count, {dsum("premium_amount")} AS total_premium,
        {davg("premium_amount")} AS avg_premium FROM policies JOIN base USING (customer_id) GROUP BY ALL""",
    "geo_concentration": f"SELECT *, total_claims / total_premium * 100 AS state_loss_ratio FROM (SELECT state, {_LOSS} FROM profiles GROUP BY ALL)",
    "monthly_claims": f"SELECT CAST(month(claim_date) AS INT) AS claim_month, {_CLAIM_SUMS} FROM claims GROUP BY ALL",
    "seasonal_claims": f"""SELECT CASE WHEN month(claim_date) IN (12, 1, 2) THEN 'Winter' WHEN month(claim_date) IN (3, 4, 5) THEN 'Spring'
        WHEN month(claim_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, {_CLAIM_SUMS} FROM claims GROUP BY 1""",
    "monthly_payments": f"SELECT CAST(month(payment_date) AS INT) AS payment_month, {_PAYMENT_SUMS} FROM payments GROUP BY ALL",
    "payment_method_analysis": f"SELECT payment_method, {_PAYMENT_SUMS} FROM payments GROUP BY ALL",
    "customer_risk_profiles": f"SELECT {_PROFILE_COLUMNS} FROM profiles",
    "risk_insights": metric_rows(
        """SELECT (SELECT count(*) FROM base) AS n, (SELECT count(*) FROM base WHERE risk_category = 'Low') AS low,
        (SELECT count(*) FROM base WHERE risk_category = 'Medium') AS medium, (SELECT count(*) FROM base WHERE risk_category = 'High') AS high,
        (SELECT count(*) FROM base WHERE policy_types_count = 1) AS single, (SELECT count(*) FROM policies) AS p, (SELECT count(*) FROM claims) AS c,
        (SELECT count(*) FROM payments) AS pay, (SELECT count(*) FROM payments WHERE late_payment_flag) AS late, """
        + f"(SELECT {dsum('total_premium')} FROM base) AS premium",
        [
            ("Low Risk Share", r2("CAST(low AS DOUBLE) / n * 100"), "percentage"),
            ("Medium Risk Share", r2("CAST(medium AS DOUBLE) / n * 100"), "percentage"),
            ("High Risk Share", r2("CAST(high AS DOUBLE) / n * 100"), "percentage"),
            ("Cross-Sell Share", r2("CAST(single AS DOUBLE) / n * 100"), "percentage"),
            ("Total Premium", "premium", "currency"),
            ("Average Premium per Customer", "premium / n", "currency"),
            ("Claims Rate", r2("CAST(c AS DOUBLE) / p * 100"), "percentage"),
            ("Late Payment Rate", r2("CAST(late AS DOUBLE) / pay * 100"), "percentage"),
        ],
    ),
    "tenure_premium": """SELECT customer_id, customer_tenure_days, customer_tenure_years, annualized_premium, CASE WHEN customer_tenure_years > 1
        AND total_premium = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS premium_growth_rate FROM tenure""",
    "customer_satisfaction": """SELECT *, CAST(resolved_interactions AS DOUBLE) / total_interactions AS satisfaction_resolution_rate FROM satisfaction""",
    "retention_probability": """SELECT customer_id, retention_probability, satisfaction_adjustment, payment_reliability_adjustment,
        adjusted_retention_probability FROM kept""",
    "lifetime_value": f"SELECT {_CLPV_COLUMNS} FROM value",
    "clpv_by_risk": f"""SELECT risk_category, {_CLPV_SUMS}, {dsum("customer_lifetime_premium_value")} AS total_clpv, {_RETENTION} FROM value GROUP BY ALL""",
    "clpv_segments": f"""SELECT clpv_segment, {_CLPV_SUMS}, {dsum("customer_lifetime_premium_value")} AS total_segment_clpv, {_RETENTION}
        FROM value GROUP BY ALL""",
    "risk_clpv_matrix": "SELECT risk_category, clpv_segment, count(*) AS customer_count FROM value GROUP BY ALL",
    "renewal_features": """SELECT policy_id, days_to_renewal, CASE WHEN days_to_renewal <= 90 THEN 1 ELSE 0 END AS renewal_within_90_days,
        CASE WHEN policy_status IN ('Active', 'Renewed') THEN 1 ELSE 0 END AS renewed_successfully, premium_to_income_ratio, policy_age_years,
        CASE WHEN policy_age_years > 0 THEN total_claims / policy_age_years ELSE 0 END AS claims_frequency FROM features""",
    "renewal_score": f"SELECT {_RENEWAL_COLUMNS} FROM renewals",
    "renewal_distribution": f"""SELECT renewal_risk_category, count(*) AS policy_count, {davg("renewal_probability_score", 10)} AS avg_renewal_prob,
        {dsum("premium_amount")} AS total_premium_at_risk FROM renewals GROUP BY ALL""",
    "at_risk_policies": "SELECT * FROM at_risk",
    "at_risk_summary": f"""SELECT clpv_segment, risk_category, count(DISTINCT customer_id) AS customer_count, count(*) AS policy_count, {dsum("premium_amount")} AS premium_at_risk,
        {davg("renewal_probability_score", 10)} AS avg_renewal_prob FROM at_risk GROUP BY ALL""",
    "pricing_by_risk": _PRICING,
    "pricing_recommendations": f"""SELECT *, (recommended_avg_premium - current_avg_premium) / current_avg_premium * 100 AS pricing_adjustment_pct,
        customer_count * (recommended_avg_premium - current_avg_premium) AS annual_revenue_impact FROM ({_PRICING})""",
    "segment_pricing": "SELECT * FROM segment_pricing",
    "claim_fraud_score": f"SELECT {_SCORED_COLUMNS} FROM scored_claims",
    "claim_fraud_distribution": f"""SELECT *, total_claim_amount / sum(total_claim_amount) OVER () * 100 AS fraud_exposure_pct FROM (
        SELECT fraud_risk_category, {_CLAIM_SUMS_2}, {davg("fraud_risk_score")} AS avg_fraud_score FROM scored_claims GROUP BY ALL)""",
    "high_risk_claims": """SELECT claim_id, customer_id, policy_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_date, fraud_risk_score,
        fraud_indicator, days_to_settle FROM scored_claims WHERE fraud_risk_category = 'High Risk'""",
    "claims_patterns_quarter": f"""SELECT CAST(quarter(claim_date) AS INT) AS claim_quarter, risk_category, {_CLAIM_SUMS_2}
        FROM claims JOIN base USING (customer_id) GROUP BY ALL""",
    "claims_patterns_weekday": f"""SELECT CAST(dayofweek(claim_date) + 1 AS INT) AS claim_day_of_week, {_CLAIM_SUMS_2}
        FROM claims JOIN base USING (customer_id) GROUP BY ALL""",
    "claims_patterns_type": f"""SELECT policy_type, risk_category, {_CLAIM_SUMS_2} FROM claims JOIN base USING (customer_id)
        JOIN (SELECT policy_id, policy_type FROM policies) USING (policy_id) GROUP BY ALL""",
    "clpv_insights": metric_rows(
        f"""SELECT (SELECT count(*) FROM value) AS n, (SELECT {dsum("customer_lifetime_premium_value")} FROM value) AS total,
        (SELECT count(*) FROM value WHERE clpv_segment = 'Premium') AS a, (SELECT count(*) FROM value WHERE clpv_segment = 'High Value') AS b,
        (SELECT count(*) FROM value WHERE clpv_segment = 'Medium Value') AS c, (SELECT count(*) FROM value WHERE clpv_segment = 'Low Value') AS d,
        (SELECT count(DISTINCT customer_id) FROM at_risk) AS risky, (SELECT count(*) FROM scored_claims) AS claims,
        (SELECT count(*) FROM scored_claims WHERE fraud_risk_category = 'High Risk') AS high""",
        [
            ("Total Portfolio CLPV", "total", "currency"),
            ("Average CLPV", "total / n", "currency"),
            ("Premium Share", r2("CAST(a AS DOUBLE) / n * 100"), "percentage"),
            ("High Value Share", r2("CAST(b AS DOUBLE) / n * 100"), "percentage"),
            ("Medium Value Share", r2("CAST(c AS DOUBLE) / n * 100"), "percentage"),
            ("Low Value Share", r2("CAST(d AS DOUBLE) / n * 100"), "percentage"),
            ("At-Risk Share", r2("CAST(risky AS DOUBLE) / n * 100"), "percentage"),
            ("Investigation Rate", r2("CAST(high AS DOUBLE) / claims * 100"), "percentage"),
        ],
    ),
    "executive_kpis": metric_rows(
        "SELECT * FROM figures",
        [
            ("Total Customers", "customers", "count"),
            ("Total Policies", "policies", "count"),
            ("Total Claims", "claims", "count"),
            ("Total Premiums", "premium", "currency"),
            ("Total Coverage", "coverage", "currency"),
            ("Total Claim Amount", "claimed", "currency"),
            ("Average Premium per Customer", "avg_customer_premium", "currency"),
            ("Average Premium per Policy", "avg_policy_premium", "currency"),
            ("Average Claim Amount", "avg_claim", "currency"),
            ("Loss Ratio", "claimed / premium * 100", "percentage"),
            ("Claims Rate", "CAST(claims AS DOUBLE) / policies * 100", "percentage"),
            ("Total Portfolio CLPV", "clpv", "currency"),
            ("Average CLPV per Customer", "avg_clpv", "currency"),
        ],
    ),
    "retention_kpis": metric_rows(
        "SELECT * FROM figures",
        [
            ("Average Customer Tenure", "avg_tenure", "years"),
            ("Policy Retention Rate", "CAST(active AS DOUBLE) / policies * 100", "percentage"),
            ("At-Risk Customers", "at_risk", "count"),
            ("At-Risk Policies", "at_risk_policies", "count"),
            ("At-Risk Percentage", "CAST(at_risk AS DOUBLE) / customers * 100", "percentage"),
            ("Premium at Risk", "at_risk_premium", "currency"),
        ],
    ),
    "tenure_distribution": "SELECT CAST(floor(customer_tenure_years) AS INT) AS tenure_years, count(*) AS customer_count FROM tenure GROUP BY ALL",
    "acquisition_channels": f"""SELECT acquisition_channel, count(DISTINCT customer_id) AS customers_acquired, {dsum("premium_amount")} AS total_premium
        FROM policies GROUP BY ALL""",
    "policy_profitability": """SELECT *, total_claims / total_premium * 100 AS loss_ratio_by_type FROM (SELECT policy_type, count(*) AS policy_count,
        CAST(sum(premium_amount) AS DOUBLE) AS total_premium, CAST(sum(coalesce(claimed, 0)) AS DOUBLE) AS total_claims,
        CAST(sum(premium_amount - coalesce(claimed, 0)) AS DOUBLE) / count(*) AS avg_profit_per_policy,
        CAST(sum(premium_amount - coalesce(claimed, 0)) AS DOUBLE) AS total_profit FROM policies
        LEFT JOIN (SELECT policy_id, sum(claim_amount) AS claimed FROM claims GROUP BY policy_id) USING (policy_id) GROUP BY ALL)""",
    "growth_metrics": metric_rows(
        "SELECT * FROM figures",
        [
            ("Pricing Optimization Revenue Impact", "pricing_impact", "currency"),
            ("Cross-Selling Revenue Potential", "single_premium * 0.25::DOUBLE * 0.5::DOUBLE", "currency"),
            ("Total Growth Opportunity", "pricing_impact + single_premium * 0.25::DOUBLE * 0.5::DOUBLE", "currency"),
        ],
    ),
    "high_value_customers": """SELECT customer_id, first_name, last_name, customer_lifetime_premium_value, risk_category, clpv_segment, total_premium,
        adjusted_retention_probability FROM value WHERE clpv_segment IN ('Premium', 'High Value')""",
    "high_value_characteristics": f"""SELECT risk_category, clpv_segment, {_CLPV_SUMS}, {davg("total_premium")} AS avg_current_premium, {_RETENTION}
        FROM value WHERE clpv_segment IN ('Premium', 'High Value') GROUP BY ALL""",
    "high_value_share": metric_rows(
        "SELECT * FROM figures",
        [
            ("High-Value Customers", "top", "count"),
            ("High-Value CLPV", "top_clpv", "currency"),
            ("High-Value Customer Share", "CAST(top AS DOUBLE) / customers * 100", "percentage"),
            ("High-Value CLPV Share", "top_clpv / clpv * 100", "percentage"),
        ],
    ),
    "top_customers": """SELECT customer_id, first_name, last_name, customer_lifetime_premium_value, risk_category, clpv_segment, total_premium,
        adjusted_retention_probability FROM value WHERE clpv_segment IN ('Premium', 'High Value')
        ORDER BY customer_lifetime_premium_value DESC, customer_id LIMIT 50""",
    "retention_investment": "SELECT * FROM investment",
    "retention_investment_summary": f"""SELECT *, total_clpv_at_risk / total_recommended_investment AS retention_roi FROM (
        SELECT retention_investment_priority, count(*) AS customer_count, {dsum("customer_lifetime_premium_value")} AS total_clpv_at_risk,
        {davg("renewal_probability_score", 10)} AS avg_renewal_probability, {dsum("recommended_retention_investment")} AS total_recommended_investment
        FROM investment GROUP BY ALL)""",
    "critical_retention_customers": """SELECT customer_id, first_name, last_name, customer_lifetime_premium_value, renewal_probability_score,
        recommended_retention_investment FROM investment WHERE retention_investment_priority = 'Critical'""",
    "cross_sell_analysis": "SELECT * FROM cross_sell",
    "cross_sell_summary": f"""SELECT cross_sell_priority, clpv_segment, count(*) AS customer_count, {dsum("total_premium")} AS current_premium,
        {dsum("estimated_additional_premium")} AS potential_additional_premium, {davg("customer_lifetime_premium_value")} AS avg_clpv
        FROM cross_sell GROUP BY ALL""",
    "high_priority_cross_sell": "SELECT * FROM cross_sell WHERE cross_sell_priority = 'High Priority'",
    "portfolio_risk": f"""SELECT *, total_claims / total_premium * 100 AS segment_loss_ratio FROM (SELECT risk_category, value_segment, {_LOSS}
        FROM profiles GROUP BY ALL)""",
    "high_risk_share": f"""SELECT high_risk_count, high_risk_premium, CAST(high_risk_count AS DOUBLE) / n * 100 AS high_risk_percentage,
        high_risk_premium / premium * 100 AS high_risk_premium_percentage FROM (SELECT count(*) FILTER (WHERE risk_category = 'High') AS high_risk_count,
        coalesce({dsum("CASE WHEN risk_category = 'High' THEN total_premium END")}, 0) AS high_risk_premium, count(*) AS n, {dsum("total_premium")} AS premium
        FROM base)""",
    "fraud_exposure": f"""SELECT *, total_exposure / sum(total_exposure) OVER () * 100 AS exposure_percentage,
        CASE fraud_risk_category WHEN 'High Risk' THEN total_exposure * 0.15::DOUBLE ELSE 0 END AS prevention_savings FROM (
        SELECT fraud_risk_category, count(*) AS claim_count, {dsum("claim_amount")} AS total_exposure, {davg("fraud_risk_score")} AS avg_fraud_score
        FROM scored_claims GROUP BY ALL)""",
    "fraud_monthly_patterns": f"""SELECT CAST(month(claim_date) AS INT) AS claim_month, fraud_risk_category, count(*) AS claim_count,
        {dsum("claim_amount")} AS total_exposure FROM scored_claims GROUP BY ALL""",
    "executive_dashboard": """SELECT customer_id, first_name, last_name, state, risk_category, value_segment, clpv_segment, total_premium,
        customer_lifetime_premium_value, total_claims, total_claim_amount, composite_risk_score, adjusted_retention_probability, policy_types_count,
        total_policies, payment_reliability_score, renewal_probability_score, renewal_risk_category FROM value LEFT JOIN outlook USING (customer_id)""",
    "kpi_summary": "SELECT metric_name AS kpi_name, metric_value AS kpi_value FROM ("
    + metric_rows(
        "SELECT * FROM figures",
        [
            ("total_customers", "customers", ""),
            ("total_policies", "policies", ""),
            ("total_premiums", "premium", ""),
            ("total_claims", "claims", ""),
            ("total_claim_amount", "claimed", ""),
            ("loss_ratio", "claimed / premium * 100", ""),
            ("claims_rate", "CAST(claims AS DOUBLE) / policies * 100", ""),
            ("avg_clpv", "avg_clpv", ""),
            ("total_portfolio_clpv", "clpv", ""),
            ("retention_rate", "CAST(active AS DOUBLE) / policies * 100", ""),
            ("at_risk_customers", "at_risk", ""),
            ("premium_at_risk", "at_risk_premium", ""),
            ("pricing_revenue_impact", "pricing_impact", ""),
            ("cross_sell_potential", "potential", ""),
            ("fraud_prevention_savings", "fraud_exposure * 0.15::DOUBLE", ""),
        ],
    )
    + ")",
    "dashboard_matrix": f"SELECT *, {_share('customer_count', None)} AS segment_percentage FROM ({_MATRIX})",
    "action_items": """SELECT 'Customer Retention' AS action_category, 'Contact critical retention customers within 7 days' AS action_description,
        CAST(critical AS DOUBLE) AS customer_count, 'Critical' AS priority FROM figures
        UNION ALL SELECT 'Cross-Selling', 'Launch cross-selling campaign for high-priority customers', cross_high, 'High' FROM figures
        UNION ALL SELECT 'Fraud Investigation', 'Investigate high-risk fraud claims', fraud_high, 'High' FROM figures
        UNION ALL SELECT 'Pricing Optimization', 'Implement risk-based pricing adjustments', customers, 'Medium' FROM figures
        UNION ALL SELECT 'Portfolio Rebalancing', 'Review high-risk customer concentration', high_risk, 'Medium' FROM figures""",
    "revenue_recommendations": """SELECT 'Retention Investment' AS recommendation, invested AS investment_required, protected AS expected_return,
        protected / invested AS roi_multiple FROM figures
        UNION ALL SELECT 'Pricing Optimization', pricing_impact, pricing_impact * 5, 5 FROM figures
        UNION ALL SELECT 'Cross-Selling', potential * 0.25::DOUBLE, potential, 4 FROM figures
        UNION ALL SELECT 'Fraud Prevention', fraud_exposure * 0.15::DOUBLE * 0.1::DOUBLE, fraud_exposure * 0.15::DOUBLE, 10 FROM figures""",
    "business_impact": """SELECT pricing_impact + potential + fraud_exposure * 0.15::DOUBLE AS total_business_impact,
        (pricing_impact + potential + fraud_exposure * 0.15::DOUBLE) / premium * 100 AS impact_percentage FROM figures""",
}

ORACLES = {name: ROLES_SQL + sql for name, sql in _SQL.items()}
