"""Insurance customer risk: metrics per customer, composite score, segments, portfolio reports.

Frames: ``customers`` (customer_id, birth_date, credit_score, state, ...), ``policies``
(policy_id, customer_id, policy_type, premium_amount, coverage_amount, ...), ``claims``
(claim_id, customer_id, policy_id, claim_amount, claim_date, ...) and ``payments``
(payment_id, customer_id, payment_amount, payment_date, payment_method, payment_status,
late_payment_flag). One row per id; profiles have one row per customer.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import at_least, case_bucket
from ..functions.dates import season, years_since
from ..functions.numbers import count_where, exact, exact_avg, exact_sum, percent, ratio
from ..operators.aggregates import exact_quantiles, metric_rows, totals, with_share

# Scores per band, weights and category bounds.
CREDIT_BANDS = [(750, 1.0), (700, 2.0), (650, 3.0), (600, 4.0)]
PREMIUM_BANDS = [(5000, 3.0), (2000, 2.0)]
RELIABILITY_BANDS = [(0.95, 1.0), (0.85, 2.0), (0.75, 3.0)]
WEIGHTS = {
    "claims_risk_score": "0.30",
    "credit_risk_score": "0.25",
    "age_risk_score": "0.15",
    "premium_risk_score": "0.15",
    "payment_risk_score": "0.15",
}
CATEGORY_BOUNDS = (1.75, 2.75)
VALUE_PERCENTILES = (0.7, 0.9)


def claims_per_customer(claims: DataFrame) -> DataFrame:
    return claims.groupBy("customer_id").agg(
        F.count("claim_id").alias("total_claims"),
        exact_sum("claim_amount").alias("total_claim_amount"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
        F.max("claim_amount").cast("double").alias("max_claim_amount"),
        F.countDistinct("policy_id").alias("policies_with_claims"),
    )


def policy_metrics(policies: DataFrame) -> DataFrame:
    """Policies per customer. ``policy_types`` lists the distinct types, ``policy_type_counts``
    how often each occurs: all that a list with one entry per policy would hold, in a size
    bounded by the number of types."""
    per_type = policies.groupBy("customer_id", "policy_type").agg(
        F.count("policy_id").alias("n"),
        F.sum(exact("premium_amount")).alias("premium"),
        F.count("premium_amount").alias("premiums"),
        F.sum(exact("coverage_amount")).alias("coverage"),
    )
    typed = F.when(F.col("policy_type").isNotNull(), F.struct("policy_type", "n"))
    per_customer = per_type.groupBy("customer_id").agg(
        F.sum("n").alias("total_policies"),
        F.sum("premium").cast("double").alias("total_premium"),
        ratio(F.sum("premium"), F.sum("premiums")).alias("avg_premium"),
        F.sum("coverage").cast("double").alias("total_coverage"),
        F.count("policy_type").alias("policy_types_count"),
        F.array_sort(F.collect_list(typed)).alias("types"),
    )
    return per_customer.withColumns(
        {"policy_types": F.col("types.policy_type"), "policy_type_counts": F.col("types.n")}
    ).drop("types")


def payment_behavior(payments: DataFrame, failed_weight: int = 2) -> DataFrame:
    """Late and failed payments per customer; reliability is 1 less their weighted share."""
    grouped = payments.groupBy("customer_id").agg(
        F.count("payment_id").alias("total_payments"),
        exact_sum("payment_amount").alias("total_payment_amount"),
        exact_avg("payment_amount").alias("avg_payment_amount"),
        count_where(F.col("late_payment_flag")).alias("late_payments_count"),
        count_where(F.col("payment_status") == "Failed").alias("failed_payments_count"),
    )
    bad = F.col("late_payments_count") + F.col("failed_payments_count") * failed_weight
    reliability = F.when(F.col("total_payments") == 0, F.lit(1.0)).otherwise(1.0 - bad / F.col("total_payments"))
    return grouped.withColumn("payment_reliability_score", reliability)


def _age_risk(age: Column) -> Column:
    return case_bucket([(age < 25, 3.0), (age.between(25, 65), 1.0), (age.between(66, 75), 2.0)], 3.0)


def _claims_risk(claims: Column) -> Column:
    return case_bucket([(claims == 0, 1.0), (claims == 1, 2.0), (claims == 2, 3.0), (claims >= 3, 4.0)], 1.0)


def customer_risk(
    customers: DataFrame, claims: DataFrame, policies: DataFrame, payments: DataFrame, as_of: date
) -> DataFrame:
    """All customers with their metrics, five sub-scores, composite score and risk category.

    Customers without claims, policies or payments get 0 and full reliability. Each source is
    reduced to one row per customer before it is joined, and all joins use the same key, so the
    customers are shuffled once.
    """
    joined = (
        customers.join(claims_per_customer(claims), "customer_id", "left")
        .join(policy_metrics(policies), "customer_id", "left")
        .join(payment_behavior(payments), "customer_id", "left")
    )
    counts = [
        "total_claims",
        "policies_with_claims",
        "total_policies",
        "policy_types_count",
        "total_payments",
        "late_payments_count",
        "failed_payments_count",
    ]
    amounts = [
        "total_claim_amount",
        "avg_claim_amount",
        "max_claim_amount",
        "total_premium",
        "avg_premium",
        "total_coverage",
        "total_payment_amount",
        "avg_payment_amount",
    ]
    filled = joined.fillna(
        {**dict.fromkeys(counts, 0), **dict.fromkeys(amounts, 0.0), "payment_reliability_score": 1.0}
    )
    scored = filled.withColumn("age", F.floor(years_since("birth_date", as_of)).cast("int")).withColumns(
        {
            "claims_risk_score": _claims_risk(F.col("total_claims")),
            "credit_risk_score": at_least("credit_score", CREDIT_BANDS, 5.0),
            "age_risk_score": _age_risk(F.col("age")),
            "premium_risk_score": at_least("total_premium", PREMIUM_BANDS, 1.0),
            "payment_risk_score": at_least("payment_reliability_score", RELIABILITY_BANDS, 4.0),
        }
    )
    # Decimal weights: a score on a category bound is on it exactly.
    composite = sum(
        (F.col(c).cast("decimal(2,1)") * F.lit(Decimal(w)) for c, w in WEIGHTS.items()), F.lit(Decimal("0.00"))
    )
    low, medium = CATEGORY_BOUNDS
    scored = scored.withColumn("composite_risk_score", composite.cast("double"))
    score = F.col("composite_risk_score")
    return scored.withColumn("risk_category", case_bucket([(score <= low, "Low"), (score <= medium, "Medium")], "High"))


def value_thresholds(risk: DataFrame, percentiles: Sequence[float] = VALUE_PERCENTILES) -> list[Decimal | None]:
    """Premium at the given percentiles. Reads ``risk`` several times: hand in a stored table."""
    return exact_quantiles(risk, "total_premium", percentiles)


def with_value_segment(risk: DataFrame, thresholds: Sequence[Decimal | None]) -> DataFrame:
    medium, high = thresholds
    premium = exact("total_premium")
    return risk.withColumn(
        "value_segment",
        case_bucket([(premium >= F.lit(high), "High Value"), (premium >= F.lit(medium), "Medium Value")], "Low Value"),
    )


def risk_distribution(profiles: DataFrame) -> DataFrame:
    grouped = profiles.groupBy("risk_category").agg(F.count("*").alias("customer_count"))
    return with_share(grouped, "customer_count", "percentage").orderBy(F.desc("customer_count"), "risk_category")


def value_distribution(profiles: DataFrame) -> DataFrame:
    grouped = profiles.groupBy("value_segment").agg(F.count("*").alias("customer_count"))
    return with_share(grouped, "customer_count", "percentage").orderBy("value_segment")


def risk_value_matrix(profiles: DataFrame) -> DataFrame:
    grouped = profiles.groupBy("risk_category", "value_segment").agg(
        F.count("*").alias("customer_count"),
        exact_avg("composite_risk_score").alias("avg_risk_score"),
        exact_sum("total_premium").alias("total_premium_segment"),
        exact_avg("total_premium").alias("avg_premium_segment"),
    )
    return with_share(grouped, "customer_count", "segment_percentage").orderBy("risk_category", "value_segment")


def policy_type_distribution(policies: DataFrame) -> DataFrame:
    """Policies, premium and customers per type, with the type's share of both totals."""
    grouped = policies.groupBy("policy_type").agg(
        F.count("*").alias("policy_count"),
        exact_sum("premium_amount").alias("total_premium"),
        exact_avg("premium_amount").alias("avg_premium"),
        exact_sum("coverage_amount").alias("total_coverage"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    shared = with_share(grouped, "policy_count", "policy_percentage")
    return with_share(shared, "total_premium", "premium_percentage").orderBy(F.desc("policy_count"), "policy_type")


def policy_diversity(profiles: DataFrame) -> DataFrame:
    return (
        profiles.groupBy("policy_types_count")
        .agg(
            F.count("*").alias("customer_count"),
            exact_avg("total_premium").alias("avg_premium"),
            exact_avg("composite_risk_score").alias("avg_risk_score"),
        )
        .orderBy("policy_types_count")
    )


def cross_sell_opportunities(profiles: DataFrame) -> DataFrame:
    """Customers with one type of policy."""
    return profiles.where("policy_types_count = 1").select(
        "customer_id",
        "first_name",
        "last_name",
        "risk_category",
        "value_segment",
        "total_premium",
        "policy_types_count",
        "policy_types",
        "composite_risk_score",
    )


def cross_sell_targets(profiles: DataFrame) -> DataFrame:
    """Those above low value."""
    return cross_sell_opportunities(profiles).where("value_segment <> 'Low Value'").drop("policy_types")


def policy_risk_concentration(policies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Policies per type and risk category of the customer. Policies are summed per customer
    and type before the join."""
    per_customer = policies.groupBy("customer_id", "policy_type").agg(
        F.count("*").alias("n"),
        F.sum(exact("premium_amount")).alias("premium"),
        F.count("premium_amount").alias("premiums"),
    )
    return (
        per_customer.join(profiles.select("customer_id", "risk_category"), "customer_id")
        .groupBy("policy_type", "risk_category")
        .agg(
            F.sum("n").alias("policy_count"),
            F.sum("premium").cast("double").alias("total_premium"),
            ratio(F.sum("premium"), F.sum("premiums")).alias("avg_premium"),
        )
        .orderBy("policy_type", "risk_category")
    )


def loss_concentration(profiles: DataFrame, *keys: str, name: str) -> DataFrame:
    """Customers, premium, claims and loss ratio per group of customers."""
    grouped = profiles.groupBy(*keys).agg(
        F.count("*").alias("customer_count"),
        exact_sum("total_premium").alias("total_premium"),
        exact_sum("total_claim_amount").alias("total_claims"),
        exact_avg("composite_risk_score").alias("avg_risk_score"),
    )
    loss = percent(F.col("total_claims"), F.col("total_premium"), None)
    return grouped.withColumn(name, loss).orderBy(F.desc(name), *keys)


def geo_concentration(profiles: DataFrame) -> DataFrame:
    return loss_concentration(profiles, "state", name="state_loss_ratio")


def _claims_by(claims: DataFrame, period: Column) -> DataFrame:
    return claims.groupBy(period).agg(
        F.count("*").alias("claims_count"),
        exact_sum("claim_amount").alias("total_claim_amount"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
    )


def monthly_claims(claims: DataFrame) -> DataFrame:
    return _claims_by(claims, F.month("claim_date").alias("claim_month")).orderBy("claim_month")


def seasonal_claims(claims: DataFrame) -> DataFrame:
    return _claims_by(claims, season("claim_date").alias("season")).orderBy(F.desc("claims_count"), "season")


def _payments_by(payments: DataFrame, key: Column) -> DataFrame:
    return payments.groupBy(key).agg(
        F.count("*").alias("payment_count"),
        exact_sum("payment_amount").alias("total_amount"),
        exact_avg("payment_amount").alias("avg_amount"),
        count_where(F.col("late_payment_flag")).alias("late_payments"),
        count_where(F.col("payment_status") == "Failed").alias("failed_payments"),
    )


def monthly_payments(payments: DataFrame) -> DataFrame:
    return _payments_by(payments, F.month("payment_date").alias("payment_month")).orderBy(F.desc("payment_month"))


def payment_method_analysis(payments: DataFrame) -> DataFrame:
    return _payments_by(payments, F.col("payment_method")).orderBy(F.desc("payment_count"), "payment_method")


def risk_insights(profiles: DataFrame, policies: DataFrame, claims: DataFrame, payments: DataFrame) -> DataFrame:
    """Portfolio shares and rates as metric rows; the late rate is per payment."""
    one_row = profiles.agg(
        F.count("*").alias("customers"),
        *[count_where(F.col("risk_category") == c).alias(c) for c in ("Low", "Medium", "High")],
        count_where(F.col("policy_types_count") == 1).alias("single"),
        exact_sum("total_premium").alias("premium"),
    ).withColumns(
        {
            "policies": totals(policies, n=F.count("*")),
            "claims": totals(claims, n=F.count("*")),
            "payments": totals(payments, n=F.count("*"), late=count_where(F.col("late_payment_flag"))),
        }
    )
    customers = F.col("customers")
    return metric_rows(
        one_row,
        [(f"{c} Risk Share", percent(F.col(c), customers), "percentage") for c in ("Low", "Medium", "High")]
        + [
            ("Cross-Sell Share", percent(F.col("single"), customers), "percentage"),
            ("Total Premium", F.col("premium"), "currency"),
            ("Average Premium per Customer", ratio(F.col("premium"), customers), "currency"),
            ("Claims Rate", percent(F.col("claims.n"), F.col("policies.n")), "percentage"),
            ("Late Payment Rate", percent(F.col("payments.late"), F.col("payments.n")), "percentage"),
        ],
    )
