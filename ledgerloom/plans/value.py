"""Customer lifetime value, renewals, pricing and claim fraud.

``profiles`` is the customer risk table. ``value`` extends it by the lifetime-value columns and
keeps one row per customer; ``renewals`` has one row per policy; scored claims one per claim.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import at_least, case_bucket, flag
from ..functions.dates import years_since
from ..functions.numbers import SHARE_DIGITS, cap, exact, exact_avg, exact_sum, percent, ratio, zscore
from ..functions.numbers import count_where
from ..operators.aggregates import exact_quantiles, metric_rows, totals, with_share

# Probabilities, adjustments, multipliers and bounds.
BASE_RETENTION = {"Low": 0.85, "Medium": 0.75, "High": 0.65}
SATISFACTION_ADJUSTMENT = ([(4.0, 1.15), (3.5, 1.0), (3.0, 0.9)], 0.8)
RELIABILITY_ADJUSTMENT = ([(0.95, 1.1), (0.85, 1.0)], 0.9)
PREMIUM_MULTIPLIER = {"Low": 0.9, "Medium": 1.0, "High": 1.2}
VALUE_PERCENTILES = (0.6, 0.85, 0.95)
TENURE_ADJUSTMENT = ([(5, 1.15), (3, 1.1), (1, 1.0)], 0.9)
POLICY_COUNT_ADJUSTMENT = ([(3, 1.2), (2, 1.1)], 1.0)
RENEWAL_BANDS = ([(0.8, "Low Risk"), (0.6, "Medium Risk")], "High Risk")
PRICE_SENSITIVITY = {"Premium": 0.8, "High Value": 0.9, "Medium Value": 1.1, "Low Value": 1.2}
PRICING_STRATEGY = {
    "Premium": "Premium Pricing",
    "High Value": "Value-Based Pricing",
    "Medium Value": "Competitive Pricing",
    "Low Value": "Penetration Pricing",
}
FRAUD_BANDS = ([(5, "High Risk"), (3, "Medium Risk")], "Low Risk")


def _by_label(c: str, values: dict, default=None) -> Column:
    """Lookup by label; the last entry is the default."""
    *first, (_, last) = values.items()
    return case_bucket([(F.col(c) == k, v) for k, v in first], last if default is None else default)


def tenure_premium(profiles: DataFrame, as_of: date) -> DataFrame:
    """Tenure in years and premium per year. The growth rate compares that premium with itself,
    so it is 0 wherever it is defined; it says nothing about growth."""
    years = F.col("customer_tenure_years")
    per_year = ratio(F.col("total_premium"), years)
    return (
        profiles.withColumn("customer_tenure_days", F.datediff(F.lit(as_of), "acquisition_date"))
        .withColumn("customer_tenure_years", years_since("acquisition_date", as_of))
        .withColumn("annualized_premium", F.when(years > 0, per_year).otherwise(F.col("total_premium")))
        .withColumn(
            "premium_growth_rate",
            F.when(years > 1, ratio(F.col("annualized_premium") - per_year, per_year)).otherwise(0.0),
        )
    )


def customer_satisfaction(interactions: DataFrame) -> DataFrame:
    grouped = interactions.groupBy("customer_id").agg(
        exact_avg("satisfaction_score").alias("avg_satisfaction_score"),
        F.count("interaction_id").alias("total_interactions"),
        count_where(F.col("resolution_status") == "Resolved").alias("resolved_interactions"),
    )
    rate = F.coalesce(ratio(F.col("resolved_interactions"), F.col("total_interactions")), F.lit(1.0))
    return grouped.withColumn("satisfaction_resolution_rate", rate)


SATISFACTION_DEFAULTS = {
    "avg_satisfaction_score": 3.5,
    "total_interactions": 0,
    "resolved_interactions": 0,
    "satisfaction_resolution_rate": 1.0,
}


def retention_probability(df: DataFrame, highest: float = 0.95) -> DataFrame:
    """Base by risk category, adjusted for satisfaction and payments, capped."""
    adjusted = df.withColumns(
        {
            "retention_probability": _by_label("risk_category", BASE_RETENTION),
            "satisfaction_adjustment": at_least("avg_satisfaction_score", *SATISFACTION_ADJUSTMENT),
            "payment_reliability_adjustment": at_least("payment_reliability_score", *RELIABILITY_ADJUSTMENT),
        }
    )
    product = (
        F.col("retention_probability") * F.col("satisfaction_adjustment") * F.col("payment_reliability_adjustment")
    )
    return adjusted.withColumn("adjusted_retention_probability", cap(product, highest))


def lifetime_value(profiles: DataFrame, interactions: DataFrame, as_of: date) -> DataFrame:
    """Profiles with tenure, satisfaction, retention and lifetime premium value."""
    base = (
        tenure_premium(profiles, as_of)
        .join(customer_satisfaction(interactions), "customer_id", "left")
        .fillna(SATISFACTION_DEFAULTS)
    )
    keep = F.col("adjusted_retention_probability")
    return (
        retention_probability(base)
        .withColumns(
            {
                "expected_lifetime_years": F.lit(3.0) * keep + (F.lit(1.0) - keep) * F.lit(1.5),
                "risk_premium_multiplier": _by_label("risk_category", PREMIUM_MULTIPLIER),
            }
        )
        .withColumn("predicted_annual_premium", F.col("annualized_premium") * F.col("risk_premium_multiplier"))
        .withColumn(
            "customer_lifetime_premium_value", F.col("predicted_annual_premium") * F.col("expected_lifetime_years")
        )
    )


def value_thresholds(value: DataFrame, percentiles: Sequence[float] = VALUE_PERCENTILES) -> list[Decimal | None]:
    """Lifetime value at the given percentiles. Hand in a stored table."""
    return exact_quantiles(value, "customer_lifetime_premium_value", percentiles)


def with_clpv_segment(value: DataFrame, thresholds: Sequence[Decimal | None]) -> DataFrame:
    medium, high, premium = thresholds
    amount = exact("customer_lifetime_premium_value")
    return value.withColumn(
        "clpv_segment",
        case_bucket(
            [
                (amount >= F.lit(premium), "Premium"),
                (amount >= F.lit(high), "High Value"),
                (amount >= F.lit(medium), "Medium Value"),
            ],
            "Low Value",
        ),
    )


def _value_summary(value: DataFrame, key: str, total: str) -> DataFrame:
    return (
        value.groupBy(key)
        .agg(
            F.count("*").alias("customer_count"),
            exact_avg("customer_lifetime_premium_value").alias("avg_clpv"),
            exact_sum("customer_lifetime_premium_value").alias(total),
            exact_avg("adjusted_retention_probability", SHARE_DIGITS).alias("avg_retention_prob"),
        )
        .orderBy(F.desc("avg_clpv"))
    )


def clpv_by_risk(value: DataFrame) -> DataFrame:
    return _value_summary(value, "risk_category", "total_clpv")


def clpv_segments(value: DataFrame) -> DataFrame:
    return _value_summary(value, "clpv_segment", "total_segment_clpv")


def risk_clpv_matrix(value: DataFrame) -> DataFrame:
    grouped = value.groupBy("risk_category", "clpv_segment").agg(F.count("*").alias("customer_count"))
    return grouped.orderBy("risk_category", "clpv_segment")


# --- renewals ------------------------------------------------------------------------------

_VALUE_COLUMNS = (
    "customer_id",
    "first_name",
    "last_name",
    "risk_category",
    "clpv_segment",
    "composite_risk_score",
    "adjusted_retention_probability",
    "customer_lifetime_premium_value",
    "avg_satisfaction_score",
    "payment_reliability_score",
    "total_claims",
    "customer_tenure_years",
    "total_policies",
    "policy_types_count",
)


def renewal_features(
    policies: DataFrame,
    value: DataFrame,
    as_of: date,
    soon_days: int = 90,
    renewed: Sequence[str] = ("Active", "Renewed"),
) -> DataFrame:
    """Policies with their customer's value columns and renewal features."""
    joined = policies.join(value.select(*_VALUE_COLUMNS), "customer_id")
    income = ratio(F.col("customer_lifetime_premium_value"), F.col("customer_tenure_years"))
    days = F.datediff("renewal_date", F.lit(as_of))
    age = F.col("policy_age_years")
    return (
        joined.withColumns(
            {
                "days_to_renewal": days,
                "renewal_within_90_days": flag(days <= soon_days),
                "renewed_successfully": flag(F.col("policy_status").isin(list(renewed))),
                "premium_to_income_ratio": ratio(F.col("premium_amount"), income),
                "policy_age_years": years_since("start_date", as_of),
            }
        )
        .withColumn("claims_frequency", F.when(age > 0, ratio(F.col("total_claims"), age)).otherwise(F.lit(0.0)))
    )


def renewal_score(features: DataFrame, highest: float = 0.98) -> DataFrame:
    """Retention adjusted for tenure, number of policies and claims, capped, with risk band."""
    claims = F.col("total_claims")
    adjusted = features.withColumns(
        {
            "base_renewal_probability": F.col("adjusted_retention_probability"),
            "tenure_adjustment": at_least("customer_tenure_years", *TENURE_ADJUSTMENT),
            "policy_count_adjustment": at_least("total_policies", *POLICY_COUNT_ADJUSTMENT),
            "claims_adjustment": case_bucket([(claims == 0, 1.05), (claims <= 1, 1.0), (claims <= 2, 0.95)], 0.9),
        }
    )
    product = (
        F.col("base_renewal_probability")
        * F.col("tenure_adjustment")
        * F.col("policy_count_adjustment")
        * F.col("claims_adjustment")
    )
    return adjusted.withColumn("renewal_probability_score", cap(product, highest)).withColumn(
        "renewal_risk_category", at_least("renewal_probability_score", *RENEWAL_BANDS)
    )


def renewal_distribution(renewals: DataFrame) -> DataFrame:
    return (
        renewals.groupBy("renewal_risk_category")
        .agg(
            F.count("*").alias("policy_count"),
            exact_avg("renewal_probability_score", SHARE_DIGITS).alias("avg_renewal_prob"),
            exact_sum("premium_amount").alias("total_premium_at_risk"),
        )
        .orderBy(F.desc("avg_renewal_prob"))
    )


def at_risk_policies(renewals: DataFrame, within_days: int = 120) -> DataFrame:
    """Active policies up for renewal that will probably not be renewed, by priority."""
    chosen = renewals.where(
        (F.col("renewal_risk_category") == "High Risk")
        & (F.col("days_to_renewal") <= within_days)
        & (F.col("policy_status") == "Active")
    )
    priority = (
        F.col("customer_lifetime_premium_value") * 0.6
        + F.col("premium_amount").cast("double") * 0.4
        - F.col("renewal_probability_score") * 1000
    )
    return chosen.select(
        "customer_id",
        "policy_id",
        "first_name",
        "last_name",
        "policy_type",
        F.col("premium_amount").cast("double").alias("premium_amount"),
        "renewal_probability_score",
        "days_to_renewal",
        "risk_category",
        "clpv_segment",
        "customer_lifetime_premium_value",
        "avg_satisfaction_score",
        "total_claims",
        "payment_reliability_score",
        priority.alias("priority_score"),
    )


def customers_at_risk(at_risk: DataFrame) -> DataFrame:
    """One row per customer with policies at risk: ``policies`` and their ``premium_amount``."""
    return at_risk.groupBy("customer_id").agg(F.count("*").alias("policies"), exact_sum("premium_amount").alias("premium_amount"))


def at_risk_summary(at_risk: DataFrame) -> DataFrame:
    """Customers and policies at risk by segment. A customer has one segment and one risk category."""
    per_customer = at_risk.groupBy("clpv_segment", "risk_category", "customer_id").agg(
        F.count("*").alias("policies"),
        F.sum(F.col("premium_amount").cast("decimal(18,4)")).alias("premium"),
        F.sum(F.col("renewal_probability_score").cast(f"decimal(18,{SHARE_DIGITS})")).alias("probability"),
    )
    grouped = per_customer.groupBy("clpv_segment", "risk_category").agg(
        F.count("*").alias("customer_count"),
        F.sum("policies").alias("policy_count"),
        F.sum("premium").cast("double").alias("premium_at_risk"),
        (F.sum("probability").cast("double") / F.sum("policies")).alias("avg_renewal_prob"),
    )
    return grouped.orderBy(F.desc("premium_at_risk"))


# --- pricing -------------------------------------------------------------------------------


def pricing_by_risk(value: DataFrame) -> DataFrame:
    """Claims ratio, profit and current against risk-adjusted premium per risk category."""
    premium, claims = F.col("total_premium"), F.col("total_claim_amount")
    claims_ratio = F.when(premium > 0, ratio(claims, premium)).otherwise(F.lit(0.0))
    return (
        value.groupBy("risk_category")
        .agg(
            F.count("*").alias("customer_count"),
            exact_avg(claims_ratio, SHARE_DIGITS).alias("avg_claims_ratio"),
            exact_avg(premium - claims).alias("avg_profitability"),
            exact_avg("annualized_premium").alias("current_avg_premium"),
            exact_avg("predicted_annual_premium").alias("recommended_avg_premium"),
        )
        .orderBy(F.desc("avg_claims_ratio"))
    )


def pricing_recommendations(by_risk: DataFrame) -> DataFrame:
    change = F.col("recommended_avg_premium") - F.col("current_avg_premium")
    return by_risk.withColumns(
        {
            "pricing_adjustment_pct": percent(change, F.col("current_avg_premium"), None),
            "annual_revenue_impact": F.col("customer_count") * change,
        }
    )


def segment_pricing(value: DataFrame) -> DataFrame:
    """Premium recommendation and pricing strategy per value segment and risk category."""
    optimal = F.col("predicted_annual_premium") * _by_label("clpv_segment", PRICE_SENSITIVITY)
    grouped = value.groupBy("clpv_segment", "risk_category").agg(
        F.count("*").alias("customer_count"),
        exact_avg("annualized_premium").alias("current_avg_premium"),
        exact_avg(optimal).alias("recommended_premium"),
        exact_avg("customer_lifetime_premium_value").alias("avg_clpv"),
        exact_avg("adjusted_retention_probability", SHARE_DIGITS).alias("avg_retention_prob"),
    )
    impact = F.col("customer_count") * (F.col("recommended_premium") - F.col("current_avg_premium"))
    return grouped.withColumns(
        {"pricing_strategy": _by_label("clpv_segment", PRICING_STRATEGY), "segment_revenue_impact": impact}
    )


# --- claims --------------------------------------------------------------------------------


def claim_fraud_score(
    claims: DataFrame, value: DataFrame, policies: DataFrame, mean: float | None = 5000, deviation: float | None = 10000
) -> DataFrame:
    """Claims with fraud score and band.

    ``mean`` and ``deviation`` set the scale of the z-score; with None they are measured.
    The days count from the policy's start to the claim.
    """
    if mean is None or deviation is None:
        measured = totals(claims, mean=exact_avg("claim_amount"), deviation=F.stddev(F.col("claim_amount").cast("double")))
        z = ratio(F.col("claim_amount").cast("double") - measured["mean"], measured["deviation"])
    else:
        z = zscore("claim_amount", mean, deviation)
    customers = value.select(
        "customer_id", "risk_category", "composite_risk_score", "total_claims", "payment_reliability_score"
    )
    starts = policies.select("policy_id", F.col("start_date").alias("_start"))
    # The policy first: claims that come partitioned by it are not shuffled for it again.
    started = claims.join(starts, "policy_id", "left")
    columns = ["policy_id", "customer_id", *[c for c in claims.columns if c not in ("policy_id", "customer_id")]]
    joined = started.join(customers, "customer_id").select(*columns, *customers.columns[1:], "_start")
    amount = F.col("claim_amount")
    return (
        joined.withColumns(
            {
                "claim_to_premium_ratio": amount.cast("double") / 1000,
                "days_policy_to_claim": F.datediff("claim_date", "_start"),
                "claim_amount_zscore": z,
            }
        )
        .withColumn(
            "fraud_risk_score",
            F.when(amount > 50_000, 2).otherwise(0)
            + F.when(F.col("fraud_indicator"), 3).otherwise(0)
            + flag(F.col("claim_amount_zscore") > 2)
            + flag(F.col("days_to_settle") < 5)
            + flag(F.col("payment_reliability_score") < 0.8),
        )
        .withColumn("fraud_risk_category", at_least("fraud_risk_score", *FRAUD_BANDS))
        .drop("_start")
    )


def fraud_distribution(scored: DataFrame) -> DataFrame:
    """Claims and exposure per fraud band, with the band's share of the exposure."""
    grouped = scored.groupBy("fraud_risk_category").agg(
        F.count("*").alias("claim_count"),
        exact_sum("claim_amount").alias("total_claim_amount"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
        exact_avg("fraud_risk_score").alias("avg_fraud_score"),
    )
    return with_share(grouped, "total_claim_amount", "fraud_exposure_pct", None).orderBy(F.desc("avg_fraud_score"))


def high_risk_claims(scored: DataFrame) -> DataFrame:
    """Claims to investigate."""
    return scored.where("fraud_risk_category = 'High Risk'").select(
        "claim_id",
        "customer_id",
        "policy_id",
        F.col("claim_amount").cast("double").alias("claim_amount"),
        "claim_date",
        "fraud_risk_score",
        "fraud_indicator",
        "days_to_settle",
    )


def _claim_metrics(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("claim_id").alias("claim_count"),
        exact_sum("claim_amount").alias("total_claim_amount"),
        exact_avg("claim_amount").alias("avg_claim_amount"),
    )


def claims_by_quarter_and_risk(claims: DataFrame, value: DataFrame) -> DataFrame:
    joined = claims.join(value.select("customer_id", "risk_category"), "customer_id")
    return _claim_metrics(joined, F.quarter("claim_date").alias("claim_quarter"), "risk_category").orderBy(
        "claim_quarter", "risk_category"
    )


def claims_by_weekday(claims: DataFrame, value: DataFrame) -> DataFrame:
    """Claims of known customers per weekday, 1 = Sunday."""
    known = claims.join(value.select("customer_id"), "customer_id", "left_semi")
    return _claim_metrics(known, F.dayofweek("claim_date").alias("claim_day_of_week")).orderBy("claim_day_of_week")


def claims_by_type_and_risk(claims: DataFrame, value: DataFrame, policies: DataFrame) -> DataFrame:
    joined = claims.join(value.select("customer_id", "risk_category"), "customer_id").join(
        policies.select("policy_id", "policy_type"), "policy_id"
    )
    return _claim_metrics(joined, "policy_type", "risk_category").orderBy(F.desc("total_claim_amount"))


def clpv_insights(value: DataFrame, at_risk: DataFrame, scored_claims: DataFrame) -> DataFrame:
    """Total and average value, segment shares, at-risk share and investigation rate."""
    segments = ("Premium", "High Value", "Medium Value", "Low Value")
    one_row = value.agg(
        F.count("*").alias("customers"),
        exact_sum("customer_lifetime_premium_value").alias("total"),
        *[count_where(F.col("clpv_segment") == s).alias(s) for s in segments],
    ).withColumns(
        {
            "risky": totals(customers_at_risk(at_risk), n=F.count("*")),
            "claims": totals(
                scored_claims, n=F.count("*"), high=count_where(F.col("fraud_risk_category") == "High Risk")
            ),
        }
    )
    customers = F.col("customers")
    return metric_rows(
        one_row,
        [
            ("Total Portfolio CLPV", F.col("total"), "currency"),
            ("Average CLPV", ratio(F.col("total"), customers), "currency"),
            *[(f"{s} Share", percent(F.col(s), customers), "percentage") for s in segments],
            ("At-Risk Share", percent(F.col("risky.n"), customers), "percentage"),
            ("Investigation Rate", percent(F.col("claims.high"), F.col("claims.n")), "percentage"),
        ],
    )
