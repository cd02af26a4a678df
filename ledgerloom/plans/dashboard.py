"""Executive layer over the insurance analytics tables.

Figures of one table come from one scan of it; a table derived from it (segment prices, cross-selling, investments) is
scanned on its own. Figures of several tables meet as scalar subqueries of one row each, in a single plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import at_least, case_bucket
from ..functions.dates import years_since
from ..functions.numbers import SHARE_DIGITS, count_where, exact, exact_avg, exact_sum, percent, ratio, sum_where
from ..operators.aggregates import metric_rows, totals, with_share
from .risk import loss_concentration
from .value import RENEWAL_BANDS, customers_at_risk

TOP_SEGMENTS = ("Premium", "High Value")

# Investment shares, uplifts, savings, action items and lookup tables.
INVESTMENT_SHARE = {"Critical": 0.05, "High": 0.03, "Medium": 0.02}
CROSS_SELL_UPLIFT = {"High Priority": 0.6, "Medium Priority": 0.4}
CROSS_SELL_CONVERSION = 0.25
CROSS_SELL_PREMIUM_SHARE = 0.5
FRAUD_SAVINGS = 0.15

ACTION_ITEMS = [
    ("Customer Retention", "Contact critical retention customers within 7 days", "retention.critical", "Critical"),
    ("Cross-Selling", "Launch cross-selling campaign for high-priority customers", "cross_sell.high", "High"),
    ("Fraud Investigation", "Investigate high-risk fraud claims", "fraud.high", "High"),
    ("Pricing Optimization", "Implement risk-based pricing adjustments", "customers", "Medium"),
    ("Portfolio Rebalancing", "Review high-risk customer concentration", "value.high_risk", "Medium"),
]


# --- customer-level tables -----------------------------------------------------------------


def _renewal_outlook(renewals: DataFrame) -> DataFrame:
    """One row per customer: the lowest renewal probability among the customer's policies."""
    lowest = renewals.groupBy("customer_id").agg(F.min("renewal_probability_score").alias("renewal_probability_score"))
    category = F.when(
        F.col("renewal_probability_score").isNotNull(), at_least("renewal_probability_score", *RENEWAL_BANDS)
    )
    return lowest.withColumn("renewal_risk_category", category)


def retention_investment(value: DataFrame, renewals: DataFrame) -> DataFrame:
    """One row per customer, with or without policies: priority and recommended investment."""
    joined = value.select(
        "customer_id", "first_name", "last_name", "risk_category", "clpv_segment", "customer_lifetime_premium_value"
    ).join(_renewal_outlook(renewals), "customer_id", "left")
    top, risk = F.col("clpv_segment").isin(*TOP_SEGMENTS), F.col("renewal_risk_category")
    priority = case_bucket(
        [
            (top & risk.isin("Medium Risk", "High Risk"), "Critical"),
            ((F.col("clpv_segment") == "Medium Value") & (risk == "High Risk"), "High"),
            (top & (risk == "Low Risk"), "Medium"),
        ],
        "Low",
    )
    prioritized = joined.withColumn("retention_investment_priority", priority)
    share = case_bucket(
        [(F.col("retention_investment_priority") == p, s) for p, s in INVESTMENT_SHARE.items()], 0.01
    )
    return prioritized.withColumn("recommended_retention_investment", F.col("customer_lifetime_premium_value") * share)


def retention_investment_summary(investment: DataFrame) -> DataFrame:
    """Per priority; the return is the value protected per unit invested."""
    grouped = investment.groupBy("retention_investment_priority").agg(
        F.count("*").alias("customer_count"),
        exact_sum("customer_lifetime_premium_value").alias("total_clpv_at_risk"),
        exact_avg("renewal_probability_score", SHARE_DIGITS).alias("avg_renewal_probability"),
        exact_sum("recommended_retention_investment").alias("total_recommended_investment"),
    )
    roi = F.coalesce(ratio(F.col("total_clpv_at_risk"), F.col("total_recommended_investment")), F.lit(0.0))
    return grouped.withColumn("retention_roi", roi).orderBy(F.desc("total_clpv_at_risk"))


def critical_retention_customers(investment: DataFrame) -> DataFrame:
    return investment.where("retention_investment_priority = 'Critical'").select(
        "customer_id",
        "first_name",
        "last_name",
        "customer_lifetime_premium_value",
        "renewal_probability_score",
        "recommended_retention_investment",
    )


def cross_sell_analysis(value: DataFrame, below_types: int = 3) -> DataFrame:
    """Customers with few policy types: priority and estimated additional premium."""
    segment, risk = F.col("clpv_segment"), F.col("risk_category")
    priority = case_bucket(
        [
            (segment.isin(*TOP_SEGMENTS) & (risk == "Low"), "High Priority"),
            ((segment == "Medium Value") & risk.isin("Low", "Medium"), "Medium Priority"),
        ],
        "Low Priority",
    )
    chosen = value.where(F.col("policy_types_count") < below_types).select(
        "customer_id",
        "first_name",
        "last_name",
        "risk_category",
        "clpv_segment",
        "policy_types_count",
        "total_premium",
        "customer_lifetime_premium_value",
        priority.alias("cross_sell_priority"),
    )
    uplift = case_bucket([(F.col("cross_sell_priority") == p, u) for p, u in CROSS_SELL_UPLIFT.items()], 0.2)
    return chosen.withColumn("estimated_additional_premium", F.col("total_premium") * uplift)


def cross_sell_summary(analysis: DataFrame) -> DataFrame:
    return (
        analysis.groupBy("cross_sell_priority", "clpv_segment")
        .agg(
            F.count("*").alias("customer_count"),
            exact_sum("total_premium").alias("current_premium"),
            exact_sum("estimated_additional_premium").alias("potential_additional_premium"),
            exact_avg("customer_lifetime_premium_value").alias("avg_clpv"),
        )
        .orderBy(F.desc("potential_additional_premium"))
    )


def high_priority_cross_sell(analysis: DataFrame) -> DataFrame:
    return analysis.where("cross_sell_priority = 'High Priority'")


def high_value_customers(value: DataFrame) -> DataFrame:
    return value.where(F.col("clpv_segment").isin(*TOP_SEGMENTS)).select(
        "customer_id",
        "first_name",
        "last_name",
        "customer_lifetime_premium_value",
        "risk_category",
        "clpv_segment",
        "total_premium",
        "adjusted_retention_probability",
    )


def high_value_characteristics(high_value: DataFrame) -> DataFrame:
    return (
        high_value.groupBy("risk_category", "clpv_segment")
        .agg(
            F.count("*").alias("customer_count"),
            exact_avg("customer_lifetime_premium_value").alias("avg_clpv"),
            exact_avg("total_premium").alias("avg_current_premium"),
            exact_avg("adjusted_retention_probability", SHARE_DIGITS).alias("avg_retention_prob"),
        )
        .orderBy(F.desc("avg_clpv"))
    )


def top_customers(high_value: DataFrame, rows: int = 50) -> DataFrame:
    return high_value.orderBy(F.desc("customer_lifetime_premium_value"), "customer_id").limit(rows)


def executive_dashboard(value: DataFrame, renewals: DataFrame) -> DataFrame:
    """One row per customer for the dashboard; renewals count with their lowest probability."""
    return value.select(
        "customer_id",
        "first_name",
        "last_name",
        "state",
        "risk_category",
        "value_segment",
        "clpv_segment",
        "total_premium",
        "customer_lifetime_premium_value",
        "total_claims",
        "total_claim_amount",
        "composite_risk_score",
        "adjusted_retention_probability",
        "policy_types_count",
        "total_policies",
        "payment_reliability_score",
    ).join(_renewal_outlook(renewals), "customer_id", "left")


# --- portfolio tables ----------------------------------------------------------------------


def tenure_distribution(profiles: DataFrame, as_of: date) -> DataFrame:
    """Customers per completed year of tenure."""
    years = F.floor(years_since("acquisition_date", as_of)).cast("int")
    return profiles.groupBy(years.alias("tenure_years")).agg(F.count("*").alias("customer_count")).orderBy("tenure_years")


def acquisition_channels(policies: DataFrame) -> DataFrame:
    return (
        policies.groupBy("acquisition_channel")
        .agg(
            F.countDistinct("customer_id").alias("customers_acquired"),
            exact_sum("premium_amount").alias("total_premium"),
        )
        .orderBy(F.desc("customers_acquired"), "acquisition_channel")
    )


def policy_profitability(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """Premium less claims per policy type. Claims are summed per policy before the join."""
    per_policy = claims.groupBy("policy_id").agg(F.sum(exact("claim_amount")).alias("claimed"))
    claimed = F.coalesce("claimed", F.lit(0))
    profit = exact("premium_amount") - claimed
    joined = policies.select("policy_id", "policy_type", "premium_amount").join(per_policy, "policy_id", "left")
    grouped = joined.groupBy("policy_type").agg(
        F.count("*").alias("policy_count"),
        exact_sum("premium_amount").alias("total_premium"),
        F.sum(claimed).cast("double").alias("total_claims"),
        ratio(F.sum(profit), F.count(profit)).alias("avg_profit_per_policy"),
        F.sum(profit).cast("double").alias("total_profit"),
    )
    loss = percent(F.col("total_claims"), F.col("total_premium"), None)
    return grouped.withColumn("loss_ratio_by_type", loss).orderBy(F.desc("total_profit"))


def portfolio_risk(profiles: DataFrame) -> DataFrame:
    """Loss ratio per risk category and value segment."""
    return loss_concentration(profiles, "risk_category", "value_segment", name="segment_loss_ratio")


def high_risk_share(profiles: DataFrame) -> DataFrame:
    """Customers and premium in the high-risk category, and their shares."""
    high = F.col("risk_category") == "High"
    one_row = profiles.agg(
        count_where(high).alias("high_risk_count"),
        sum_where(high, "total_premium").alias("high_risk_premium"),
        F.count("*").alias("customers"),
        exact_sum("total_premium").alias("premium"),
    )
    return one_row.select(
        "high_risk_count",
        "high_risk_premium",
        percent(F.col("high_risk_count"), F.col("customers"), None).alias("high_risk_percentage"),
        percent(F.col("high_risk_premium"), F.col("premium"), None).alias("high_risk_premium_percentage"),
    )


def fraud_exposure(scored_claims: DataFrame) -> DataFrame:
    """Claims and exposure per fraud band, its share, and the savings prevention would bring."""
    grouped = scored_claims.groupBy("fraud_risk_category").agg(
        F.count("*").alias("claim_count"),
        exact_sum("claim_amount").alias("total_exposure"),
        exact_avg("fraud_risk_score").alias("avg_fraud_score"),
    )
    savings = F.when(F.col("fraud_risk_category") == "High Risk", F.col("total_exposure") * FRAUD_SAVINGS).otherwise(0.0)
    shared = with_share(grouped, "total_exposure", "exposure_percentage", None)
    return shared.withColumn("prevention_savings", savings).orderBy(F.desc("avg_fraud_score"))


def fraud_monthly_patterns(scored_claims: DataFrame) -> DataFrame:
    return (
        scored_claims.groupBy(F.month("claim_date").alias("claim_month"), "fraud_risk_category")
        .agg(F.count("*").alias("claim_count"), exact_sum("claim_amount").alias("total_exposure"))
        .orderBy("claim_month", "fraud_risk_category")
    )


def dashboard_matrix(matrix: DataFrame) -> DataFrame:
    """Risk-value matrix with unrounded shares."""
    return with_share(matrix.drop("segment_percentage"), "customer_count", "segment_percentage", None)


# --- key figures ---------------------------------------------------------------------------


def portfolio_figures(
    customers: DataFrame,
    policies: DataFrame,
    claims: DataFrame,
    value: DataFrame,
    renewals_at_risk: DataFrame,
    pricing: DataFrame,
    cross_sell: DataFrame,
    scored_claims: DataFrame,
    investment: DataFrame,
    active: Sequence[str] = ("Active",),
) -> DataFrame:
    """One row with a struct of figures per source table.

    Reports pick what they show; Spark drops the subqueries of tables a report does not use.
    """
    top = F.col("clpv_segment").isin(*TOP_SEGMENTS)
    high_fraud = F.col("fraud_risk_category") == "High Risk"
    change = F.col("customer_count") * (F.col("recommended_premium") - F.col("current_avg_premium"))
    return customers.agg(F.count("*").alias("customers")).withColumns(
        {
            "policies": totals(
                policies,
                n=F.count("*"),
                premium=exact_sum("premium_amount"),
                avg_premium=exact_avg("premium_amount"),
                coverage=exact_sum("coverage_amount"),
                active=count_where(F.col("policy_status").isin(list(active))),
            ),
            "claims": totals(
                claims, n=F.count("*"), amount=exact_sum("claim_amount"), avg_amount=exact_avg("claim_amount")
            ),
            "value": totals(
                value,
                clpv=exact_sum("customer_lifetime_premium_value"),
                avg_clpv=exact_avg("customer_lifetime_premium_value"),
                avg_premium=exact_avg("total_premium"),
                top=count_where(top),
                top_clpv=sum_where(top, "customer_lifetime_premium_value"),
                high_risk=count_where(F.col("risk_category") == "High"),
                single_type_premium=sum_where(F.col("policy_types_count") == 1, "total_premium"),
                avg_tenure=exact_avg(F.floor("customer_tenure_years")),
            ),
            "at_risk": totals(
                customers_at_risk(renewals_at_risk), n=F.count("*"), policies=F.sum("policies"), premium=exact_sum("premium_amount")
            ),
            "pricing": totals(pricing, impact=exact_sum(change)),
            "cross_sell": totals(
                cross_sell,
                potential=exact_sum("estimated_additional_premium"),
                high=count_where(F.col("cross_sell_priority") == "High Priority"),
            ),
            "fraud": totals(
                scored_claims, high=count_where(high_fraud), exposure=sum_where(high_fraud, "claim_amount")
            ),
            "retention": totals(
                investment,
                critical=count_where(F.col("retention_investment_priority") == "Critical"),
                invested=exact_sum("recommended_retention_investment"),
                protected=exact_sum("customer_lifetime_premium_value"),
            ),
        }
    )


def _loss_ratio() -> Column:
    return percent(F.col("claims.amount"), F.col("policies.premium"), None)


def _claims_rate() -> Column:
    return percent(F.col("claims.n"), F.col("policies.n"), None)


def _retention_rate() -> Column:
    return percent(F.col("policies.active"), F.col("policies.n"), None)


def _or_zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def _fraud_savings() -> Column:
    return F.col("fraud.exposure") * FRAUD_SAVINGS


def executive_kpis(figures: DataFrame) -> DataFrame:
    return metric_rows(
        figures,
        [
            ("Total Customers", F.col("customers"), "count"),
            ("Total Policies", F.col("policies.n"), "count"),
            ("Total Claims", F.col("claims.n"), "count"),
            ("Total Premiums", F.col("policies.premium"), "currency"),
            ("Total Coverage", F.col("policies.coverage"), "currency"),
            ("Total Claim Amount", F.col("claims.amount"), "currency"),
            ("Average Premium per Customer", F.col("value.avg_premium"), "currency"),
            ("Average Premium per Policy", F.col("policies.avg_premium"), "currency"),
            ("Average Claim Amount", F.col("claims.avg_amount"), "currency"),
            ("Loss Ratio", _loss_ratio(), "percentage"),
            ("Claims Rate", _claims_rate(), "percentage"),
            ("Total Portfolio CLPV", F.col("value.clpv"), "currency"),
            ("Average CLPV per Customer", F.col("value.avg_clpv"), "currency"),
        ],
    )


def retention_kpis(figures: DataFrame) -> DataFrame:
    return metric_rows(
        figures,
        [
            ("Average Customer Tenure", F.col("value.avg_tenure"), "years"),
            ("Policy Retention Rate", _retention_rate(), "percentage"),
            ("At-Risk Customers", F.col("at_risk.n"), "count"),
            ("At-Risk Policies", _or_zero("at_risk.policies"), "count"),
            ("At-Risk Percentage", percent(F.col("at_risk.n"), F.col("customers"), None), "percentage"),
            ("Premium at Risk", _or_zero("at_risk.premium"), "currency"),
        ],
    )


def growth_metrics(figures: DataFrame) -> DataFrame:
    cross_sell = F.col("value.single_type_premium") * CROSS_SELL_CONVERSION * CROSS_SELL_PREMIUM_SHARE
    return metric_rows(
        figures,
        [
            ("Pricing Optimization Revenue Impact", _or_zero("pricing.impact"), "currency"),
            ("Cross-Selling Revenue Potential", cross_sell, "currency"),
            ("Total Growth Opportunity", _or_zero("pricing.impact") + cross_sell, "currency"),
        ],
    )


def high_value_share(figures: DataFrame) -> DataFrame:
    return metric_rows(
        figures,
        [
            ("High-Value Customers", F.col("value.top"), "count"),
            ("High-Value CLPV", F.col("value.top_clpv"), "currency"),
            ("High-Value Customer Share", percent(F.col("value.top"), F.col("customers"), None), "percentage"),
            ("High-Value CLPV Share", percent(F.col("value.top_clpv"), F.col("value.clpv"), None), "percentage"),
        ],
    )


def kpi_summary(figures: DataFrame) -> DataFrame:
    rows = metric_rows(
        figures,
        [
            ("total_customers", F.col("customers"), ""),
            ("total_policies", F.col("policies.n"), ""),
            ("total_premiums", F.col("policies.premium"), ""),
            ("total_claims", F.col("claims.n"), ""),
            ("total_claim_amount", F.col("claims.amount"), ""),
            ("loss_ratio", _loss_ratio(), ""),
            ("claims_rate", _claims_rate(), ""),
            ("avg_clpv", F.col("value.avg_clpv"), ""),
            ("total_portfolio_clpv", F.col("value.clpv"), ""),
            ("retention_rate", _retention_rate(), ""),
            ("at_risk_customers", F.col("at_risk.n"), ""),
            ("premium_at_risk", _or_zero("at_risk.premium"), ""),
            ("pricing_revenue_impact", _or_zero("pricing.impact"), ""),
            ("cross_sell_potential", _or_zero("cross_sell.potential"), ""),
            ("fraud_prevention_savings", _fraud_savings(), ""),
        ],
    )
    return rows.select(F.col("metric_name").alias("kpi_name"), F.col("metric_value").alias("kpi_value"))


def action_items(figures: DataFrame) -> DataFrame:
    """What to do, with the number of customers or claims concerned."""
    rows = [
        F.struct(
            F.lit(category).alias("action_category"),
            F.lit(text).alias("action_description"),
            F.col(count).cast("double").alias("customer_count"),
            F.lit(priority).alias("priority"),
        )
        for category, text, count, priority in ACTION_ITEMS
    ]
    return figures.select(F.inline(F.array(*rows)))


def revenue_recommendations(figures: DataFrame) -> DataFrame:
    """Investment, expected return and multiple per initiative."""
    impact, potential = _or_zero("pricing.impact"), _or_zero("cross_sell.potential")
    roi = F.coalesce(ratio(F.col("retention.protected"), F.col("retention.invested")), F.lit(0.0))
    items = [
        ("Retention Investment", F.col("retention.invested"), F.col("retention.protected"), roi),
        ("Pricing Optimization", impact, impact * 5, F.lit(5.0)),
        ("Cross-Selling", potential * 0.25, potential, F.lit(4.0)),
        ("Fraud Prevention", _fraud_savings() * 0.1, _fraud_savings(), F.lit(10.0)),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("recommendation"),
            invested.alias("investment_required"),
            expected.alias("expected_return"),
            multiple.alias("roi_multiple"),
        )
        for name, invested, expected, multiple in items
    ]
    return figures.select(F.inline(F.array(*rows)))


def business_impact(figures: DataFrame) -> DataFrame:
    """Pricing, cross-selling and fraud savings together, and their share of the premium."""
    impact = _or_zero("pricing.impact") + _or_zero("cross_sell.potential") + _fraud_savings()
    return figures.select(
        impact.alias("total_business_impact"), percent(impact, F.col("policies.premium"), None).alias("impact_percentage")
    )
