"""Card fraud: rule scores, composite risk, and the reports on them.

Frames: ``transactions`` (transaction_id, customer_id, amount, transaction_date,
merchant_category, transaction_type, location, is_fraud) and ``customers`` (customer_id,
customer_name, age, credit_score, annual_income, state, account_type,
previous_fraud_incidents), one row per customer.

Two scorers exist side by side. ``score_rules`` never looks at the fraud label and can be judged
against it; ``score_flat`` adds points for the label and is for monitoring only.

The only join of single transactions is the one with their customer. It is left to Spark:
broadcast when the customers are small, else a sort-merge join whose hot customers are split.
Everything after it is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conditions import at_least, below, case_bucket, flag
from ..functions.numbers import cap, count_where, exact, exact_avg, exact_sum, percent, ratio, round_to, sum_where
from ..operators.aggregates import metric_rows, with_share

# Bands and their labels.
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST_BAND = "65+"
SCORE_BUCKETS = [
    (0, "0 - No Risk"),
    (25, "1-25 - Low Risk"),
    (50, "26-50 - Medium-Low Risk"),
    (70, "51-70 - Medium Risk"),
    (85, "71-85 - High Risk"),
]
HIGHEST_BUCKET = "86-100 - Critical Risk"


@dataclass(frozen=True)
class RuleSettings:
    """Thresholds, lists, scores and weights of the four rules."""

    high_amount: float = 1000
    max_transactions: int = 3
    merchants: Sequence[str] = ("GAMBLING", "CRYPTOCURRENCY", "ADULT_ENTERTAINMENT", "ONLINE")
    locations: Sequence[str] = ("INTERNATIONAL", "UNKNOWN", "ONLINE")
    scores: tuple[int, int, int, int] = (75, 60, 50, 40)
    weights: tuple[float, float, float, float] = (0.4, 0.25, 0.2, 0.15)
    high: int = 70
    medium: int = 40


@dataclass(frozen=True)
class FlatSettings:
    """Thresholds and points of the additive monitoring score."""

    high_amount: float = 1000
    low_credit: int = 600
    points: tuple[int, int, int, int] = (30, 40, 20, 100)
    high: int = 80
    medium: int = 40


# --- label-free scorer ---------------------------------------------------------------------


def rule_high_amount(s: RuleSettings) -> Column:
    return F.when(F.col("amount") > s.high_amount, s.scores[0]).otherwise(0)


def rule_velocity(s: RuleSettings) -> Column:
    return F.when(F.col("transaction_count") > s.max_transactions, s.scores[1]).otherwise(0)


def rule_merchant(s: RuleSettings) -> Column:
    return F.when(F.col("merchant_category").isin(list(s.merchants)), s.scores[2]).otherwise(0)


def rule_location(s: RuleSettings) -> Column:
    return F.when(F.col("location").isin(list(s.locations)), s.scores[3]).otherwise(0)


def risk_band(score: Column, high: int, medium: int, labels: Sequence[str] = ("HIGH", "MEDIUM", "LOW")) -> Column:
    return at_least(score, [(high, labels[0]), (medium, labels[1])], labels[2])


def customer_risk_factor() -> Column:
    """First match only: weak credit, young age, earlier fraud."""
    return case_bucket(
        [(F.col("credit_score") < 600, 20), (F.col("age") < 25, 15), (F.col("previous_fraud_incidents") > 0, 30)], 0
    )


def score_rules(transactions: DataFrame, customers: DataFrame, settings: RuleSettings = RuleSettings()) -> DataFrame:
    """Transactions with the four rule scores, the composite and the final risk.

    Transaction counts are joined to the customer profiles first, so the transactions go
    through one join only.
    """
    counts = transactions.where("customer_id is not null").groupBy("customer_id").agg(
        F.count("*").alias("transaction_count")
    )
    context = counts.join(customers, "customer_id", "left")
    joined = transactions.join(context, "customer_id", "left")
    scored = joined.withColumns(
        {
            "high_amount_risk": rule_high_amount(settings),
            "velocity_risk": rule_velocity(settings),
            "merchant_risk": rule_merchant(settings),
            "location_risk": rule_location(settings),
        }
    )
    parts = ("high_amount_risk", "velocity_risk", "merchant_risk", "location_risk")
    # Decimal weights: 0.4 * 75 + 0.2 * 50 must be 40 exactly before it is cut to an integer.
    weighted = sum((F.col(c) * F.lit(str(w)).cast("decimal(4,3)") for c, w in zip(parts, settings.weights)), F.lit(0))
    scored = scored.withColumn("risk_score", cap(weighted.cast("int"), 100)).withColumns(
        {
            "risk_category": risk_band(F.col("risk_score"), settings.high, settings.medium),
            "is_high_risk": flag(F.col("risk_score") > settings.high),
            "triggered_rules": F.array_compact(
                F.array(*[F.when(F.col(c) > 0, F.lit(c.removesuffix("_risk"))) for c in parts])
            ),
            "customer_risk_factor": customer_risk_factor(),
        }
    )
    scored = scored.withColumn("final_risk_score", cap(F.col("risk_score") + F.col("customer_risk_factor"), 100))
    return scored.withColumns(
        {
            "final_risk_category": risk_band(F.col("final_risk_score"), settings.high, settings.medium),
            "is_final_high_risk": flag(F.col("final_risk_score") > settings.high),
        }
    )


def risk_distribution(scored: DataFrame, category: str = "risk_category", score: str = "risk_score") -> DataFrame:
    return (
        scored.groupBy(category)
        .agg(F.count("*").alias("transaction_count"), round_to(exact_avg(score)).alias(f"avg_{score}"))
        .orderBy(F.desc("transaction_count"), category)
    )


def final_risk_distribution(scored: DataFrame) -> DataFrame:
    return risk_distribution(scored, "final_risk_category", "final_risk_score")


def high_risk_by(scored: DataFrame, *keys: str) -> DataFrame:
    """Final high-risk transactions per customer, merchant category or location."""
    return (
        scored.where("is_final_high_risk = 1")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("high_risk_count"),
            exact_sum("amount").alias("total_amount"),
            round_to(exact_avg("final_risk_score")).alias("avg_risk_score"),
            F.max("final_risk_score").alias("max_risk_score"),
        )
    )


def age_group_risk(scored: DataFrame) -> DataFrame:
    """High-risk share per age band; customers without an age are shown as Unknown."""
    band = F.when(F.col("age").isNull(), "Unknown").otherwise(below("age", AGE_BANDS, OLDEST_BAND))
    grouped = scored.groupBy(band.alias("age_group")).agg(
        F.count("*").alias("total_transactions"),
        F.sum("is_final_high_risk").alias("high_risk_transactions"),
        round_to(exact_avg("final_risk_score")).alias("avg_risk_score"),
    )
    share = percent(F.col("high_risk_transactions"), F.col("total_transactions"))
    return grouped.withColumn("risk_percentage", share).orderBy("age_group")


def top_risk_transactions(scored: DataFrame, rows: int = 10) -> DataFrame:
    return (
        scored.select(
            "transaction_id",
            "customer_name",
            F.col("amount").cast("double").alias("amount"),
            "merchant_category",
            "final_risk_score",
            "final_risk_category",
            "is_final_high_risk",
        )
        .orderBy(F.desc("final_risk_score"), "transaction_id")
        .limit(rows)
    )


def scoring_summary(scored: DataFrame) -> DataFrame:
    """One-row summary of the label-free scorer."""
    high = F.col("is_final_high_risk") == 1
    one_row = scored.agg(
        F.count("*").alias("total_transactions"),
        count_where(high).alias("high_risk_transactions"),
        exact_sum("amount").alias("total_amount"),
        sum_where(high, "amount").alias("high_risk_amount"),
        count_where(F.col("is_fraud") == 1).alias("actual_fraud_count"),
    )
    share = percent(F.col("high_risk_transactions"), F.col("total_transactions"), None)
    return one_row.withColumn("high_risk_percentage", share)


def score_sanity(scored: DataFrame) -> DataFrame:
    """One row: missing scores, score range and transactions without a known customer."""
    return scored.agg(
        count_where(F.col("final_risk_score").isNull()).alias("null_scores"),
        F.min("final_risk_score").alias("min_score"),
        F.max("final_risk_score").alias("max_score"),
        exact_avg("final_risk_score").alias("avg_score"),
        count_where(F.col("customer_name").isNull()).alias("unmatched_customers"),
    )


def category_score_range(scored: DataFrame, category: str, score: str) -> DataFrame:
    return scored.groupBy(category).agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.count("*").alias("transaction_count")
    )


# --- additive monitoring scorer ------------------------------------------------------------


def score_flat(transactions: DataFrame, customers: DataFrame, settings: FlatSettings = FlatSettings()) -> DataFrame:
    """Transactions with profile, flags and the additive score, capped at 100."""
    joined = transactions.alias("t").join(
        customers.alias("c"), F.col("t.customer_id") == F.col("c.customer_id"), "left"
    ).select("t.*", *[F.col(f"c.{c}") for c in customers.columns if c != "customer_id"])
    large = F.col("amount") > settings.high_amount
    repeat = F.col("previous_fraud_incidents") > 0
    fraud = F.col("is_fraud") == 1
    conditions = (large, repeat, F.col("credit_score") < settings.low_credit, fraud)
    points = sum((F.when(c, p).otherwise(0) for c, p in zip(conditions, settings.points)), F.lit(0))
    return joined.withColumns(
        {
            "amount_risk_flag": F.when(large, "High Amount").otherwise("Normal Amount"),
            "customer_risk_flag": F.when(repeat, "Previous Fraud").otherwise("Clean History"),
            "risk_score": cap(points, 100),
            "fraud_status": F.when(fraud, "Fraud").otherwise("Legitimate"),
        }
    ).withColumn(
        "risk_category",
        risk_band(F.col("risk_score"), settings.high, settings.medium, ("High Risk", "Medium Risk", "Low Risk")),
    )


_HIGH = "High Risk"


def _is_high() -> Column:
    return F.col("risk_category") == _HIGH


def _group_metrics() -> list[Column]:
    return [
        F.count("transaction_id").alias("total_transactions"),
        exact_sum("amount").alias("total_amount"),
        exact_avg("amount").alias("avg_transaction_amount"),
        F.sum("is_fraud").alias("fraud_count"),
        exact_avg("risk_score").alias("avg_risk_score"),
        count_where(_is_high()).alias("high_risk_count"),
        sum_where(_is_high(), "amount").alias("high_risk_amount"),
    ]


def _fraud_rate() -> Column:
    return percent(F.col("fraud_count"), F.col("total_transactions"))


def _level(c: str, high: float, medium: float) -> Column:
    return at_least(c, [(high, "High Risk"), (medium, "Medium Risk")], "Low Risk")


def customer_risk_summary(flat: DataFrame, high: float = 60, medium: float = 30) -> DataFrame:
    """Risky customers: raised average score, any fraud now or earlier. One row per customer."""
    profile = (
        "customer_id",
        "customer_name",
        "age",
        "credit_score",
        "annual_income",
        "state",
        "account_type",
        "previous_fraud_incidents",
    )
    summary = flat.groupBy(*profile).agg(*_group_metrics(), F.max("risk_score").alias("max_risk_score"))
    summary = summary.withColumns(
        {"fraud_rate": _fraud_rate(), "customer_risk_level": _level("avg_risk_score", high, medium)}
    )
    return summary.where(
        (F.col("avg_risk_score") >= medium) | (F.col("fraud_count") > 0) | (F.col("previous_fraud_incidents") > 0)
    )


def merchant_risk_summary(flat: DataFrame, high: float = 10, medium: float = 5) -> DataFrame:
    """Merchant categories with any fraud."""
    summary = flat.groupBy("merchant_category").agg(*_group_metrics()).withColumn("fraud_rate", _fraud_rate())
    return (
        summary.withColumn("merchant_risk_level", _level("fraud_rate", high, medium))
        .where("fraud_rate > 0")
        .orderBy(F.desc("fraud_rate"), "merchant_category")
    )


def geo_risk_summary(flat: DataFrame, high: float = 8, medium: float = 4) -> DataFrame:
    """Risk per state and location."""
    keys = ["state", "location"]
    grouped = flat.groupBy(*keys).agg(*_group_metrics(), F.countDistinct("customer_id").alias("unique_customers"))
    return (
        grouped.withColumn("fraud_rate", _fraud_rate())
        .withColumn("geographic_risk_level", _level("fraud_rate", high, medium))
        .orderBy(F.desc("fraud_rate"), *keys)
    )


def fraud_summary(flat: DataFrame) -> DataFrame:
    """One-row portfolio summary of the monitoring score.

    Transactions are summed per customer and merchant category first: several distinct counts
    in one aggregate copy their input once per count.
    """
    amount, high, fraud = exact("amount"), _is_high(), F.col("is_fraud") == 1
    partial = flat.groupBy("customer_id", "state", "merchant_category").agg(
        F.count("transaction_id").alias("transactions"),
        F.sum(amount).alias("amount"),
        F.count("amount").alias("amounts"),
        F.sum("is_fraud").alias("fraud"),
        count_where(high).alias("high"),
        F.sum(F.when(high, amount)).alias("high_amount"),
        F.sum(F.when(fraud, amount)).alias("fraud_amount"),
        count_where(fraud & F.col("amount").isNotNull()).alias("fraud_amounts"),
    )
    one_row = partial.agg(
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("total_transactions"),
        F.sum("amount").cast("double").alias("total_amount"),
        ratio(F.sum("amount"), F.sum("amounts")).alias("avg_transaction_amount"),
        F.sum("fraud").alias("actual_fraud_count"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("merchant_category").alias("unique_merchants"),
        F.countDistinct("state").alias("unique_states"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high_risk_transactions"),
        F.coalesce(F.sum("high_amount").cast("double"), F.lit(0.0)).alias("high_risk_amount"),
        F.coalesce(ratio(F.sum("fraud_amount"), F.sum("fraud_amounts")), F.lit(0.0)).alias("avg_fraud_amount"),
    )
    total = F.col("total_transactions")
    return one_row.withColumns(
        {
            "fraud_rate": percent(F.col("actual_fraud_count"), total),
            "high_risk_percentage": percent(F.col("high_risk_transactions"), total),
        }
    )


def kpi_averages(flat: DataFrame) -> DataFrame:
    """Average transaction and average high-risk amount, 0 when there is none."""
    high = F.when(_is_high(), F.col("amount"))
    return flat.agg(
        exact_avg("amount").alias("average_transaction_size"),
        F.coalesce(exact_avg(high), F.lit(0.0)).alias("average_risk_amount"),
    )


def executive_kpis(flat: DataFrame) -> DataFrame:
    """Portfolio figures as metric rows."""
    high_amount = F.col("high_risk_amount")
    return metric_rows(
        flat.agg(
            F.count("transaction_id").alias("transactions"),
            count_where(_is_high()).alias("high_risk"),
            exact_sum("amount").alias("amount"),
            sum_where(_is_high(), "amount").alias("high_risk_amount"),
        ),
        [
            ("Total Transactions", F.col("transactions"), "count"),
            ("High Risk Transactions", F.col("high_risk"), "count"),
            ("Total Amount", F.col("amount"), "currency"),
            ("High Risk Amount", high_amount, "currency"),
            ("Detection Rate", percent(F.col("high_risk"), F.col("transactions")), "percentage"),
            ("Average Transaction", ratio(F.col("amount"), F.col("transactions")), "currency"),
            ("Fraud Prevention", high_amount, "currency"),
        ],
    )


def executive_export(flat: DataFrame, high: int = 80) -> DataFrame:
    """Summary figures for a BI tool; high risk means a score of ``high`` and more."""
    risky = F.col("risk_score") >= high
    rows = metric_rows(
        flat.agg(
            F.count("*").alias("transactions"),
            count_where(risky).alias("risky"),
            exact_sum("amount").alias("amount"),
            sum_where(risky, "amount").alias("risky_amount"),
            exact_avg("amount").alias("average"),
            exact_avg(F.when(risky, F.col("amount"))).alias("risky_average"),
            F.sum("is_fraud").alias("fraud"),
        ),
        [
            ("Total_Transactions", F.col("transactions"), "count"),
            ("High_Risk_Transactions", F.col("risky"), "count"),
            ("High_Risk_Percentage", percent(F.col("risky"), F.col("transactions"), None), "percentage"),
            ("Total_Amount", F.col("amount"), "currency"),
            ("High_Risk_Amount", F.col("risky_amount"), "currency"),
            ("Average_Transaction", F.col("average"), "currency"),
            ("Average_Risk_Amount", F.col("risky_average"), "currency"),
            ("Actual_Fraud_Count", F.col("fraud"), "count"),
        ],
    )
    return rows.select("metric_name", "metric_value")


def top_risk_customers(summary: DataFrame, rows: int = 10) -> DataFrame:
    return (
        summary.select(
            "customer_id", "customer_name", "age", "credit_score", "high_risk_amount", "high_risk_count", "max_risk_score"
        )
        .orderBy(F.desc("high_risk_amount"), "customer_id")
        .limit(rows)
    )


def customer_risk_stats(summary: DataFrame) -> DataFrame:
    """Averages over the risky customers, one row."""
    return summary.agg(
        F.count("*").alias("total_high_risk_customers"),
        round_to(exact_avg("high_risk_amount")).alias("avg_risk_amount_per_customer"),
        round_to(exact_avg("high_risk_count")).alias("avg_transactions_per_customer"),
        F.max("max_risk_score").alias("highest_risk_score"),
        round_to(exact_avg("age"), 1).alias("avg_age_high_risk_customers"),
    )


def _trend(flat: DataFrame, *keys: Column) -> DataFrame:
    grouped = flat.groupBy(*keys).agg(
        F.count("*").alias("total_transactions"),
        count_where(_is_high()).alias("high_risk_transactions"),
        exact_sum("amount").alias("total_amount"),
        sum_where(_is_high(), "amount").alias("high_risk_amount"),
        round_to(exact_avg("risk_score")).alias("avg_risk_score"),
    )
    return grouped.withColumn(
        "risk_percentage", percent(F.col("high_risk_transactions"), F.col("total_transactions"))
    )


def daily_trend(flat: DataFrame) -> DataFrame:
    return _trend(flat, F.to_date("transaction_date").alias("transaction_day")).orderBy("transaction_day")


def hourly_trend(flat: DataFrame) -> DataFrame:
    return _trend(flat, F.hour("transaction_date").alias("transaction_hour")).orderBy("transaction_hour")


def weekday_trend(flat: DataFrame) -> DataFrame:
    """Per day of week, 1 = Sunday."""
    day = F.col("transaction_date")
    return _trend(flat, F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name")).orderBy(
        "day_of_week"
    )


def risk_score_buckets(flat: DataFrame) -> DataFrame:
    """Transactions per score range, with their share."""
    score = F.col("risk_score")
    bucket = case_bucket([(score <= bound, label) for bound, label in SCORE_BUCKETS], HIGHEST_BUCKET)
    grouped = flat.groupBy(bucket.alias("risk_bucket")).agg(
        F.count("*").alias("transaction_count"),
        exact_sum("amount").alias("total_amount"),
        round_to(exact_avg("risk_score"), 1).alias("avg_risk_score"),
    )
    return with_share(grouped, "transaction_count", "percentage_of_transactions").orderBy("avg_risk_score")


def risk_category_summary(flat: DataFrame) -> DataFrame:
    """Per risk category, the riskiest first."""
    grouped = flat.groupBy("risk_category").agg(
        F.count("*").alias("transaction_count"),
        exact_sum("amount").alias("total_amount"),
        round_to(exact_avg("risk_score")).alias("avg_risk_score"),
        round_to(exact_avg("amount")).alias("avg_transaction_amount"),
    )
    rank = case_bucket([(_is_high(), 1), (F.col("risk_category") == "Medium Risk", 2)], 3)
    return with_share(grouped, "transaction_count", "percentage_of_total").orderBy(rank)


def risk_score_stats(flat: DataFrame) -> DataFrame:
    """Distribution of the score, one row.

    The score is an integer from 0 to 100, so it is counted per value first: the statistics,
    exact percentiles included, then come from at most 101 rows.
    """
    per_score = flat.where("risk_score is not null").groupBy("risk_score").agg(F.count("*").alias("n"))
    ranked = per_score.withColumn(
        "share",
        F.sum("n").over(Window.orderBy("risk_score")) / F.sum("n").over(Window.partitionBy()),
    )
    n, score = F.col("n"), F.col("risk_score")
    count, total, squares = F.sum(n), F.sum(score * n), F.sum(score * score * n)
    # Integers up to the last step: the deviation does not depend on the order of the rows.
    variance = ratio(
        count.cast("decimal(38,0)") * squares - total.cast("decimal(38,0)") * total,
        count.cast("decimal(38,0)") * (count - 1),
    )

    def percentile(p: float) -> Column:
        return F.min(F.when(F.col("share") >= p, score))

    return ranked.agg(
        round_to(ratio(total, count)).alias("overall_avg_risk_score"),
        round_to(F.sqrt(variance)).alias("risk_score_std_dev"),
        F.min(score).alias("min_risk_score"),
        F.max(score).alias("max_risk_score"),
        percentile(0.5).alias("median_risk_score"),
        percentile(0.9).alias("p90_risk_score"),
        percentile(0.95).alias("p95_risk_score"),
    )


def main_export(flat: DataFrame, high: int = 80) -> DataFrame:
    """Transaction-level extract for a BI tool."""
    return flat.select(
        "transaction_id",
        "customer_id",
        "customer_name",
        "amount",
        "transaction_date",
        "merchant_category",
        "transaction_type",
        "location",
        "risk_score",
        "risk_category",
        flag(F.col("risk_score") >= high).alias("is_high_risk"),
        "is_fraud",
        "age",
        "credit_score",
        "account_type",
        F.to_date("transaction_date").alias("transaction_day"),
    )


def high_risk_export(flat: DataFrame, high: int = 80) -> DataFrame:
    """Customers with transactions scored ``high`` and more."""
    return (
        flat.where(F.col("risk_score") >= high)
        .groupBy("customer_id", "customer_name", "age", "credit_score", "account_type")
        .agg(
            F.count("*").alias("high_risk_transaction_count"),
            exact_sum("amount").alias("total_high_risk_amount"),
            round_to(exact_avg("risk_score")).alias("avg_risk_score"),
            F.max("risk_score").alias("max_risk_score"),
        )
    )


def data_profile(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Volume, duplicates, fraud rate, categories and customers as metric rows.

    Each distinct count reads its own column only.
    """

    def distinct(df: DataFrame, column: str) -> Column:
        return df.agg(F.countDistinct(column).alias("n")).scalar()

    one_row = transactions.agg(F.count("*").alias("rows"), F.sum("is_fraud").alias("fraud")).withColumns(
        {
            "ids": distinct(transactions, "transaction_id"),
            "merchants": distinct(transactions, "merchant_category"),
            "types": distinct(transactions, "transaction_type"),
            "people": customers.agg(F.count("*").alias("n")).scalar(),
            "people_ids": distinct(customers, "customer_id"),
        }
    )
    return metric_rows(
        one_row,
        [
            ("Transactions", F.col("rows"), "count"),
            ("Duplicate Transaction IDs", F.col("rows") - F.col("ids"), "count"),
            ("Fraud Rate", percent(F.col("fraud"), F.col("rows"), None), "percentage"),
            ("Merchant Categories", F.col("merchants"), "count"),
            ("Transaction Types", F.col("types"), "count"),
            ("Customers", F.col("people"), "count"),
            ("Duplicate Customer IDs", F.col("people") - F.col("people_ids"), "count"),
        ],
    )


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def customers_without_profile(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    referenced = transactions.select("customer_id").distinct()
    return referenced.join(customers.select("customer_id"), "customer_id", "left_anti")
