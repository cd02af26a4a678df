"""Fraud queries: events are card transactions, customers hold the cards."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..operators.aggregates import precision_recall
from ..plans import fraud
from ..session import stage_table, tune
from . import Query, Stages, davg, dsum, metric_rows, r2, table

RULES = fraud.RuleSettings(high_amount=150, max_transactions=65, merchants=("ERROR", "SIGNUP"))
FLAT = fraud.FlatSettings(high_amount=150)
STAGES = Stages()


class Roles:
    """The fraud frames over one folder of tables; a JSON field gives location and label."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.read = lambda name: table(spark, folder, name)
        self.stage = lambda name, build: STAGES.get(spark, folder, name, lambda: stage_table(build(), name))

    @property
    def transactions(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.read("events").select(
            F.col("event_id").alias("transaction_id"),
            F.col("user_id").alias("customer_id"),
            F.col("value").cast("decimal(12,2)").alias("amount"),
            F.col("ts").alias("transaction_date"),
            F.upper("event_type").alias("merchant_category"),
            F.when(F.col("event_type") == "purchase", "debit").otherwise("credit").alias("transaction_type"),
            case_bucket([(k < 20, "ONLINE"), (k < 40, "INTERNATIONAL"), (k < 45, "UNKNOWN")], "DOMESTIC").alias("location"),
            F.when(k >= 95, 1).otherwise(0).alias("is_fraud"),
        )

    @property
    def customers(self) -> DataFrame:
        """Profiles; customers deep in debt have none, so some transactions stay unmatched."""
        joined = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        birth = F.date_add(F.lit(date(1950, 1, 1)), ((F.col("c_custkey") * 7919) % 20000).cast("int"))
        return joined.where("c_acctbal >= -800").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.when(F.col("c_acctbal") > 9500, F.lit(None)).otherwise(F.year(F.lit(date(2024, 2, 1))) - F.year(birth)).alias("age"),
            F.floor(500 + F.floor((F.col("c_acctbal") + 1000) / 11000 * 350)).cast("int").alias("credit_score"),
            (F.col("c_acctbal") * 10 + 20000).cast("decimal(12,2)").cast("double").alias("annual_income"),
            F.col("n_name").alias("state"),
            F.col("c_mktsegment").alias("account_type"),
            F.when(F.col("c_acctbal") < 0, 2).otherwise(0).alias("previous_fraud_incidents"),
        )

    @property
    def scored(self) -> DataFrame:
        return self.stage("rule-scores", lambda: fraud.score_rules(self.transactions, self.customers, RULES))

    @property
    def flat(self) -> DataFrame:
        return self.stage("flat-scores", lambda: fraud.score_flat(self.transactions, self.customers, FLAT))


ROLES_SQL = """
WITH transactions AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, CAST(value AS DECIMAL(12,2)) AS amount, ts AS transaction_date,
    upper(event_type) AS merchant_category, CASE event_type WHEN 'purchase' THEN 'debit' ELSE 'credit' END AS transaction_type,
    CASE WHEN k < 20 THEN 'ONLINE' WHEN k < 40 THEN 'INTERNATIONAL' WHEN k < 45 THEN 'UNKNOWN' ELSE 'DOMESTIC' END AS location,
    CASE WHEN k >= 95 THEN 1 ELSE 0 END AS is_fraud
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INT) AS k FROM events)),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_acctbal > 9500 THEN NULL ELSE CAST(2024 - year(DATE '1950-01-01' + CAST((c_custkey * 7919) % 20000 AS INT)) AS INT) END AS age,
    CAST(500 + floor((c_acctbal + 1000) / 11000 * 350) AS INT) AS credit_score,
    CAST(CAST(c_acctbal * 10 + 20000 AS DECIMAL(12,2)) AS DOUBLE) AS annual_income, n_name AS state, c_mktsegment AS account_type,
    CASE WHEN c_acctbal < 0 THEN 2 ELSE 0 END AS previous_fraud_incidents
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= -800),
rule_scores AS (
  SELECT t.*, c.* EXCLUDE (customer_id), CASE WHEN amount > 150 THEN 75 ELSE 0 END AS high_amount_risk,
    CASE WHEN count(*) OVER (PARTITION BY t.customer_id) > 65 THEN 60 ELSE 0 END AS velocity_risk,
    CASE WHEN merchant_category IN ('ERROR', 'SIGNUP') THEN 50 ELSE 0 END AS merchant_risk,
    CASE WHEN location IN ('INTERNATIONAL', 'UNKNOWN', 'ONLINE') THEN 40 ELSE 0 END AS location_risk,
    CASE WHEN credit_score < 600 THEN 20 WHEN age < 25 THEN 15 WHEN previous_fraud_incidents > 0 THEN 30 ELSE 0 END AS customer_risk_factor
  FROM transactions t LEFT JOIN customers c ON t.customer_id = c.customer_id),
composite AS (
  SELECT *, least(100, (high_amount_risk * 40 + velocity_risk * 25 + merchant_risk * 20 + location_risk * 15) // 100) AS risk_score
  FROM rule_scores),
scored AS (
  SELECT * REPLACE (CAST(risk_score AS INT) AS risk_score), CAST(least(100, risk_score + customer_risk_factor) AS INT) AS final_risk_score,
    CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
    CASE WHEN risk_score > 70 THEN 1 ELSE 0 END AS is_high_risk,
    CASE WHEN least(100, risk_score + customer_risk_factor) >= 70 THEN 'HIGH'
      WHEN least(100, risk_score + customer_risk_factor) >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS final_risk_category,
    CASE WHEN least(100, risk_score + customer_risk_factor) > 70 THEN 1 ELSE 0 END AS is_final_high_risk FROM composite),
flat_score AS (
  SELECT t.*, c.* EXCLUDE (customer_id), CAST(least(100, CASE WHEN amount > 150 THEN 30 ELSE 0 END
    + CASE WHEN previous_fraud_incidents > 0 THEN 40 ELSE 0 END + CASE WHEN credit_score < 600 THEN 20 ELSE 0 END
    + CASE WHEN is_fraud = 1 THEN 100 ELSE 0 END) AS INT) AS risk_score
  FROM transactions t LEFT JOIN customers c ON t.customer_id = c.customer_id),
flat AS (
  SELECT *, CASE WHEN risk_score >= 80 THEN 'High Risk' WHEN risk_score >= 40 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category
  FROM flat_score)
"""

_METRICS = f"""count(transaction_id) AS total_transactions, {dsum("amount")} AS total_amount, {davg("amount")} AS avg_transaction_amount,
  CAST(sum(is_fraud) AS BIGINT) AS fraud_count, {davg("risk_score")} AS avg_risk_score,
  count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_count,
  coalesce({dsum("CASE WHEN risk_category = 'High Risk' THEN amount END")}, 0) AS high_risk_amount"""
_RATE = r2("CAST(fraud_count AS DOUBLE) / total_transactions * 100")
_TREND = f"""count(*) AS total_transactions, count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_transactions,
  {dsum("amount")} AS total_amount, coalesce({dsum("CASE WHEN risk_category = 'High Risk' THEN amount END")}, 0) AS high_risk_amount,
  {r2(davg("risk_score"))} AS avg_risk_score"""
_SHARE = r2("CAST(high_risk_transactions AS DOUBLE) / total_transactions * 100")


def _trend(keys: str) -> str:
    return f"SELECT *, {_SHARE} AS risk_percentage FROM (SELECT {keys}, {_TREND} FROM flat GROUP BY ALL)"


def _cast_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


def _query(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, folder: build(Roles(tune(spark), folder))


def _rule(name: str):
    return lambda r: r.scored.select("transaction_id", name)


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "rule_high_amount": _rule("high_amount_risk"),
        "rule_velocity": _rule("velocity_risk"),
        "rule_merchant": _rule("merchant_risk"),
        "rule_location": _rule("location_risk"),
        "composite_risk": lambda r: r.scored.select("transaction_id", "risk_score", "risk_category", "is_high_risk"),
        "final_risk": lambda r: r.scored.select(
            "transaction_id", "customer_risk_factor", "final_risk_score", "final_risk_category", "is_final_high_risk"
        ),
        "customer_risk_factor": lambda r: r.customers.select("customer_id", fraud.customer_risk_factor().alias("factor")),
        "triggered_rules": lambda r: r.scored.groupBy(F.array_join("triggered_rules", ",").alias("rules")).agg(
            F.count("*").alias("transactions")
        ),
        "risk_distribution": lambda r: fraud.risk_distribution(r.scored),
        "final_risk_distribution": lambda r: fraud.final_risk_distribution(r.scored),
        "high_risk_by_customer": lambda r: fraud.high_risk_by(r.scored, "customer_id", "customer_name"),
        "high_risk_by_merchant": lambda r: fraud.high_risk_by(r.scored, "merchant_category"),
        "high_risk_by_location": lambda r: fraud.high_risk_by(r.scored, "location"),
        "flag_precision_recall": lambda r: precision_recall(
            r.scored, F.col("is_final_high_risk") == 1, F.col("is_fraud") == 1
        ),
        "age_group_risk": lambda r: fraud.age_group_risk(r.scored),
        "top_risk_transactions": lambda r: fraud.top_risk_transactions(r.scored),
        "scoring_summary": lambda r: fraud.scoring_summary(r.scored),
        "score_sanity": lambda r: fraud.score_sanity(r.scored),
        "category_score_range": lambda r: fraud.category_score_range(r.scored, "final_risk_category", "final_risk_score"),
        "flat_risk_score": lambda r: r.flat.select(
            "transaction_id", "risk_score", "risk_category", "amount_risk_flag", "customer_risk_flag", "fraud_status"
        ),
        "customer_risk_summary": lambda r: fraud.customer_risk_summary(r.flat),
        "merchant_risk_summary": lambda r: fraud.merchant_risk_summary(r.flat),
        "geo_risk_summary": lambda r: fraud.geo_risk_summary(r.flat),
        "fraud_summary": lambda r: fraud.fraud_summary(r.flat),
        "kpi_averages": lambda r: fraud.kpi_averages(r.flat),
        "executive_kpis_fraud": lambda r: fraud.executive_kpis(r.flat),
        "executive_summary_export": lambda r: fraud.executive_export(r.flat),
        "top_risk_customers": lambda r: fraud.top_risk_customers(fraud.customer_risk_summary(r.flat)),
        "customer_risk_stats": lambda r: fraud.customer_risk_stats(fraud.customer_risk_summary(r.flat)),
        "daily_trend": lambda r: fraud.daily_trend(r.flat),
        "hourly_trend": lambda r: fraud.hourly_trend(r.flat),
        "weekday_trend": lambda r: fraud.weekday_trend(r.flat),
        "risk_score_buckets": lambda r: fraud.risk_score_buckets(r.flat),
        "risk_category_summary": lambda r: fraud.risk_category_summary(r.flat),
        "risk_score_stats": lambda r: fraud.risk_score_stats(r.flat),
        "main_export": lambda r: _cast_amount(fraud.main_export(r.flat)).withColumn(
            "transaction_date", F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss")
        ),
        "high_risk_export": lambda r: fraud.high_risk_export(r.flat),
        "data_profile": lambda r: fraud.data_profile(r.transactions, r.customers),
        "date_range": lambda r: fraud.date_range(r.transactions.select(F.to_date("transaction_date").alias("day")), "day"),
        "customers_without_profile": lambda r: fraud.customers_without_profile(r.transactions, r.customers),
    }.items()
}

_HIGH_BY = f"""count(*) AS high_risk_count, {dsum("amount")} AS total_amount, {r2(davg("final_risk_score"))} AS avg_risk_score,
  max(final_risk_score) AS max_risk_score FROM scored WHERE is_final_high_risk = 1 GROUP BY ALL"""
_CUSTOMER_SUMMARY = f"""SELECT *, {_RATE} AS fraud_rate, CASE WHEN avg_risk_score >= 60 THEN 'High Risk' WHEN avg_risk_score >= 30
  THEN 'Medium Risk' ELSE 'Low Risk' END AS customer_risk_level FROM (SELECT customer_id, customer_name, age, credit_score, annual_income,
  state, account_type, previous_fraud_incidents, {_METRICS}, max(risk_score) AS max_risk_score FROM flat GROUP BY ALL)
  WHERE avg_risk_score >= 30 OR fraud_count > 0 OR previous_fraud_incidents > 0"""


_SQL = {
    "rule_high_amount": "SELECT transaction_id, high_amount_risk FROM scored",
    "rule_velocity": "SELECT transaction_id, velocity_risk FROM scored",
    "rule_merchant": "SELECT transaction_id, merchant_risk FROM scored",
    "rule_location": "SELECT transaction_id, location_risk FROM scored",
    "composite_risk": "SELECT transaction_id, risk_score, risk_category, is_high_risk FROM scored",
    "final_risk": """SELECT transaction_id, customer_risk_factor, final_risk_score, final_risk_category, is_final_high_risk FROM scored""",
    "customer_risk_factor": """SELECT customer_id, CASE WHEN credit_score < 600 THEN 20 WHEN age < 25 THEN 15 WHEN previous_fraud_incidents > 0
        THEN 30 ELSE 0 END AS factor FROM customers""",
    "triggered_rules": """SELECT concat_ws(',', CASE WHEN high_amount_risk > 0 THEN 'high_amount' END, CASE WHEN velocity_risk > 0 THEN 'velocity' END,
        CASE WHEN merchant_risk > 0 THEN 'merchant' END, CASE WHEN location_risk > 0 THEN 'location' END) AS rules, count(*) AS transactions
        FROM scored GROUP BY 1""",
    "risk_distribution": f"""SELECT risk_category, count(*) AS transaction_count, {r2(davg("risk_score"))} AS avg_risk_score
        FROM scored GROUP BY ALL""",
    "final_risk_distribution": f"""SELECT final_risk_category, count(*) AS transaction_count, {r2(davg("final_risk_score"))}
        AS avg_final_risk_score FROM scored GROUP BY ALL""",
    "high_risk_by_customer": f"SELECT customer_id, customer_name, {_HIGH_BY}",
    "high_risk_by_merchant": f"SELECT merchant_category, {_HIGH_BY}",
    "high_risk_by_location": f"SELECT location, {_HIGH_BY}",
    "flag_precision_recall": """SELECT *, CASE WHEN flagged_count > 0 THEN true_positives / flagged_count ELSE 0 END AS precision,
        CASE WHEN actual_count > 0 THEN true_positives / actual_count ELSE 0 END AS recall FROM (
        SELECT count(*) FILTER (WHERE is_final_high_risk = 1 AND is_fraud = 1) AS true_positives,
        count(*) FILTER (WHERE is_final_high_risk = 1 AND is_fraud = 0) AS false_positives,
        count(*) FILTER (WHERE is_final_high_risk = 1) AS flagged_count, count(*) FILTER (WHERE is_fraud = 1) AS actual_count FROM scored)""",
    "age_group_risk": f"""SELECT *, {_SHARE} AS risk_percentage FROM (SELECT CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN '18-24'
        WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_group,
        count(*) AS total_transactions, CAST(sum(is_final_high_risk) AS BIGINT) AS high_risk_transactions,
        {r2(davg("final_risk_score"))} AS avg_risk_score FROM scored GROUP BY 1)""",
    "top_risk_transactions": """SELECT transaction_id, customer_name, CAST(amount AS DOUBLE) AS amount, merchant_category, final_risk_score,
        final_risk_category, is_final_high_risk FROM scored ORDER BY final_risk_score DESC, transaction_id LIMIT 10""",
    "scoring_summary": f"""SELECT *, CAST(high_risk_transactions AS DOUBLE) / total_transactions * 100 AS high_risk_percentage FROM (
        SELECT count(*) AS total_transactions, count(*) FILTER (WHERE is_final_high_risk = 1) AS high_risk_transactions,
        {dsum("amount")} AS total_amount, coalesce({dsum("CASE WHEN is_final_high_risk = 1 THEN amount END")}, 0) AS high_risk_amount,
        count(*) FILTER (WHERE is_fraud = 1) AS actual_fraud_count FROM scored)""",
    "score_sanity": f"""SELECT count(*) FILTER (WHERE final_risk_score IS NULL) AS null_scores, min(final_risk_score) AS min_score,
        max(final_risk_score) AS max_score, {davg("final_risk_score")} AS avg_score,
        count(*) FILTER (WHERE customer_name IS NULL) AS unmatched_customers FROM scored""",
    "category_score_range": """SELECT final_risk_category, min(final_risk_score) AS min_score, max(final_risk_score) AS max_score,
        count(*) AS transaction_count FROM scored GROUP BY ALL""",
    "flat_risk_score": """SELECT transaction_id, risk_score, risk_category, CASE WHEN amount > 150 THEN 'High Amount' ELSE 'Normal Amount' END
        AS amount_risk_flag, CASE WHEN previous_fraud_incidents > 0 THEN 'Previous Fraud' ELSE 'Clean History' END AS customer_risk_flag,
        CASE WHEN is_fraud = 1 THEN 'Fraud' ELSE 'Legitimate' END AS fraud_status FROM flat""",
    "customer_risk_summary": _CUSTOMER_SUMMARY,
    "merchant_risk_summary": f"""SELECT *, CASE WHEN fraud_rate >= 10 THEN 'High Risk' WHEN fraud_rate >= 5 THEN 'Medium Risk' ELSE 'Low Risk' END
        AS merchant_risk_level FROM (SELECT *, {_RATE} AS fraud_rate FROM (SELECT merchant_category, {_METRICS} FROM flat GROUP BY ALL))
        WHERE fraud_rate > 0""",
    "geo_risk_summary": f"""SELECT *, CASE WHEN fraud_rate >= 8 THEN 'High Risk' WHEN fraud_rate >= 4 THEN 'Medium Risk' ELSE 'Low Risk' END
        AS geographic_risk_level FROM (SELECT *, {_RATE} AS fraud_rate FROM (SELECT state, location, {_METRICS},
        count(DISTINCT customer_id) AS unique_customers FROM flat GROUP BY ALL))""",
    "fraud_summary": f"""SELECT *, {r2("CAST(actual_fraud_count AS DOUBLE) / total_transactions * 100")} AS fraud_rate,
        {r2("CAST(high_risk_transactions AS DOUBLE) / total_transactions * 100")} AS high_risk_percentage FROM (
        SELECT count(transaction_id) AS total_transactions, {dsum("amount")} AS total_amount, {davg("amount")} AS avg_transaction_amount,
        CAST(sum(is_fraud) AS BIGINT) AS actual_fraud_count, count(DISTINCT customer_id) AS unique_customers,
        count(DISTINCT merchant_category) AS unique_merchants, count(DISTINCT state) AS unique_states,
        count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_transactions,
        coalesce({dsum("CASE WHEN risk_category = 'High Risk' THEN amount END")}, 0) AS high_risk_amount,
        coalesce({davg("CASE WHEN is_fraud = 1 THEN amount END")}, 0) AS avg_fraud_amount FROM flat)""",
    "kpi_averages": f"""SELECT {davg("amount")} AS average_transaction_size,
        coalesce({davg("CASE WHEN risk_category = 'High Risk' THEN amount END")}, 0) AS average_risk_amount FROM flat""",
    "executive_kpis_fraud": metric_rows(
        f"""SELECT count(*) AS n, count(*) FILTER (WHERE risk_category = 'High Risk') AS h, {dsum("amount")} AS a,
        coalesce({dsum("CASE WHEN risk_category = 'High Risk' THEN amount END")}, 0) AS ha FROM flat""",
        [
            ("Total Transactions", "n", "count"),
            ("High Risk Transactions", "h", "count"),
            ("Total Amount", "a", "currency"),
            ("High Risk Amount", "ha", "currency"),
            ("Detection Rate", r2("CAST(h AS DOUBLE) / n * 100"), "percentage"),
            ("Average Transaction", "a / n", "currency"),
            ("Fraud Prevention", "ha", "currency"),
        ],
    ),
    "executive_summary_export": metric_rows(
        f"""SELECT count(*) AS n, count(*) FILTER (WHERE risk_score >= 80) AS h, {dsum("amount")} AS a,
        coalesce({dsum("CASE WHEN risk_score >= 80 THEN amount END")}, 0) AS ha, {davg("amount")} AS av,
        {davg("CASE WHEN risk_score >= 80 THEN amount END")} AS hav, sum(is_fraud) AS f FROM flat""",
        [
            ("Total_Transactions", "n", ""),
            ("High_Risk_Transactions", "h", ""),
            ("High_Risk_Percentage", "CAST(h AS DOUBLE) / n * 100", ""),
            ("Total_Amount", "a", ""),
            ("High_Risk_Amount", "ha", ""),
            ("Average_Transaction", "av", ""),
            ("Average_Risk_Amount", "hav", ""),
            ("Actual_Fraud_Count", "f", ""),
        ],
        kind=False,
    ),
    "top_risk_customers": f"""SELECT customer_id, customer_name, age, credit_score, high_risk_amount, high_risk_count, max_risk_score
        FROM ({_CUSTOMER_SUMMARY}) ORDER BY high_risk_amount DESC, customer_id LIMIT 10""",
    "customer_risk_stats": f"""SELECT count(*) AS total_high_risk_customers, {r2(davg("high_risk_amount"))} AS avg_risk_amount_per_customer,
        {r2(davg("high_risk_count"))} AS avg_transactions_per_customer, max(max_risk_score) AS highest_risk_score,
        {r2(davg("age"), 1)} AS avg_age_high_risk_customers FROM ({_CUSTOMER_SUMMARY})""",
    "daily_trend": _trend("CAST(transaction_date AS DATE) AS transaction_day"),
    "hourly_trend": _trend("CAST(hour(transaction_date) AS INT) AS transaction_hour"),
    "weekday_trend": _trend("CAST(dayofweek(transaction_date) + 1 AS INT) AS day_of_week, dayname(transaction_date) AS day_name"),
    "risk_score_buckets": f"""SELECT *, {r2("transaction_count * 100.0 / sum(transaction_count) OVER ()")} AS percentage_of_transactions FROM (
        SELECT CASE WHEN risk_score = 0 THEN '0 - No Risk' WHEN risk_score <= 25 THEN '1-25 - Low Risk' WHEN risk_score <= 50
        THEN '26-50 - Medium-Low Risk' WHEN risk_score <= 70 THEN '51-70 - Medium Risk' WHEN risk_score <= 85 THEN '71-85 - High Risk'
        ELSE '86-100 - Critical Risk' END AS risk_bucket, count(*) AS transaction_count, {dsum("amount")} AS total_amount,
        {r2(davg("risk_score"), 1)} AS avg_risk_score FROM flat GROUP BY 1)""",
    "risk_category_summary": f"""SELECT *, {r2("transaction_count * 100.0 / sum(transaction_count) OVER ()")} AS percentage_of_total FROM (
        SELECT risk_category, count(*) AS transaction_count, {dsum("amount")} AS total_amount, {r2(davg("risk_score"))} AS avg_risk_score,
        {r2(davg("amount"))} AS avg_transaction_amount FROM flat GROUP BY ALL)""",
    "risk_score_stats": f"""SELECT {r2("avg(risk_score)")} AS overall_avg_risk_score, {r2("stddev_samp(risk_score)")} AS risk_score_std_dev,
        min(risk_score) AS min_risk_score, max(risk_score) AS max_risk_score, min(risk_score) FILTER (WHERE cd >= 0.5) AS median_risk_score,
        min(risk_score) FILTER (WHERE cd >= 0.9) AS p90_risk_score, min(risk_score) FILTER (WHERE cd >= 0.95) AS p95_risk_score
        FROM (SELECT risk_score, cume_dist() OVER (ORDER BY risk_score) AS cd FROM flat)""",
    "main_export": """SELECT transaction_id, customer_id, customer_name, CAST(amount AS DOUBLE) AS amount, merchant_category, transaction_type,
        location, risk_score, risk_category, CASE WHEN risk_score >= 80 THEN 1 ELSE 0 END AS is_high_risk, is_fraud, age, credit_score,
        account_type, strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, CAST(transaction_date AS DATE) AS transaction_day FROM flat""",
    "high_risk_export": f"""SELECT customer_id, customer_name, age, credit_score, account_type, count(*) AS high_risk_transaction_count,
        {dsum("amount")} AS total_high_risk_amount, {r2(davg("risk_score"))} AS avg_risk_score, max(risk_score) AS max_risk_score
        FROM flat WHERE risk_score >= 80 GROUP BY ALL""",
    "data_profile": metric_rows(
        """SELECT count(*) AS n, count(DISTINCT transaction_id) AS ids, sum(is_fraud) AS f, count(DISTINCT merchant_category) AS m,
        count(DISTINCT transaction_type) AS ty, (SELECT count(*) FROM customers) AS c,
        (SELECT count(DISTINCT customer_id) FROM customers) AS ci FROM transactions""",
        [
            ("Transactions", "n", "count"),
            ("Duplicate Transaction IDs", "n - ids", "count"),
            ("Fraud Rate", "CAST(f AS DOUBLE) / n * 100", "percentage"),
            ("Merchant Categories", "m", "count"),
            ("Transaction Types", "ty", "count"),
            ("Customers", "c", "count"),
            ("Duplicate Customer IDs", "c - ci", "count"),
        ],
    ),
    "date_range": "SELECT min(CAST(transaction_date AS DATE)) AS earliest, max(CAST(transaction_date AS DATE)) AS latest FROM transactions",
    "customers_without_profile": """SELECT DISTINCT customer_id FROM transactions WHERE customer_id NOT IN (SELECT customer_id FROM customers)""",
}

ORACLES = {name: ROLES_SQL + sql for name, sql in _SQL.items()}
