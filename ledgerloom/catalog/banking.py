"""Banking queries: events are transactions, customers are account holders."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket, code_pattern, in_list, map_synonyms, not_blank
from ..functions.text import metro_city, proper_case, squeeze_spaces
from ..operators import distinct, membership
from ..operators.aggregates import column_profile
from ..operators.daystates import DayPartitions
from ..operators.dimensions import covering_date_dimension, without_period
from ..operators.keys import first_per_key
from ..plans import banking
from ..session import stage_folder, stage_table, tune
from ..sources.writers import replace_period, table_row_counts
from . import Query, table

AS_OF = date(2024, 2, 1)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


class Roles:
    """The banking frames over one folder of tables.

    The holder dimension before the load knows customers with a balance of 0 and more; above
    5000 their stored tier is out of date, above 8000 they also have an expired version.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.read = lambda name: table(spark, folder, name)

    @property
    def holder_text(self) -> DataFrame:
        """Untidy holder attributes, one row per customer."""
        joined = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        city = case_bucket(
            [
                (F.col("n_nationkey") == 0, "New York"),
                (F.col("n_nationkey") == 1, "Los Angeles"),
                (F.col("n_nationkey") == 2, "Chicago"),
            ],
            F.col("n_name"),
        )
        tier = case_bucket(
            [
                (F.col("c_mktsegment") == "AUTOMOBILE", "PREM"),
                (F.col("c_mktsegment") == "BUILDING", "pref"),
                (F.col("c_mktsegment") == "FURNITURE", "Std"),
                (F.col("c_mktsegment") == "HOUSEHOLD", "basic"),
            ],
            "unknown",
        )
        return joined.select(
            "c_custkey",
            "c_acctbal",
            F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" o'"), F.upper("c_name"), F.lit(" ")).alias(
                "account_holder_name"
            ),
            F.concat(F.col("c_custkey"), F.lit("   Main  St, "), city, F.lit("  R"), F.col("n_regionkey")).alias("address"),
            tier.alias("relationship_tier"),
        )

    @property
    def staging(self) -> DataFrame:
        events = self.read("events")
        text = self.holder_text.drop("c_acctbal")
        amount = F.col("value").cast("decimal(12,2)")
        user = F.lpad(F.col("user_id").cast("string"), 6, "0")
        return events.join(text, F.col("user_id") == F.col("c_custkey")).select(
            F.col("user_id").cast("string").alias("account_holder_id"),
            "account_holder_name",
            "address",
            "relationship_tier",
            F.concat(F.lit("BP-"), F.upper("event_type")).alias("banking_product_id"),
            F.col("event_type").alias("product_name"),
            F.when(F.col("event_type") == "purchase", "debit").otherwise("credit").alias("product_category"),
            F.col("event_id").alias("transaction_id"),
            F.concat(F.when(F.col("event_type") == "error", "ERR").otherwise("CHK"), user).alias("account_number"),
            F.when(F.col("event_type") == "purchase", -amount).otherwise(amount).alias("transaction_amount"),
            F.col("event_type").alias("transaction_type"),
            F.col("ts").cast("date").alias("transaction_date"),
        )

    @property
    def holders(self) -> DataFrame:
        clean = banking.apply_business_rules(
            self.holder_text.select(
                "c_custkey",
                "c_acctbal",
                F.col("c_custkey").cast("string").alias("account_holder_id"),
                proper_case("account_holder_name").alias("account_holder_name"),
                squeeze_spaces("address").alias("address"),
                map_synonyms("relationship_tier", banking.TIERS, "Standard").alias("relationship_tier"),
            )
        ).where("c_acctbal >= 0")
        stale = F.col("c_acctbal") > 5000
        current = clean.select(
            (F.col("c_custkey") * 2 + 1).alias("account_holder_key"),
            "account_holder_id",
            "account_holder_name",
            "address",
            F.when(stale, "Gold").otherwise(F.col("relationship_tier")).alias("relationship_tier"),
            F.lit(date(2023, 1, 1)).alias("effective_date"),
            F.lit(None).cast("date").alias("expiration_date"),
            F.lit(True).alias("is_current"),
        )
        expired = clean.where("c_acctbal > 8000").select(
            (F.col("c_custkey") * 2 + 2).alias("account_holder_key"),
            "account_holder_id",
            "account_holder_name",
            "address",
            F.lit("Basic").alias("relationship_tier"),
            F.lit(date(2020, 1, 1)).alias("effective_date"),
            F.lit(date(2023, 1, 1)).alias("expiration_date"),
            F.lit(False).alias("is_current"),
        )
        return current.unionByName(expired)

    @property
    def products(self) -> DataFrame:
        """Product dimension before the load: only what was purchased, viewed or clicked on."""
        known = self.read("events").where(F.col("event_type").isin("purchase", "view", "click"))
        return known.select("event_type").distinct().select(
            case_bucket([(F.col("event_type") == "purchase", 1), (F.col("event_type") == "view", 2)], 3)
            .cast("bigint")
            .alias("banking_product_key"),
            F.concat(F.lit("BP-"), F.upper("event_type")).alias("banking_product_id"),
            F.col("event_type").alias("product_name"),
            F.when(F.col("event_type") == "purchase", "debit").otherwise("credit").alias("product_category"),
            F.lit(True).alias("is_active"),
        )

    @property
    def dates(self) -> DataFrame:
        return covering_date_dimension(self.read("events").select(F.col("ts").cast("date").alias("day")), "day")

    @property
    def facts(self) -> DataFrame:
        """Facts of known and unknown holders, for checks and analytics."""
        s = self.read("events")
        amount = F.col("value").cast("decimal(12,2)")
        user = F.lpad(F.col("user_id").cast("string"), 6, "0")
        return s.select(
            (F.col("user_id") * 2 + 1).alias("account_holder_key"),
            case_bucket(
                [
                    (F.col("event_type") == "purchase", 1),
                    (F.col("event_type") == "view", 2),
                    (F.col("event_type") == "click", 3),
                ],
                4,
            )
            .cast("bigint")
            .alias("banking_product_key"),
            (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).alias("date_key"),
            F.col("event_id").alias("transaction_id"),
            F.concat(F.when(F.col("event_type") == "error", "ERR").otherwise("CHK"), user).alias("account_number"),
            F.when(F.col("event_type") == "purchase", -amount).otherwise(amount).alias("transaction_amount"),
        )


_PROPER = """array_to_string(list_transform(regexp_extract_all({0}, '\\p{{L}}+|\\P{{L}}+'),
    lambda x: upper(x[1]) || lower(x[2:])), '')"""

ROLES_SQL = f"""
WITH holder_text AS (
  SELECT c_custkey, c_acctbal, '  ' || lower(c_mktsegment) || ' o''' || upper(c_name) || ' ' AS raw_name,
    c_custkey || '   Main  St, ' || CASE n_nationkey WHEN 0 THEN 'New York' WHEN 1 THEN 'Los Angeles'
      WHEN 2 THEN 'Chicago' ELSE n_name END || '  R' || n_regionkey AS raw_address,
    CASE n_nationkey WHEN 0 THEN 'New York' WHEN 1 THEN 'Los Angeles' WHEN 2 THEN 'Chicago' ELSE n_name END AS city,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Premium' WHEN 'BUILDING' THEN 'Preferred' WHEN 'FURNITURE' THEN 'Standard'
      WHEN 'HOUSEHOLD' THEN 'Basic' ELSE 'Standard' END AS tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
clean AS (
  SELECT c_custkey, c_acctbal, CAST(c_custkey AS VARCHAR) AS account_holder_id,
    {_PROPER.format("trim(raw_name)")} AS account_holder_name,
    regexp_replace(trim(raw_address), ' +', ' ', 'g') AS address,
    CASE WHEN tier = 'Premium' AND city IN ('New York', 'Los Angeles', 'Chicago') THEN 'Premium Metro'
      WHEN tier = 'Premium' THEN 'Premium Standard' ELSE tier END AS relationship_tier,
    CASE WHEN tier IN ('Premium', 'Preferred') THEN 'Low Risk' WHEN tier = 'Standard' THEN 'Medium Risk'
      ELSE 'High Risk' END AS risk_profile
  FROM holder_text),
staging AS (
  SELECT clean.*, 'BP-' || upper(event_type) AS banking_product_id, event_type AS product_name,
    CASE event_type WHEN 'purchase' THEN 'debit' ELSE 'credit' END AS product_category, event_id AS transaction_id,
    CASE event_type WHEN 'error' THEN 'ERR' ELSE 'CHK' END || lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_number,
    CASE event_type WHEN 'purchase' THEN -1 ELSE 1 END * CAST(value AS DECIMAL(12,2)) AS transaction_amount,
    event_type AS transaction_type, CAST(ts AS DATE) AS transaction_date
  FROM events JOIN clean ON user_id = c_custkey),
staged AS (
  SELECT DISTINCT account_holder_id, account_holder_name, address, relationship_tier, risk_profile FROM staging),
holders AS (
  SELECT c_custkey * 2 + 1 AS account_holder_key, account_holder_id, account_holder_name, address,
    CASE WHEN c_acctbal > 5000 THEN 'Gold' ELSE relationship_tier END AS relationship_tier,
    DATE '2023-01-01' AS effective_date, CAST(NULL AS DATE) AS expiration_date, true AS is_current
  FROM clean WHERE c_acctbal >= 0
  UNION ALL
  SELECT c_custkey * 2 + 2, account_holder_id, account_holder_name, address, 'Basic', DATE '2020-01-01',
    DATE '2023-01-01', false FROM clean WHERE c_acctbal > 8000),
products AS (
  SELECT DISTINCT CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS BIGINT) AS banking_product_key,
    'BP-' || upper(event_type) AS banking_product_id, event_type AS product_name,
    CASE event_type WHEN 'purchase' THEN 'debit' ELSE 'credit' END AS product_category, true AS is_active
  FROM events WHERE event_type IN ('purchase', 'view', 'click')),
dates AS (
  SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS full_date FROM events),
facts AS (
  SELECT user_id * 2 + 1 AS account_holder_key, CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2
      WHEN 'click' THEN 3 ELSE 4 END AS BIGINT) AS banking_product_key, CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key,
    CAST(ts AS DATE) AS transaction_date, event_id AS transaction_id,
    CASE event_type WHEN 'error' THEN 'ERR' ELSE 'CHK' END || lpad(CAST(user_id AS VARCHAR), 6, '0') AS account_number,
    CASE event_type WHEN 'purchase' THEN -1 ELSE 1 END * CAST(value AS DECIMAL(12,2)) AS transaction_amount
  FROM events),
detected AS (
  SELECT s.*, h.account_holder_key,
    CASE WHEN h.account_holder_key IS NULL THEN 'NEW'
      WHEN h.account_holder_name IS DISTINCT FROM s.account_holder_name OR h.address IS DISTINCT FROM s.address
        OR h.relationship_tier IS DISTINCT FROM s.relationship_tier THEN 'CHANGED' ELSE 'UNCHANGED' END AS change_type
  FROM staged s LEFT JOIN holders h ON s.account_holder_id = h.account_holder_id AND h.is_current)
"""


def _double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _by_days(r: Roles) -> DataFrame:
    """The validation report from states per day: one day comes late and one is corrected, and only those two are read again."""
    facts = r.facts
    spark = facts.sparkSession
    place = f"{stage_folder(spark)}/facts-by-day-{uuid.uuid4().hex}"
    table_of_days = DayPartitions(spark, f"{place}/facts", "date_key", facts.schema)
    limits = (-200, 200)
    late, wrong = F.col("date_key") % 100 == 15, F.col("date_key") % 100 == 10

    def load(rows: DataFrame) -> None:
        replace_period(rows.hint("rebalance", "date_key"), table_of_days.path, ["date_key"])
        banking.refresh_check_states(table_of_days, f"{place}/states", limits)

    # The wrong day has its amounts doubled at first and no account numbers.
    doubled = F.when(wrong, F.col("transaction_amount") * 2).otherwise(F.col("transaction_amount")).cast("decimal(12,2)")
    first = facts.withColumn("transaction_amount", doubled).withColumn("account_number", F.when(~wrong, F.col("account_number")))
    load(first.where(~late).select(facts.columns))
    load(facts.where(late | wrong))
    return banking.validation_from_states(f"{place}/states", r.holders, r.products, r.dates, date(2024, 1, 20), limits)


_USERS = {"users": "user_id", "values": "value"}


def _rejects_by_filter(r: Roles) -> DataFrame:
    """The rejects of a load that finds loaded ids by the filters of two earlier loads."""
    clicks = r.staging.where("transaction_type = 'click'")
    ids = r.read("events").where("event_type = 'click'").select(F.col("event_id").alias("transaction_id"))
    buckets = membership.buckets_for(ids.count())
    even = F.col("transaction_id") % 2 == 0
    first = membership.key_filter(ids.where(even), "transaction_id", buckets)
    kept = first.united(membership.key_filter(ids.where(~even), "transaction_id", buckets))
    place = f"{stage_folder(ids.sparkSession)}/loaded-ids-{uuid.uuid4().hex}"
    kept.save(place)
    staging = r.staging.unionByName(r.staging.where("transaction_type = 'signup'"))
    return banking.transaction_load(
        staging,
        r.holders,
        r.products.where("banking_product_key < 3"),
        r.dates.where("day_number < 25"),
        clicks,
        (-200, 200),
        membership.read_filter(ids.sparkSession, place, buckets),
    ).rejects


def _rolled_up(r: Roles) -> DataFrame:
    """Distinct users and values per event type, rolled up from stored states per day and type, audited against exact counts."""
    events = r.read("events").withColumn("day", F.to_date("ts"))
    daily = stage_table(distinct.distinct_states(events, ["day", "event_type"], _USERS), "distinct-states")
    rolled = distinct.roll_up(daily, ["event_type"], list(_USERS))
    report = distinct.error_report(events, rolled, "event_type", _USERS)
    return report.select("event_type", "measure", "exact_count", "within_error")


def _event_profile(r: Roles) -> DataFrame:
    """Rows and missing values per column of the events; distinct values from sketches, held against their exact count."""
    events = r.read("events")
    exact = column_profile(events).select("column_name", F.col("unique_values").alias("exact_unique"))
    off = F.abs(F.col("unique_values") - F.col("exact_unique"))
    sketched = distinct.sketched_profile(events).join(exact, "column_name")
    within = (off <= F.col("exact_unique") * distinct.stated_error()) | (off <= 1)
    return sketched.select("column_name", "row_count", "missing_values", "exact_unique", within.alias("within_error"))


def _query(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, folder: build(Roles(tune(spark), folder))


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "map_synonyms": lambda r: r.holder_text.groupBy(
            map_synonyms("relationship_tier", banking.TIERS, "Standard").alias("tier")
        ).agg(F.count("*").alias("holders")),
        "in_list": lambda r: r.staging.where(in_list("product_name", ["purchase", "signup"])).select("transaction_id"),
        "between_inclusive": lambda r: r.staging.where(F.col("transaction_amount").between(-50, 50)).select("transaction_id"),
        "not_null_not_blank": lambda r: r.staging.where(not_blank("account_holder_name")).agg(
            F.count("*").alias("usable_rows")
        ),
        "like_pattern": lambda r: r.staging.where(
            ~code_pattern("account_number", banking.ACCOUNT_PREFIXES, 6)
        ).select("transaction_id", "account_number"),
        "proper_case": lambda r: r.holder_text.select("c_custkey", proper_case("account_holder_name").alias("holder_name")),
        "squeeze_spaces": lambda r: r.holder_text.select("c_custkey", squeeze_spaces("address").alias("address")),
        "metro_city": lambda r: r.holder_text.select("c_custkey", metro_city(squeeze_spaces("address")).alias("city")),
        "bank_business_rules": lambda r: banking.stage_holders(r.staging),
        "scd2_detect": lambda r: banking.detect_holder_changes(r.holders, r.staging).select(
            "account_holder_id", "account_holder_key", "relationship_tier", "change_type", "scd_action"
        ),
        "scd2_apply": lambda r: banking.load_holders(r.holders, r.staging, AS_OF),
        "insert_only_dimension": lambda r: banking.new_products(r.products, r.staging),
        "first_per_key": lambda r: first_per_key(
            r.staging.select("account_holder_id", "transaction_date", "transaction_id"),
            ["account_holder_id"],
            ["transaction_date", "transaction_id"],
        ),
        "build_date_dimension": lambda r: r.dates,
        "load_fact_transactions": lambda r: _double(
            banking.load_transactions(
                r.staging, r.holders, r.products, r.dates, r.staging.where("transaction_type = 'click'")
            ),
            "transaction_amount",
        ),
        "fact_transaction_rejects": lambda r: banking.transaction_load(
            r.staging.unionByName(r.staging.where("transaction_type = 'signup'")),
            r.holders,
            r.products.where("banking_product_key < 3"),
            r.dates.where("day_number < 25"),
            r.staging.where("transaction_type = 'click'"),
            (-200, 200),
        ).rejects,
        "fact_rejects_by_filter": _rejects_by_filter,
        "fact_transaction_counters": lambda r: banking.transaction_load(
            r.staging.unionByName(r.staging), r.holders, r.products, r.dates, r.staging.where("transaction_type = 'click'")
        ).counters,
        "reset_period": lambda r: without_period(r.dates, F.col("full_date") >= F.lit(date(2024, 1, 15))).select("date_key"),
        "validation_suite": lambda r: banking.validation_suite(
            r.facts, r.holders, r.products, r.dates, date(2024, 1, 20), (-200, 200)
        ),
        "validation_by_days": _by_days,
        "distinct_rollup": _rolled_up,
        "sketched_profile": _event_profile,
        "moving_average_3": lambda r: _double(
            banking.moving_average_3(r.facts, r.holders, r.dates), "transaction_amount"
        ),
        "running_balance": lambda r: _double(
            banking.running_balance(r.facts, r.holders, r.dates), "transaction_amount", "account_running_balance"
        ),
        "transaction_dense_rank": lambda r: _double(
            banking.transaction_dense_rank(r.facts, r.holders, r.products, r.dates), "transaction_amount"
        ),
        "final_row_counts": lambda r: table_row_counts(
            {
                "stg_transactions_raw": r.staging,
                "fact_transactions": r.facts,
                "dim_account_holder": r.holders,
                "dim_banking_product": r.products,
                "dim_date": r.dates,
            }
        ),
    }.items()
}


def _rule(title: str, source: str, checked: str, failed: str, table_name: str, key: str) -> str:
    _, passed, broken = banking.RULE_TEXT[key]
    if key == "amount":
        broken = "Found Transactions outside valid range (-200-200)"
    return f"""SELECT '{title}' AS rule_name, '{table_name}' AS table_name, CAST({checked} AS BIGINT) AS records_checked,
      CAST(coalesce({failed}, 0) AS BIGINT) AS records_failed, '{passed}' AS ok_text, '{broken}' AS bad_text FROM {source}"""


_FACT, _HOLDER = "fact_transactions", "dim_account_holder"
_RULES = " UNION ALL ".join(
    _rule(banking.RULE_TEXT[key][0], source, checked, failed, name, key)
    for key, source, checked, failed, name in [
        ("holder", "facts LEFT JOIN holders USING (account_holder_key)", "count(*)",
         "sum(CASE WHEN account_holder_id IS NULL THEN 1 ELSE 0 END)", _FACT),
        ("product", "facts LEFT JOIN products USING (banking_product_key)", "count(*)",
         "sum(CASE WHEN banking_product_id IS NULL THEN 1 ELSE 0 END)", _FACT),
        ("date", "facts LEFT JOIN dates ON transaction_date = full_date", "count(*)",
         "sum(CASE WHEN full_date IS NULL THEN 1 ELSE 0 END)", _FACT),
        ("future", "facts JOIN dates ON transaction_date = full_date", "count(*)",
         "sum(CASE WHEN full_date > DATE '2024-01-20' THEN 1 ELSE 0 END)", _FACT),
        ("amount", "facts", "count(*)",
         "sum(CASE WHEN transaction_amount < -200 OR transaction_amount > 200 THEN 1 ELSE 0 END)", _FACT),
        ("account", "facts", "count(*)", "sum(CASE WHEN regexp_full_match(account_number, "
         "'(CC|MTG|SAV|INV|SVC|LON|AUTO|CHK)[0-9]{6}') THEN 0 ELSE 1 END)", _FACT),
        ("sequence", "holders", "count(*)", "sum(CASE WHEN effective_date > expiration_date THEN 1 ELSE 0 END)", _HOLDER),
        ("current", "holders", "count(*)",
         "sum(CASE WHEN is_current AND expiration_date IS NOT NULL THEN 1 ELSE 0 END)", _HOLDER),
        ("one_current", "(SELECT account_holder_id, count(*) FILTER (WHERE is_current) AS n FROM holders GROUP BY 1)",
         "count(*)", "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)", _HOLDER),
        ("unique", "(SELECT transaction_id, count(*) AS n FROM facts GROUP BY 1)", "count(*)",
         "sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)", _FACT),
    ]
)

_SQL = {
    "map_synonyms": "SELECT tier, count(*) AS holders FROM holder_text GROUP BY tier",
    "in_list": "SELECT transaction_id FROM staging WHERE product_name IN ('purchase', 'signup')",
    "between_inclusive": "SELECT transaction_id FROM staging WHERE transaction_amount BETWEEN -50 AND 50",
    "not_null_not_blank": "SELECT count(*) AS usable_rows FROM staging WHERE trim(account_holder_name) <> ''",
    "like_pattern": """SELECT transaction_id, account_number FROM staging
        WHERE NOT regexp_full_match(account_number, '(CC|MTG|SAV|INV|SVC|LON|AUTO|CHK)[0-9]{6}')""",
    "proper_case": "SELECT c_custkey, account_holder_name AS holder_name FROM clean",
    "squeeze_spaces": "SELECT c_custkey, address FROM clean",
    "metro_city": "SELECT c_custkey, city FROM holder_text",
    "bank_business_rules": "SELECT * FROM staged",
    "scd2_detect": """SELECT account_holder_id, account_holder_key, relationship_tier, change_type,
        CASE change_type WHEN 'NEW' THEN 'INSERT_NEW' WHEN 'CHANGED' THEN 'EXPIRE_AND_INSERT' ELSE 'NO_ACTION' END AS scd_action
        FROM detected""",
    "scd2_apply": """SELECT h.account_holder_key, h.account_holder_id, h.account_holder_name, h.address, h.relationship_tier,
          h.effective_date, CASE WHEN d.change_type = 'CHANGED' THEN DATE '2024-02-01' ELSE h.expiration_date END AS expiration_date,
          h.is_current AND d.change_type IS DISTINCT FROM 'CHANGED' AS is_current
        FROM holders h LEFT JOIN detected d ON h.account_holder_key = d.account_holder_key
        UNION ALL
        SELECT (SELECT max(account_holder_key) FROM holders)
            + row_number() OVER (ORDER BY md5(account_holder_id)),
          account_holder_id, account_holder_name, address, relationship_tier, DATE '2024-02-01', NULL, true
        FROM detected WHERE change_type <> 'UNCHANGED'""",
    "insert_only_dimension": """SELECT (SELECT max(banking_product_key) FROM products)
          + row_number() OVER (ORDER BY md5(banking_product_id)) AS banking_product_key,
          banking_product_id, product_name, product_category, true AS is_active
        FROM (SELECT DISTINCT banking_product_id, product_name, product_category FROM staging)
        WHERE banking_product_id NOT IN (SELECT banking_product_id FROM products)""",
    "first_per_key": """SELECT account_holder_id, transaction_date, transaction_id FROM (SELECT *, row_number() OVER (
          PARTITION BY account_holder_id ORDER BY transaction_date, transaction_id) AS rn FROM staging) WHERE rn = 1""",
    "build_date_dimension": """SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date,
          CAST(year(full_date) AS INT) AS year_number, CAST(quarter(full_date) AS INT) AS quarter_number,
          CAST(month(full_date) AS INT) AS month_number, CAST(day(full_date) AS INT) AS day_number,
          CAST(isodow(full_date) - 1 AS INT) AS day_of_week, CAST(weekofyear(full_date) AS INT) AS week_of_year,
          dayname(full_date) AS day_name, monthname(full_date) AS month_name, isodow(full_date) >= 6 AS is_weekend,
          isodow(full_date) < 6 AS is_business_day, false AS is_holiday FROM dates""",
    "load_fact_transactions": """SELECT account_holder_key, banking_product_key, CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key,
          transaction_id, account_number, CAST(transaction_amount AS DOUBLE) AS transaction_amount, transaction_type
        FROM staging JOIN holders h USING (account_holder_id) JOIN products USING (banking_product_id)
        JOIN dates ON transaction_date = full_date
        WHERE h.is_current AND transaction_amount BETWEEN -50000 AND 50000 AND transaction_type <> 'click'""",
    "fact_transaction_rejects": """SELECT transaction_id, reject_reason, count(*) AS row_count FROM (
          SELECT s.transaction_id, CASE WHEN transaction_type = 'click' THEN 'duplicate'
            WHEN transaction_amount NOT BETWEEN -200 AND 200 THEN 'invalid amount'
            WHEN h.account_holder_key IS NULL THEN 'unknown account_holder_id'
            WHEN transaction_type NOT IN ('purchase', 'view') THEN 'unknown banking_product_id'
            WHEN day(transaction_date) >= 25 THEN 'unknown date_key'
            WHEN copy > 1 THEN 'duplicate' END AS reject_reason
          FROM (SELECT *, 1 AS copy FROM staging UNION ALL SELECT *, 2 FROM staging WHERE transaction_type = 'signup') s
            LEFT JOIN holders h ON s.account_holder_id = h.account_holder_id AND h.is_current)
        WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "fact_transaction_counters": """SELECT 2 * count(*) AS total_processed,
          count(*) FILTER (WHERE transaction_type IN ('purchase', 'view') AND h.account_holder_key IS NOT NULL) AS successfully_loaded,
          2 * count(*) FILTER (WHERE transaction_type <> 'click' AND (transaction_type NOT IN ('purchase', 'view') OR h.account_holder_key IS NULL))
            AS failed_validation,
          2 * count(*) FILTER (WHERE transaction_type = 'click')
            + count(*) FILTER (WHERE transaction_type IN ('purchase', 'view') AND h.account_holder_key IS NOT NULL) AS duplicate_facts
        FROM staging s LEFT JOIN holders h ON s.account_holder_id = h.account_holder_id AND h.is_current""",
    "reset_period": "SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key FROM dates WHERE full_date < DATE '2024-01-15'",
    "validation_suite": f"""SELECT rule_name, table_name, records_checked, records_failed,
          CASE WHEN records_failed = 0 THEN 'PASSED' ELSE 'FAILED' END AS validation_status,
          CAST(round(CAST(records_failed * 100.0 / records_checked AS DECIMAL(28,8)), 2) AS DOUBLE) AS failure_percentage,
          CASE WHEN records_failed = 0 THEN ok_text ELSE bad_text END AS error_details FROM ({_RULES})""",
    "distinct_rollup": """SELECT event_type, 'users' AS measure, count(DISTINCT user_id) AS exact_count, true AS within_error FROM events GROUP BY 1
        UNION ALL SELECT event_type, 'values', count(DISTINCT value), true FROM events GROUP BY 1""",
    "sketched_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing_values, count(DISTINCT {c}) AS exact_unique, "
        "true AS within_error FROM events"
        for c in EVENT_COLUMNS
    ),
    "moving_average_3": """SELECT account_holder_key, account_holder_name, relationship_tier, transaction_date, transaction_id,
          CAST(transaction_amount AS DOUBLE) AS transaction_amount,
          CAST(sum(transaction_amount) OVER w AS DOUBLE) / count(transaction_amount) OVER w AS moving_3_transaction_avg
        FROM (SELECT *, count(*) OVER (PARTITION BY account_holder_key) AS n FROM facts) f
          JOIN (SELECT * FROM holders WHERE is_current) USING (account_holder_key) WHERE n >= 3
        WINDOW w AS (PARTITION BY account_holder_key ORDER BY transaction_date, transaction_id
          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "running_balance": """SELECT account_holder_key, account_holder_name, relationship_tier, address, transaction_date,
          transaction_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
          CAST(sum(transaction_amount) OVER (PARTITION BY account_holder_key ORDER BY transaction_date, transaction_id
            ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS account_running_balance
        FROM facts JOIN (SELECT * FROM holders WHERE is_current) USING (account_holder_key)""",
    "transaction_dense_rank": """SELECT account_holder_key, account_holder_name, relationship_tier, transaction_date, transaction_id,
          CAST(transaction_amount AS DOUBLE) AS transaction_amount, product_name, product_category,
          CAST(account_holder_transaction_rank AS INT) AS account_holder_transaction_rank
        FROM (SELECT *, dense_rank() OVER (PARTITION BY account_holder_key ORDER BY transaction_amount DESC)
            AS account_holder_transaction_rank FROM facts JOIN products USING (banking_product_key))
          JOIN (SELECT * FROM holders WHERE is_current) USING (account_holder_key)""",
    "final_row_counts": """SELECT 'stg_transactions_raw' AS table_name, count(*) AS row_count FROM staging
        UNION ALL SELECT 'fact_transactions', count(*) FROM facts UNION ALL SELECT 'dim_account_holder', count(*) FROM holders
        UNION ALL SELECT 'dim_banking_product', count(*) FROM products UNION ALL SELECT 'dim_date', count(*) FROM dates""",
}

_SQL["validation_by_days"] = _SQL["validation_suite"]
_SQL["fact_rejects_by_filter"] = _SQL["fact_transaction_rejects"]

ORACLES = {name: ROLES_SQL + sql for name, sql in _SQL.items()}
