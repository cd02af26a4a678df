"""Insurance star-schema queries: orders are policies, returned line items are claims."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.dates import age_in_years, date_key, parse_iso_date
from ..functions.numbers import safe_double, safe_int
from ..functions.text import email_key, standardize_phone
from ..operators.dimensions import covering_date_dimension, missing_date_keys, scd1_upsert
from ..operators.facts import load_success_rate
from ..operators.keys import assign_surrogate_keys, first_per_key, keys_without_match
from ..operators.quality import check_extracts, row_warnings
from ..plans import insurance
from ..session import tune
from . import Query, r2, table

AS_OF = date(2001, 12, 31)


def _day_text(c: str):
    return F.date_format(c, "yyyy-MM-dd")


class Roles:
    """Raw extracts as text, and dimensions that miss some members."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.read = lambda name: table(spark, folder, name)

    @property
    def customers(self) -> DataFrame:
        joined = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        seven = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
        segment = F.col("c_mktsegment")
        phone = case_bucket(
            [
                (segment == "AUTOMOBILE", F.concat(F.lit("555"), seven)),
                (segment == "BUILDING", F.concat(F.lit("+1 (555) "), seven)),
                (segment == "FURNITURE", F.lit(" ")),
                (segment == "HOUSEHOLD", F.concat(F.lit("5-"), seven)),
            ],
            F.concat(F.lit("2555"), seven),
        )
        birth = F.date_add(F.lit(date(1940, 1, 1)), ((F.col("c_custkey") * 7919) % 22000).cast("int"))
        return joined.select(
            F.concat(F.lit("CUST"), F.col("c_custkey")).alias("customer_id"),
            F.concat(F.lit("  "), F.lower(segment)).alias("first_name"),
            F.concat(F.lit("o'"), F.upper("n_name"), F.lit("-SMITH ")).alias("last_name"),
            F.concat(F.lit(" User"), F.col("c_custkey"), F.when(F.col("c_acctbal") < 0, ".Example.com").otherwise("@Example.com")).alias("email"),
            phone.alias("phone"),
            F.when(F.col("c_acctbal") < -500, "13-13-1970").otherwise(F.date_format(birth, "yyyy-MM-dd")).alias("birth_date"),
            F.initcap("c_mktsegment").alias("city"),
            F.col("n_name").alias("state"),
            ((F.col("c_acctbal") + 1000) / 2200).alias("risk_score"),
            F.lit("1999-09-09").alias("customer_since"),
        )

    @property
    def policies(self) -> DataFrame:
        o = self.read("orders")
        start = F.col("o_orderdate").cast("date")
        return o.select(
            F.concat(F.lit("POL"), F.col("o_orderkey")).alias("policy_id"),
            F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
            case_bucket(
                [
                    (F.col("o_orderpriority") == "1-URGENT", "Auto"),
                    (F.col("o_orderpriority") == "2-HIGH", "Home"),
                    (F.col("o_orderpriority") == "3-MEDIUM", "Life"),
                    (F.col("o_orderpriority") == "4-NOT SPECIFIED", "boat hire"),
                ],
                "",
            ).alias("policy_type"),
            F.col("o_totalprice").alias("coverage_amount"),
            (F.col("o_totalprice") / 100).alias("annual_premium"),
            F.lit("500").alias("deductible"),
            F.date_format(start, "yyyy-MM-dd").alias("effective_date"),
            F.date_format(F.date_add(start, 365), "yyyy-MM-dd").alias("expiration_date"),
            case_bucket([(F.col("o_orderstatus") == "F", " Lapsed "), (F.col("o_orderstatus") == "P", "")]).alias("status"),
        )

    @property
    def claims(self) -> DataFrame:
        joined = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return self._as_claims(joined.withColumn("policy_id", F.concat(F.lit("POL"), F.col("l_orderkey"))), F.col("l_orderkey"))

    @property
    def claims_by_policy(self) -> DataFrame:
        """The same claims, joined by their policy's id: they come partitioned by it and meet the policies without a further shuffle."""
        lines = self.read("lineitem").withColumn("policy_id", F.concat(F.lit("POL"), F.col("l_orderkey")))
        orders = self.read("orders").withColumn("policy_id", F.concat(F.lit("POL"), F.col("o_orderkey")))
        # The number is read from the id, so that only one of them is shuffled.
        return self._as_claims(lines.join(orders, "policy_id"), F.expr("substring(policy_id, 4)"))

    def _as_claims(self, joined: DataFrame, number: Column) -> DataFrame:
        return joined.select(
            F.concat_ws("-", F.lit("CLM"), number, "l_linenumber").alias("claim_id"),
            "policy_id",
            F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
            F.concat(F.lit("AGT"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("agent_id"),
            F.col("l_extendedprice").alias("claim_amount"),
            F.col("o_totalprice").alias("coverage_amount"),
            F.lit(500.0).alias("deductible_amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payout_amount"),
            _day_text("o_orderdate").alias("filed_date"),
            F.when(F.col("l_linestatus") == "F", _day_text("l_shipdate")).otherwise("").alias("closed_date"),
            F.when(F.col("l_linestatus") == "F", " closed").otherwise("o").alias("claim_status"),
        )

    @property
    def dim_customer(self) -> DataFrame:
        return self.read("customer").where("c_acctbal >= 0").select(
            (F.col("c_custkey") + 1).alias("customer_key"), F.concat(F.lit("CUST"), F.col("c_custkey")).alias("customer_id")
        )

    @property
    def dim_policy(self) -> DataFrame:
        return self.read("orders").where("o_orderstatus <> 'P'").select(
            (F.col("o_orderkey") + 1).alias("policy_key"), F.concat(F.lit("POL"), F.col("o_orderkey")).alias("policy_id")
        )

    @property
    def dim_agent(self) -> DataFrame:
        return self.read("supplier").where("s_acctbal >= 0").select(
            (F.col("s_suppkey") + 1).alias("agent_key"),
            F.concat(F.lit("AGT"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("agent_id"),
        )

    @property
    def loaded(self) -> DataFrame:
        return self.read("lineitem").where("l_linenumber = 7").select(
            F.concat_ws("-", F.lit("CLM"), "l_orderkey", "l_linenumber").alias("claim_id")
        )

    @property
    def dates(self) -> DataFrame:
        return covering_date_dimension(self.read("orders").select(F.col("o_orderdate").cast("date").alias("day")), "day")

    def load(self):
        """The load of all claims. Every query takes one of its outputs, so none is stored for the others."""
        claims = insurance.prepare_claims(self.claims_by_policy)
        return insurance.load_claims(claims, self.dim_customer, self.dim_policy, self.dim_agent, self.loaded, store=False)

    @property
    def known_customers(self) -> DataFrame:
        """Customer dimension before an overwrite load: older attributes of half the customers."""
        old = insurance.prepare_customers(self.customers, AS_OF).select("customer_id", "full_name", "risk_tier")
        return (
            self.dim_customer.join(old, "customer_id")
            .select("customer_key", "customer_id", F.lit("Old Name").alias("full_name"), "risk_tier")
        )


_TITLE = """array_to_string(list_transform(regexp_extract_all({0}, '\\p{{L}}+|\\P{{L}}+'),
    lambda x: upper(x[1]) || lower(x[2:])), '')"""
_MD5_MOD = """CAST(({hi} % {m} * {c} + {lo} % {m}) % {m} AS INT)"""


def _md5_mod(text: str, modulus: int) -> str:
    high = f"CAST(('0x' || substr(md5({text}), 1, 16)) AS UBIGINT)"
    low = f"CAST(('0x' || substr(md5({text}), 17, 16)) AS UBIGINT)"
    return _MD5_MOD.format(hi=f"CAST({high} AS HUGEINT)", lo=f"CAST({low} AS HUGEINT)", m=modulus, c=2**64 % modulus)


ROLES_SQL = f"""
WITH raw_customers AS (
  SELECT *, 'CUST' || c_custkey AS customer_id, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS seven,
    CASE WHEN c_acctbal < -500 THEN NULL ELSE DATE '1940-01-01' + CAST((c_custkey * 7919) % 22000 AS INT) END AS birth
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
prepared_customers AS (
  SELECT customer_id, {_TITLE.format("lower(c_mktsegment)")} AS first_name,
    {_TITLE.format("'o''' || n_name || '-SMITH'")} AS last_name,
    'user' || c_custkey || CASE WHEN c_acctbal < 0 THEN '.example.com' ELSE '@example.com' END AS email,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'UNKNOWN' WHEN 'AUTOMOBILE' THEN '(555) ' || substr(seven, 1, 3) || '-' || substr(seven, 4)
      WHEN 'BUILDING' THEN '(555) ' || substr(seven, 1, 3) || '-' || substr(seven, 4) ELSE 'INVALID' END AS phone,
    birth AS birth_date, CAST(coalesce(date_sub('year', birth, DATE '2001-12-31'), 0) AS INT) AS age,
    substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) AS city, n_name AS state,
    (c_acctbal + 1000) / 2200 AS risk_score, DATE '1999-09-09' AS customer_since
  FROM raw_customers),
customers AS (
  SELECT *, CASE WHEN age < 25 OR risk_score >= 3 THEN 'High' WHEN risk_score < 2 THEN 'Low' ELSE 'Medium' END AS risk_tier,
    first_name || ' ' || last_name AS full_name FROM prepared_customers),
claims AS (
  SELECT 'CLM-' || l_orderkey || '-' || l_linenumber AS claim_id, 'POL' || l_orderkey AS policy_id, 'CUST' || o_custkey AS customer_id,
    'AGT' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS agent_id, l_suppkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS filed_date_key,
    CASE l_linestatus WHEN 'F' THEN CAST(strftime(l_shipdate, '%Y%m%d') AS INT) ELSE 0 END AS closed_date_key,
    l_extendedprice AS claim_amount, o_totalprice AS coverage_amount, 500.0::DOUBLE AS deductible_amount,
    l_extendedprice * (1 - l_discount) AS payout_amount,
    CASE l_linestatus WHEN 'F' THEN CAST(date_diff('day', o_orderdate, l_shipdate) AS INT) END AS processing_days,
    CASE l_linestatus WHEN 'F' THEN 'Closed' ELSE 'Open' END AS claim_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
dim_customer AS (SELECT c_custkey + 1 AS customer_key, 'CUST' || c_custkey AS customer_id FROM customer WHERE c_acctbal >= 0),
dim_policy AS (SELECT o_orderkey + 1 AS policy_key, 'POL' || o_orderkey AS policy_id FROM orders WHERE o_orderstatus <> 'P'),
dim_agent AS (SELECT s_suppkey + 1 AS agent_key, 'AGT' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS agent_id
  FROM supplier WHERE s_acctbal >= 0),
loaded AS (SELECT DISTINCT 'CLM-' || l_orderkey || '-' || l_linenumber AS claim_id FROM lineitem
  WHERE l_linenumber = 7),
classified AS (
  SELECT c.*, customer_key, policy_key, agent_key,
    CASE WHEN l.claim_id IS NOT NULL THEN 'duplicate' WHEN NOT (claim_amount > 0 AND claim_amount <= coverage_amount) THEN 'invalid amount'
      WHEN customer_key IS NULL THEN 'unknown customer_id' WHEN policy_key IS NULL THEN 'unknown policy_id'
      WHEN agent_key IS NULL THEN 'unknown agent_id' END AS reason
  FROM claims c LEFT JOIN dim_customer USING (customer_id) LEFT JOIN dim_policy USING (policy_id)
    LEFT JOIN dim_agent USING (agent_id) LEFT JOIN loaded l ON c.claim_id = l.claim_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY claim_id, reason ORDER BY claim_amount, agent_id, filed_date_key, closed_date_key,
    payout_amount) AS rn FROM classified),
outcome AS (SELECT *, CASE WHEN reason IS NULL AND rn > 1 THEN 'duplicate' ELSE reason END AS final_reason FROM ranked),
facts AS (
  SELECT claim_id, customer_key, policy_key, agent_key, filed_date_key, nullif(closed_date_key, 0) AS closed_date_key,
    claim_amount, coverage_amount, deductible_amount, payout_amount, processing_days, claim_status,
    CASE WHEN coverage_amount > 0 THEN claim_amount / coverage_amount ELSE 0 END AS claim_to_coverage_ratio
  FROM outcome WHERE final_reason IS NULL),
dates AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE)
    AS full_date FROM orders),
needed AS (SELECT DISTINCT date_key FROM (SELECT filed_date_key AS date_key FROM claims UNION ALL SELECT closed_date_key FROM claims)
  WHERE date_key > 0)
"""


def _query(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, folder: build(Roles(tune(spark), folder))


def _orphans(r: Roles) -> DataFrame:
    facts = r.load().facts
    return insurance.claim_orphans(
        facts,
        r.dim_customer.where("customer_key > 100"),
        r.dim_policy,
        r.dim_agent.where("agent_key > 10"),
        r.dates.where("year_number > 1995"),
    )


def _checked_extracts(r: Roles) -> DataFrame:
    known = r.customers.join(r.dim_customer, "customer_id", "left_semi")
    return check_extracts(
        {"customers": known, "policies": r.policies, "claims": r.claims},
        {"customers": 50, "policies": 75, "claims": 400_000},
        [("policies", "customers", "customer_id"), ("claims", "customers", "customer_id")],
    )


def _upsert(r: Roles) -> DataFrame:
    incoming = insurance.prepare_customers(r.customers, AS_OF).select("customer_id", "full_name", "risk_tier")
    return scd1_upsert(r.known_customers, incoming, "customer_id", "customer_key")


def _warned(df: DataFrame, warnings, key: str) -> DataFrame:
    return df.select(key, F.array_join(row_warnings(warnings), "; ").alias("warnings")).where("warnings <> ''")


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "standardize_phone": lambda r: r.customers.select("customer_id", standardize_phone("phone").alias("phone")),
        "safe_float": lambda r: r.customers.select("customer_id", safe_double("risk_score").alias("score"), safe_double("birth_date").alias("none")),
        "safe_int": lambda r: r.customers.select("customer_id", safe_int("risk_score").alias("score"), safe_int("phone").alias("digits")),
        "age_in_years": lambda r: r.customers.select("customer_id", age_in_years(parse_iso_date("birth_date"), AS_OF).alias("age")),
        "date_key": lambda r: r.customers.select("customer_id", date_key(parse_iso_date("birth_date")).alias("birth_key")),
        "email_key": lambda r: r.customers.select("customer_id", email_key("email").alias("email_key")),
        "prepare_customers": lambda r: insurance.prepare_customers(r.customers, AS_OF),
        "prepare_policies": lambda r: insurance.prepare_policies(r.policies),
        "prepare_claims": lambda r: insurance.prepare_claims(r.claims),
        "validate_claim_amount": lambda r: r.claims.groupBy(
            insurance.valid_claim_amount(F.col("claim_amount"), F.col("coverage_amount")).alias("valid")
        ).agg(F.count("*").alias("claims")),
        "derive_agent_dimension": lambda r: insurance.derive_agents(r.claims),
        "needed_date_keys": lambda r: insurance.claim_date_keys(insurance.prepare_claims(r.claims)),
        "validate_date_keys": lambda r: missing_date_keys(insurance.claim_date_keys(insurance.prepare_claims(r.claims)), r.dates),
        "load_fact_claims": lambda r: r.load().facts,
        "fact_claim_rejects": lambda r: r.load().rejects,
        "fact_claim_counters": lambda r: r.load().counters,
        "load_success_rate": lambda r: load_success_rate(r.load().counters),
        "fact_claim_ratio": lambda r: r.load().facts.select("claim_id", "claim_to_coverage_ratio"),
        "fk_orphan_report": _orphans,
        "validate_extracted": _checked_extracts,
        "keys_without_match": lambda r: keys_without_match(r.policies, r.dim_customer, "customer_id"),
        "customer_row_warnings": lambda r: _warned(r.customers, insurance.customer_warnings(), "customer_id"),
        "policy_row_warnings": lambda r: _warned(r.policies, insurance.policy_warnings(), "policy_id"),
        "claim_row_warnings": lambda r: _warned(r.claims, insurance.claim_warnings(), "claim_id"),
        "scd1_upsert": _upsert,
        "assign_surrogate_keys": lambda r: assign_surrogate_keys(
            r.policies.select("policy_id"), "policy_id", "policy_key", 1000
        ),
        "resolve_surrogate_keys": lambda r: first_per_key(
            r.load().facts.select("customer_key", "policy_key", "agent_key"), ["policy_key"], ["customer_key", "agent_key"]
        ),
    }.items()
}

_SQL = {
    "standardize_phone": "SELECT customer_id, phone FROM customers",
    "safe_float": "SELECT customer_id, risk_score AS score, CAST(0 AS DOUBLE) AS none FROM customers",
    "safe_int": """SELECT customer_id, CAST(trunc((c_acctbal + 1000) / 2200) AS INT) AS score,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN coalesce(TRY_CAST('555' || seven AS INT), 0)
          WHEN 'MACHINERY' THEN coalesce(TRY_CAST('2555' || seven AS INT), 0) ELSE 0 END AS digits FROM raw_customers""",
    "age_in_years": "SELECT customer_id, age FROM customers",
    "date_key": "SELECT customer_id, CAST(coalesce(CAST(strftime(birth, '%Y%m%d') AS INT), 0) AS INT) AS birth_key FROM raw_customers",
    "email_key": f"""SELECT customer_id, {_md5_mod("e", 100000)} AS email_key FROM (SELECT customer_id, ' User' || c_custkey ||
        CASE WHEN c_acctbal < 0 THEN '.Example.com' ELSE '@Example.com' END AS e FROM raw_customers)""",
    "prepare_customers": """SELECT customer_id, first_name, last_name, full_name, email, phone, birth_date, age, city, state,
        risk_score, risk_tier, customer_since FROM customers""",
    "prepare_policies": """SELECT 'POL' || o_orderkey AS policy_id, 'CUST' || o_custkey AS customer_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Auto' WHEN '2-HIGH' THEN 'Home' WHEN '3-MEDIUM' THEN 'Life'
          WHEN '4-NOT SPECIFIED' THEN 'Boat Hire' ELSE '' END AS policy_type, o_totalprice AS coverage_amount,
        o_totalprice / 100 AS annual_premium, CASE WHEN o_totalprice / 100 >= 2000 THEN 'Premium'
          WHEN o_totalprice / 100 >= 1000 THEN 'Standard' ELSE 'Economy' END AS premium_tier, CAST(500 AS DOUBLE) AS deductible,
        CAST(o_orderdate AS DATE) AS effective_date, CAST(o_orderdate AS DATE) + 365 AS expiration_date,
        CASE o_orderstatus WHEN 'F' THEN 'Lapsed' ELSE 'Active' END AS status FROM orders""",
    "prepare_claims": "SELECT * EXCLUDE (l_suppkey) FROM claims",
    "validate_claim_amount": """SELECT claim_amount > 0 AND claim_amount <= coverage_amount AS valid, count(*) AS claims
        FROM claims GROUP BY 1""",
    "derive_agent_dimension": f"""SELECT agent_id, 'Agent' AS first_name, substr(agent_id, 4) AS last_name, 'Agent ' || agent_id AS full_name,
        CASE WHEN l_suppkey <= 5 THEN 'North' WHEN l_suppkey <= 10 THEN 'South' ELSE 'Central' END AS region,
        {_md5_mod("agent_id", 15)} + 1 AS experience_years, CAST(NULL AS DATE) AS hire_date FROM (SELECT DISTINCT agent_id, l_suppkey FROM claims)""",
    "needed_date_keys": "SELECT date_key FROM needed",
    "validate_date_keys": """SELECT date_key FROM needed WHERE date_key NOT IN
        (SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) FROM dates)""",
    "load_fact_claims": "SELECT * FROM facts",
    "fact_claim_rejects": "SELECT claim_id, final_reason AS reject_reason, count(*) AS row_count FROM outcome WHERE final_reason IS NOT NULL GROUP BY ALL",
    "fact_claim_counters": """SELECT count(*) AS total_processed, count(*) FILTER (WHERE final_reason IS NULL) AS successfully_loaded,
        count(*) FILTER (WHERE final_reason <> 'duplicate') AS failed_validation,
        count(*) FILTER (WHERE final_reason = 'duplicate') AS duplicate_facts FROM outcome""",
    "load_success_rate": f"""SELECT total_processed, successfully_loaded, {r2("successfully_loaded / total_processed * 100", 1)} AS success_rate,
        CASE WHEN successfully_loaded = 0 THEN 'NOTHING LOADED' WHEN successfully_loaded / total_processed * 100 < 90
          THEN 'LOW SUCCESS RATE' ELSE 'OK' END AS load_status
        FROM (SELECT count(*) AS total_processed, count(*) FILTER (WHERE final_reason IS NULL) AS successfully_loaded FROM outcome)""",
    "fact_claim_ratio": "SELECT claim_id, claim_to_coverage_ratio FROM facts",
    "fk_orphan_report": """SELECT 'customers' AS reference, CAST(count(*) AS BIGINT) AS orphaned_rows FROM facts WHERE customer_key <= 100
        UNION ALL SELECT 'policies', 0 UNION ALL SELECT 'agents', count(*) FROM facts WHERE agent_key <= 10
        UNION ALL SELECT 'filed_dates', count(*) FROM facts WHERE filed_date_key < 19960101""",
    "validate_extracted": """SELECT check_name, actual, expected, passed FROM (
        SELECT 'minimum rows: customers' AS check_name, count(*) AS actual, CAST(50 AS BIGINT) AS expected, count(*) >= 50 AS passed FROM dim_customer
        UNION ALL SELECT 'minimum rows: policies', count(*), 75, count(*) >= 75 FROM orders
        UNION ALL SELECT 'minimum rows: claims', count(*), 400000, count(*) >= 400000 FROM claims
        UNION ALL SELECT 'orphaned customer_id: policies', count(DISTINCT o_custkey), 0, count(DISTINCT o_custkey) = 0 FROM orders
          WHERE 'CUST' || o_custkey NOT IN (SELECT customer_id FROM dim_customer)
        UNION ALL SELECT 'orphaned customer_id: claims', count(DISTINCT customer_id), 0, count(DISTINCT customer_id) = 0 FROM claims
          WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer))""",
    "keys_without_match": """SELECT DISTINCT 'CUST' || o_custkey AS customer_id FROM orders
        WHERE 'CUST' || o_custkey NOT IN (SELECT customer_id FROM dim_customer)""",
    "customer_row_warnings": "SELECT customer_id, 'invalid email format' AS warnings FROM raw_customers WHERE c_acctbal < 0",
    "policy_row_warnings": """SELECT 'POL' || o_orderkey AS policy_id, 'invalid policy_type' AS warnings FROM orders
        WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""",
    "claim_row_warnings": """SELECT claim_id, 'claim amount exceeds coverage' AS warnings FROM claims
        WHERE claim_amount > coverage_amount AND coverage_amount > 0""",
    "scd1_upsert": """SELECT customer_key, customer_id, full_name, risk_tier
        FROM dim_customer JOIN customers USING (customer_id)
        UNION ALL SELECT (SELECT max(customer_key) FROM dim_customer) + row_number() OVER (ORDER BY md5(customer_id)),
          customer_id, full_name, risk_tier FROM customers
        WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer)""",
    "assign_surrogate_keys": """SELECT 1000 + row_number() OVER (ORDER BY md5(policy_id)) AS policy_key, policy_id
        FROM (SELECT 'POL' || o_orderkey AS policy_id FROM orders)""",
    "resolve_surrogate_keys": """SELECT customer_key, policy_key, agent_key FROM (SELECT *, row_number() OVER (PARTITION BY policy_key
        ORDER BY customer_key, agent_key) AS rn FROM facts) WHERE rn = 1""",
}

ORACLES = {name: ROLES_SQL + sql for name, sql in _SQL.items()}
