"""Sources and sinks: whole tables written in a format and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_email
from ..plans import insurance
from ..session import stage_folder, tune
from ..sources import intake, readers, writers
from . import Query, table


#: Rows of one array file: the files, not the arrays, grow with the table.
ARRAY_ROWS = 1_000


def _place(spark: SparkSession, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _csv(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")
    )
    path = _place(spark, "orders-csv")
    writers.export_csv(orders, path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_orderdate timestamp"
    return readers.read_csv_source(spark, path, schema).withColumn("o_orderdate", F.to_date("o_orderdate"))


CUSTOMER_FIELDS = "customer_id string, email string, risk_score double, balance decimal(10,2), points bigint, since date"


def _customer_csv(spark: SparkSession, folder: str) -> str:
    """Customers as messy CSV: some lack a key, some hold words where numbers or days belong."""
    customers = table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") < -500, " ").otherwise(F.col("c_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("C"), F.col("c_custkey"), F.when(F.col("c_acctbal") < 0, "").otherwise("@Mail.org")).alias("email"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("risk_score"),
        F.concat(F.lit(" "), F.col("c_acctbal").cast("decimal(10,2)")).alias("balance"),
        F.when(F.col("c_nationkey") == 3, "many").otherwise(F.col("c_custkey").cast("string")).alias("points"),
        F.when(F.col("c_nationkey") == 4, "31-31-31").otherwise("2001-02-03").alias("since"),
    )
    path = _place(spark, "customers-csv")
    writers.export_csv(customers, path)
    return path


def _trimmed_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = _customer_csv(spark, folder)
    df = readers.read_csv_trimmed(spark, path, CUSTOMER_FIELDS, "customer_id", ["email"], insurance.customer_warnings())
    return df.withColumns({"dq_flags": F.array_join("dq_flags", ","), "balance": F.col("balance").cast("double")})


def _taken_in(spark: SparkSession, folder: str) -> intake.Intake:
    """The same customers; who has no known day is set aside too."""
    rejects = [(F.col("since").isNull(), "unknown day")]
    options = {"lower": ["email"], "warnings": insurance.customer_warnings(), "rejects": rejects}
    path = _customer_csv(spark, folder)
    return intake.take_in_csv(spark, path, CUSTOMER_FIELDS, "customer_id", _place(spark, "customers-in"), **options)


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    kept = _taken_in(spark, folder).kept
    return kept.withColumns({"dq_flags": F.array_join("dq_flags", ","), "balance": F.col("balance").cast("double")})


def _quarantined(spark: SparkSession, folder: str) -> DataFrame:
    return _taken_in(spark, folder).quarantined.select("email", "points", "since", "reject_reason")


def _intake_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Rows counted while the intake was written, beside the rows that it wrote."""
    taken = _taken_in(spark, folder)
    written = taken.kept.agg(F.count("*").alias("kept_written"))
    aside = taken.quarantined.agg(F.count("*").alias("rows")).scalar()
    counts = {name: F.lit(getattr(taken, name)).cast("bigint") for name in ("rows_read", "rows_kept", "rows_quarantined")}
    return written.withColumns(counts | {"quarantined_written": aside})


def _json_array(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as files that each hold one array of at most ``ARRAY_ROWS``; some lack a phone, some a key."""
    suppliers = table(spark, folder, "supplier").select(
        F.floor(F.col("s_suppkey") / ARRAY_ROWS).alias("file"),
        F.struct(
            F.when(F.col("s_acctbal") < -500, " ").otherwise(F.concat(F.lit(" S"), F.col("s_suppkey"))).alias("supplier_id"),
            F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.col("s_name")).alias("name"),
            F.col("s_acctbal").cast("string").alias("balance"),
        ).alias("row"),
    )
    arrays = suppliers.groupBy("file").agg(F.to_json(F.collect_list("row")).alias("value"))
    path = _place(spark, "suppliers-json")
    arrays.write.option("lineSep", "\n").partitionBy("file").text(path)
    schema = "supplier_id string, name string, balance double"
    return readers.read_json_array(spark, f"{path}/*", schema, "supplier_id", {"name": "Unknown"})


def _rules(spark: SparkSession, folder: str) -> DataFrame:
    """A rule per nation, one JSON object per line, between blank and broken lines."""
    n = F.col("n_nationkey")
    rule = F.to_json(
        F.struct(
            F.col("n_name").alias("rule_id"),
            F.concat(F.lit("Rule "), n).alias("rule_name"),
            F.when(n % 2 == 0, "HIGH").otherwise("LOW").alias("priority"),
            F.when(n % 3 == 0, F.lit(True)).alias("active"),
            F.when(n % 3 == 1, F.lit(False)).alias("is_active"),
            F.struct((n * 4).alias("risk_score")).alias("thresholds"),
        )
    )
    lines = table(spark, folder, "nation").select(F.when(n % 7 == 6, "{broken").when(n % 7 == 5, "").otherwise(rule).alias("value"))
    path = _place(spark, "rules-jsonl")
    lines.write.text(path)
    found = readers.read_jsonl_rules(spark, path)
    return found.unionByName(readers.read_jsonl_rules(spark, f"{path}-missing"))


def _published(spark: SparkSession, folder: str) -> str:
    name = f"ledger_{uuid.uuid4().hex}"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    writers.publish_table(orders, name, ["o_orderstatus"], (4, "o_orderkey"))
    return name


def _publish(spark: SparkSession, folder: str) -> DataFrame:
    """Publish all orders by status, bucketed by key, and read the table."""
    return readers.read_table(spark, _published(spark, folder))


def _read(spark: SparkSession, folder: str) -> DataFrame:
    published = readers.read_table(spark, _published(spark, folder))
    return published.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.max("price").alias("highest"))


def _append(spark: SparkSession, folder: str) -> DataFrame:
    """Append suppliers to published customers: known columns by name, the others stay empty or out."""
    name = f"ledger_{uuid.uuid4().hex}"
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"), "c_mktsegment")
    writers.publish_table(customers, name)
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("c_name"), "s_nationkey")
    writers.append_table(suppliers, name)
    return readers.read_table(spark, name)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang", F.split("text", " ").alias("words"))
    path = _place(spark, "documents-json")
    writers.export_json(documents, path)
    df = readers.read_document_collection(spark, path, "doc_id bigint, lang string, words array<string>")
    return df.select("doc_id", "lang", F.array_join("words", " ").alias("text"))


def _views(spark: SparkSession, folder: str) -> DataFrame:
    writers.register_views(
        {"ledger_orders": table(spark, folder, "orders"), "ledger_customers": table(spark, folder, "customer")}
    )
    return spark.sql(
        "SELECT c_mktsegment, count(*) AS orders FROM ledger_orders JOIN ledger_customers ON o_custkey = c_custkey GROUP BY c_mktsegment"
    )


def _period(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    path = _place(spark, "orders-by-year")
    writers.replace_period(orders, path, ["order_year"])
    reloaded = orders.where("order_year = 1997").select((-F.col("o_orderkey")).alias("o_orderkey"), "order_year")
    writers.replace_period(reloaded, path, ["order_year"])
    return spark.read.schema("o_orderkey bigint, order_year int").parquet(path)


def _emails(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", clean_email(F.concat(F.lit(" p"), F.col("page_id"), F.lit("@"), F.parse_url("url", F.lit("HOST")))).alias("email"))


_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_csv_source": _csv,
    "read_csv_trimmed": _trimmed_csv,
    "intake_kept": _kept,
    "intake_quarantined": _quarantined,
    "intake_counters": _intake_counters,
    "read_document_collection": _documents,
    "register_views": _views,
    "replace_period": _period,
    "read_json_array": _json_array,
    "read_jsonl_rules": _rules,
    "publish_table": _publish,
    "read_table": _read,
    "append_table": _append,
    "page_emails": _emails,
}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, folder: build(tune(spark), folder)


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDERS.items()}

ORACLES = {
    "read_csv_source": "SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "read_csv_trimmed": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'c' || c_custkey || CASE WHEN c_acctbal < 0 THEN '' ELSE '@mail.org' END AS email,
        CASE c_mktsegment WHEN 'MACHINERY' THEN 0 ELSE c_acctbal END AS risk_score,
        CASE WHEN c_acctbal < 0 THEN 'invalid email format' ELSE '' END AS dq_flags, CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS balance,
        CASE WHEN c_nationkey <> 3 THEN c_custkey END AS points, CASE WHEN c_nationkey <> 4 THEN DATE '2001-02-03' END AS since
        FROM customer WHERE c_acctbal >= -500""",
    "read_json_array": """SELECT 'S' || s_suppkey AS supplier_id, CASE WHEN s_acctbal < 0 THEN 'Unknown' ELSE s_name END AS name, s_acctbal AS balance
        FROM supplier WHERE s_acctbal >= -500""",
    "read_jsonl_rules": """SELECT n_name AS rule_id, 'Rule ' || n_nationkey AS rule_name, CASE WHEN n_nationkey % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS priority,
        CAST(n_nationkey * 4 AS INT) AS risk_score, CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS active, 'file' AS rules_from
        FROM nation WHERE n_nationkey % 7 < 5
        UNION ALL VALUES ('HIGH_AMOUNT_SINGLE', 'High Amount Single Transaction', 'HIGH', 75, true, 'default'),
          ('VELOCITY_MULTIPLE_TRANSACTIONS', 'Transaction Velocity Check', 'MEDIUM', 60, true, 'default'),
          ('MERCHANT_CATEGORY_RISK', 'High Risk Merchant Categories', 'MEDIUM', 50, true, 'default')""",
    "publish_table": "SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderstatus FROM orders",
    "read_table": "SELECT o_orderstatus, count(*) AS orders, max(o_totalprice) AS highest FROM orders GROUP BY ALL",
    "append_table": """SELECT c_custkey, c_name, c_acctbal AS balance, c_mktsegment FROM customer
        UNION ALL SELECT NULL, s_name, s_acctbal, NULL FROM supplier""",
    "read_document_collection": "SELECT doc_id, lang, text FROM documents",
    "register_views": "SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
    "replace_period": """SELECT CASE WHEN year(o_orderdate) = 1997 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
        CAST(year(o_orderdate) AS INT) AS order_year FROM orders""",
    "page_emails": """SELECT page_id, 'p' || page_id || '@' || regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS email FROM pages""",
}

ORACLES["intake_kept"] = ORACLES["read_csv_trimmed"] + " AND c_nationkey <> 4"
ORACLES["intake_quarantined"] = """SELECT 'C' || c_custkey || CASE WHEN c_acctbal < 0 THEN '' ELSE '@Mail.org' END AS email,
    CASE WHEN c_nationkey = 3 THEN 'many' ELSE CAST(c_custkey AS VARCHAR) END AS points,
    CASE WHEN c_nationkey = 4 THEN '31-31-31' ELSE '2001-02-03' END AS since,
    CASE WHEN c_acctbal < -500 THEN 'missing key' ELSE 'unknown day' END AS reject_reason
    FROM customer WHERE c_acctbal < -500 OR c_nationkey = 4"""
ORACLES["intake_counters"] = """SELECT count(*) AS rows_read, count(*) FILTER (WHERE kept) AS rows_kept, count(*) FILTER (WHERE NOT kept) AS rows_quarantined,
    count(*) FILTER (WHERE kept) AS kept_written, count(*) FILTER (WHERE NOT kept) AS quarantined_written
    FROM (SELECT c_acctbal >= -500 AND c_nationkey <> 4 AS kept FROM customer)"""
