"""Bookstore and data-quality queries: parts are books, suppliers authors, line items orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.dates import parse_iso_date
from ..functions.numbers import clean_numeric
from ..functions.text import array_to_text, clean_email, clean_phone, clean_text, email_key, list_length, strip
from ..operators.aggregates import column_profile, column_summary, duplicate_id_check, duplicate_values, null_counts
from ..operators.cleaning import append_sources, handle_missing, keep_expected_columns, remove_duplicates
from ..operators.dimensions import covering_date_dimension
from ..operators.facts import FactLoad
from ..operators.quality import (
    FieldRule,
    INFO,
    WARNING,
    field_quality_gaps,
    findings_summary,
    quality_report_text,
    run_health,
    validate_field_level,
    validate_list_length,
    validate_schema,
)
from ..plans import bookstore
from ..session import tune
from . import Query, r2, table


class Roles:
    """Untidy bookstore extracts over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.read = lambda name: table(spark, folder, name)

    @property
    def books(self) -> DataFrame:
        isbn = F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
        return self.read("part").select(
            F.when(F.col("p_size") == 1, " ").otherwise(F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t"))).alias("title"),
            F.concat(F.lit("Supplier#"), F.lpad((F.col("p_size") - 1).cast("string"), 9, "0")).alias("author"),
            F.lower("p_type").alias("genre"),
            F.when(F.col("p_size") == 50, "INVALID").otherwise(isbn).alias("isbn"),
            F.when(F.col("p_brand") < "Brand#2", F.lit("")).otherwise(F.lower("p_brand")).alias("series"),
            case_bucket([(F.col("p_type") == "PROMO", "Yes"), (F.col("p_type") == "LARGE", "No")]).alias("recommended"),
        )

    @property
    def authors(self) -> DataFrame:
        joined = self.read("supplier").join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.lower("s_name").alias("name"),
            F.concat(F.lit("a"), F.col("s_nationkey"), F.when(F.col("s_acctbal") < 0, "(at)").otherwise("@"), F.lit("books.example.org ")).alias("email"),
            F.concat(F.lit("555-"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0")).alias("phone"),
            F.array("n_name", F.concat(F.lit("R"), F.col("n_regionkey"))).alias("genres"),
            F.split("s_name", "0").alias("collaborations"),
        )

    @property
    def customers(self) -> DataFrame:
        segment = F.col("c_mktsegment")
        return self.read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.lower("c_name").alias("name"),
            F.concat(F.lit("c"), F.col("c_custkey"), F.when(F.col("c_acctbal") < 0, "@bad").otherwise("@mail.example.com")).alias("email"),
            F.when(segment == "FURNITURE", "12345")
            .otherwise(F.concat(F.lit("(555) "), F.lpad(F.col("c_custkey").cast("string"), 7, "0")))
            .alias("phone"),
            F.split(F.lower(segment), "i").alias("genre_preferences"),
            F.split("c_name", "0").alias("reading_history"),
        )

    @property
    def orders(self) -> DataFrame:
        joined = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        isbn = F.concat(F.lit("978"), F.lpad(F.col("l_partkey").cast("string"), 10, "0"))
        return joined.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("l_discount") == 0.03, "INVALID").otherwise(isbn).alias("book_isbn"),
            F.when(F.col("l_tax") == 0.01, "2020-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
            F.when(F.col("l_tax") == 0.08, "-1").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
            F.when(F.col("l_discount") < 0.1, F.concat(F.lit("$"), F.col("l_extendedprice").cast("decimal(12,2)"))).alias("price"),
        )

    @property
    def documents(self) -> DataFrame:
        return self.read("documents")

    # Dimensions with simple surrogate keys, for the fact load.
    @property
    def dim_book(self) -> DataFrame:
        return self.read("part").where("p_size < 50").select(
            (F.col("p_partkey") + 1).alias("book_key"),
            F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")).alias("isbn"),
        )

    @property
    def dim_author(self) -> DataFrame:
        return self.read("supplier").where("s_acctbal >= 0").select(
            (F.col("s_suppkey") + 1).alias("author_key"), F.col("s_name").alias("name")
        )

    @property
    def dim_customer(self) -> DataFrame:
        return self.read("customer").where("c_mktsegment <> 'FURNITURE'").select(
            (F.col("c_custkey") + 1).alias("customer_key"), F.col("c_custkey").alias("customer_id")
        )

    @property
    def known_books(self) -> DataFrame:
        return self.read("part").where("p_size <= 25").select(
            (F.col("p_partkey") + 1).alias("book_key"),
            F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")).alias("isbn"),
            F.lit("Old").alias("title"),
            F.lit("Old").alias("genre"),
        )


_TITLE = """array_to_string(list_transform(regexp_extract_all({0}, '\\p{{L}}+|\\P{{L}}+'),
    lambda x: CASE x[1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1]) END || lower(x[2:])), '')"""


def _title(expression: str) -> str:
    return _TITLE.format(f"trim({expression}, E' \\t\\n\\r\\f\\x0b')")


ROLES_SQL = f"""
WITH books AS (
  SELECT p_partkey, p_size, CASE WHEN p_size = 1 THEN '' ELSE {_title("p_name")} END AS title,
    'Supplier#' || lpad(CAST(p_size - 1 AS VARCHAR), 9, '0') AS author, {_title("p_type")} AS genre,
    CASE WHEN p_size = 50 THEN 'Invalid' ELSE '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS isbn,
    CASE WHEN p_brand < 'Brand#2' THEN NULL ELSE {_title("p_brand")} END AS series,
    CASE p_type WHEN 'PROMO' THEN 'Yes' WHEN 'LARGE' THEN 'No' ELSE '' END AS recommended FROM part),
authors AS (
  SELECT s_suppkey, {_title("s_name")} AS name, 'a' || s_nationkey || '@books.example.org' AS email,
    '555' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS phone, n_name || ',R' || n_regionkey AS genres,
    CAST(len(string_split(s_name, '0')) AS INT) AS collab_count, s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
customers AS (
  SELECT c_custkey AS customer_id, {_title("c_name")} AS name,
    CASE WHEN c_acctbal >= 0 THEN 'c' || c_custkey || '@mail.example.com' END AS email,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN '555' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone,
    replace(lower(c_mktsegment), 'i', ',') AS genre_preferences,
    CAST(len(string_split(c_name, '0')) AS INT) AS reading_count,
    CAST(len(string_split(lower(c_mktsegment), 'i')) AS INT) AS num_genres FROM customer),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN l_discount = 0.03 THEN 'INVALID' ELSE '978' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') END AS book_isbn,
    CASE WHEN l_tax = 0.01 THEN '2020-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN l_tax = 0.08 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
    CASE WHEN l_discount < 0.1 THEN CAST(l_extendedprice AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
orders_once AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id, book_isbn, order_date, quantity, price) AS rn
  FROM raw_orders) WHERE rn = 1),
findings AS (
  SELECT CAST(p_partkey AS VARCHAR) AS row_key, 'title' AS field, 'required' AS rule, 'Missing required value' AS message, 'ERROR' AS severity
    FROM books WHERE title = ''
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'isbn', 'pattern', 'Pattern mismatch', 'ERROR' FROM books WHERE isbn = 'Invalid'
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'title', 'min_length', 'String too short (len ' || length(title) || ' < min 9)', 'WARNING'
    FROM books WHERE length(title) BETWEEN 1 AND 8
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'title', 'max_length', 'String too long (len ' || length(title) || ' > max 11)', 'WARNING'
    FROM books WHERE length(title) > 11
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'genre', 'allowed', 'Value not allowed', 'INFO' FROM books WHERE genre NOT IN ('Promo', 'Small')
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'isbn', 'type', 'Not of type bigint', 'ERROR' FROM books WHERE isbn = 'Invalid')
"""

BOOK_RULES = [
    FieldRule("title", required=True),
    FieldRule("title", min_length=9, max_length=11, severity=WARNING),
    FieldRule("isbn", required=True, type="bigint", pattern=r"97[89]\d{10}"),
    FieldRule("genre", allowed=("Promo", "Small"), severity=INFO),
]


def _book_findings(r: Roles) -> DataFrame:
    cleaned = r.read("part").select(
        "p_partkey",
        F.when(F.col("p_size") == 1, F.lit(None)).otherwise(clean_text("p_name")).alias("title"),
        clean_text("p_type").alias("genre"),
        F.when(F.col("p_size") == 50, "Invalid")
        .otherwise(F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")))
        .alias("isbn"),
    )
    return validate_field_level(cleaned, BOOK_RULES, "p_partkey")


def _words(r: Roles) -> DataFrame:
    return r.documents.select("doc_id", F.split("text", " ").alias("words"))


def _schema_check(r: Roles) -> DataFrame:
    missing, extra = validate_schema(r.books, ["isbn", "title", "pub_date"])
    return r.books.agg(
        F.lit(",".join(sorted(missing))).alias("missing_columns"),
        F.lit(",".join(sorted(extra))).alias("extra_columns"),
        F.count("*").alias("rows_seen"),
    )


def _gaps(r: Roles) -> DataFrame:
    return field_quality_gaps(
        r.customers,
        {
            "customer_id": (None, 1.0),
            "email": (clean_email("email").isNotNull(), 0.95),
            "phone": (clean_phone("phone").isNotNull(), 0.7),
            "name": (None, 0.9),
            "age": (None, 0.6),
        },
    )


def _health(r: Roles) -> DataFrame:
    """The events as a run log: each kind is a step, each event a piece of work of as many seconds as its value."""
    log = r.read("events").select(
        F.col("event_type").alias("step"),
        F.col("ts").alias("started_at"),
        (F.col("ts").cast("timestamp").cast("double") + F.floor("value")).cast("timestamp").alias("finished_at"),
        F.lit(1).alias("records"),
        F.when(F.col("value") <= 100, 1).otherwise(0).alias("good_records"),
    )
    return run_health(log, {"click": 1_000_000, "error": 4_000_000}, 2_591_000)


def _query(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, folder: build(Roles(tune(spark), folder))


def _sales_load(r: Roles) -> FactLoad:
    """Book sales, of which the partly delivered orders were loaded before."""
    loaded = r.read("orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("order_id"))
    return bookstore.book_sales_load(bookstore.transform_orders(r.orders), r.books, r.dim_book, r.dim_author, r.dim_customer, loaded)


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "clean_text": lambda r: r.documents.select("doc_id", clean_text("text").alias("clean_text")),
        "strip": lambda r: r.documents.select("doc_id", strip("text").alias("stripped")),
        "clean_dates": lambda r: r.orders.select(parse_iso_date("order_date").alias("order_day")).groupBy("order_day").agg(
            F.count("*").alias("orders")
        ),
        "clean_emails": lambda r: r.customers.select("customer_id", clean_email("email").alias("email")),
        "clean_phone_numbers": lambda r: r.customers.select("customer_id", clean_phone("phone").alias("phone")),
        "clean_numerics": lambda r: r.orders.groupBy(
            clean_numeric("quantity").alias("kept_sign"), clean_numeric("quantity", keep_sign=False).alias("dropped_sign")
        ).agg(F.count("*").alias("orders"), F.sum(clean_numeric("price").cast("decimal(12,2)")).cast("double").alias("price")),
        "remove_duplicates": lambda r: remove_duplicates(r.documents.select("text", "doc_id"), ["text"], ["doc_id"]),
        "handle_missing_drop": lambda r: handle_missing(r.books, "drop").select("isbn", "series", "recommended"),
        "handle_missing_fill": lambda r: handle_missing(r.books, "fill", "n/a").groupBy("series", "recommended").agg(
            F.count("*").alias("books")
        ),
        "array_to_text": lambda r: _words(r).select("doc_id", array_to_text("words", "|").alias("joined")),
        "list_length": lambda r: _words(r).select("doc_id", list_length("words").alias("word_count")),
        "customer_email_key": lambda r: r.customers.select(email_key("email", 1000).alias("bucket")).groupBy("bucket").agg(
            F.count("*").alias("customers")
        ),
        "transform_books": lambda r: bookstore.transform_books(r.books),
        "transform_authors": lambda r: bookstore.transform_authors(r.authors),
        "transform_customers": lambda r: bookstore.transform_customers(r.customers),
        "transform_orders": lambda r: bookstore.transform_orders(r.orders).withColumn("price", F.col("price").cast("double")),
        "transform_book_series": lambda r: bookstore.with_normalized_series(r.books).select("isbn", "series_normalized"),
        "transform_author_collaborations": lambda r: bookstore.with_collab_count(r.authors).select("phone", "collab_count"),
        "transform_reading_history": lambda r: bookstore.with_reading_count(r.customers).select("customer_id", "reading_count"),
        "transform_genre_preferences": lambda r: bookstore.with_num_genres(r.customers).select("customer_id", "num_genres"),
        "recommended_score": lambda r: bookstore.with_recommended_score(r.books).select("author", "recommended_score"),
        "load_dimension_book": lambda r: bookstore.load_dimension(
            r.known_books, "isbn", "book_key", bookstore.transform_books(r.books).where("isbn <> 'Invalid'")
        ),
        "dimension_book_rejects": lambda r: bookstore.transform_books(r.books).where("isbn = 'Invalid'").groupBy("isbn").agg(
            F.lit("invalid isbn").alias("reject_reason"), F.count("*").alias("row_count")
        ),
        "load_fact_book_sales": lambda r: bookstore.load_book_sales(
            bookstore.transform_orders(r.orders), r.books, r.dim_book, r.dim_author, r.dim_customer
        ).withColumn("price", F.col("price").cast("double")),
        "fact_book_sales_rejects": lambda r: _sales_load(r).rejects,
        "fact_book_sales_counters": lambda r: _sales_load(r).counters,
        "keep_expected_columns": lambda r: keep_expected_columns(r.customers, ["phone", "name", "no_such_column"]),
        "append_sources": lambda r: append_sources(
            r.authors.select("name", "phone"), r.customers.select("name", "customer_id")
        ).groupBy(F.col("customer_id").isNull().alias("is_author")).agg(F.count("*").alias("people"), F.count("phone").alias("phones")),
        "validate_field_level": _book_findings,
        "validate_field_summary": lambda r: findings_summary(_book_findings(r)),
        "quality_report_text": lambda r: quality_report_text(_book_findings(r)),
        "validate_list_length": lambda r: validate_list_length(_words(r), "words", "doc_id", 20, 1000),
        "validate_schema": _schema_check,
        "field_quality_gaps": _gaps,
        "run_health_report": _health,
        "column_profile": lambda r: column_profile(handle_missing(r.books, "leave")),
        "document_profile": lambda r: column_profile(r.documents),
        "duplicate_values": lambda r: duplicate_values(r.documents, "text"),
        "duplicate_id_check": lambda r: duplicate_id_check(r.orders.select("order_id"), "order_id"),
        "null_counts": lambda r: null_counts(handle_missing(r.books, "leave")),
        "column_summary": lambda r: column_summary(
            r.read("customer").select(F.col("c_acctbal").alias("balance"), "c_nationkey"), ["balance", "c_nationkey"]
        ),
        "bookstore_dates": lambda r: covering_date_dimension(
            r.orders.select(parse_iso_date("order_date").alias("day")), "day"
        ).select("date_key", "full_date", "year_number", "month_number", "day_number"),
    }.items()
}

_SALES_OUTCOMES = """outcomes AS (
          SELECT o.order_id, CASE WHEN o.order_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') THEN 'duplicate'
            WHEN order_date = '2020-02-30' THEN 'invalid order_date' WHEN b.isbn IS NULL THEN 'unknown book_isbn'
            WHEN s_suppkey IS NULL THEN 'unknown author' WHEN c.c_custkey IS NULL THEN 'unknown customer_id' END AS reject_reason
          FROM orders_once o LEFT JOIN (SELECT * FROM books WHERE p_size < 50) b ON o.book_isbn = b.isbn
            LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON s_name = b.author
            LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE') c ON o.customer_id = c.c_custkey)"""

_SQL = {
    "clean_text": f"SELECT doc_id, {_title('text')} AS clean_text FROM documents",
    "strip": "SELECT doc_id, trim(text, E' \\t\\n\\r\\f\\x0b') AS stripped FROM documents",
    "clean_dates": "SELECT TRY_CAST(order_date AS DATE) AS order_day, count(*) AS orders FROM raw_orders GROUP BY 1",
    "clean_emails": "SELECT customer_id, email FROM customers",
    "clean_phone_numbers": "SELECT customer_id, phone FROM customers",
    "clean_numerics": """SELECT CASE WHEN l_tax = 0.08 THEN -1 ELSE CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS kept_sign,
        CASE WHEN l_tax = 0.08 THEN 1 ELSE CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS dropped_sign, count(*) AS orders,
        CAST(sum(CASE WHEN l_discount < 0.1 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END) AS DOUBLE) AS price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "remove_duplicates": "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text",
    "handle_missing_drop": """SELECT CASE WHEN isbn = 'Invalid' THEN 'INVALID' ELSE isbn END AS isbn, lower(series) AS series, recommended
        FROM books WHERE series IS NOT NULL AND recommended <> ''""",
    "handle_missing_fill": """SELECT coalesce(lower(series), 'n/a') AS series, CASE WHEN recommended = '' THEN 'n/a' ELSE recommended END
        AS recommended, count(*) AS books FROM books GROUP BY ALL""",
    "array_to_text": "SELECT doc_id, replace(text, ' ', '|') AS joined FROM documents",
    "list_length": "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INT) AS word_count FROM documents",
    "customer_email_key": """SELECT CAST((CAST(('0x' || substr(h, 1, 16)) AS UBIGINT) % 1000 * 616 + CAST(('0x' || substr(h, 17, 16)) AS UBIGINT) % 1000) % 1000
        AS INT) AS bucket, count(*) AS customers FROM (SELECT md5('c' || c_custkey || CASE WHEN c_acctbal < 0 THEN '@bad' ELSE
        '@mail.example.com' END) AS h FROM customer) GROUP BY 1""",
    "transform_books": "SELECT title, genre, isbn, series, recommended FROM books WHERE title <> ''",
    "transform_authors": """SELECT name, email, phone, genres FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY name, phone, genres)
        AS rn FROM authors WHERE s_acctbal >= 0) WHERE rn = 1""",
    "transform_customers": """SELECT customer_id, name, email, phone, genre_preferences FROM customers
        WHERE email IS NOT NULL AND phone IS NOT NULL""",
    "transform_orders": "SELECT order_id, customer_id, book_isbn, order_date, quantity, CAST(price AS DOUBLE) AS price FROM orders_once",
    "transform_book_series": """SELECT CASE WHEN isbn = 'Invalid' THEN 'INVALID' ELSE isbn END AS isbn, coalesce(lower(series), '')
        AS series_normalized FROM books""",
    "transform_author_collaborations": "SELECT '555-' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS phone, collab_count FROM authors",
    "transform_reading_history": "SELECT customer_id, reading_count FROM customers",
    "transform_genre_preferences": "SELECT customer_id, num_genres FROM customers",
    "recommended_score": "SELECT author, CAST(1 AS DOUBLE) AS recommended_score FROM books",
    "load_dimension_book": """WITH incoming AS (SELECT isbn, title, genre FROM books WHERE title <> '' AND isbn <> 'Invalid'),
        known AS (SELECT p_partkey + 1 AS book_key, '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn FROM part WHERE p_size <= 25)
        SELECT book_key, isbn, coalesce(title, 'Old') AS title, coalesce(genre, 'Old') AS genre FROM known LEFT JOIN incoming USING (isbn)
        UNION ALL SELECT (SELECT max(book_key) FROM known) + row_number() OVER (ORDER BY md5(isbn)), isbn, title, genre
        FROM incoming WHERE isbn NOT IN (SELECT isbn FROM known)""",
    "dimension_book_rejects": """SELECT isbn, 'invalid isbn' AS reject_reason, count(*) AS row_count FROM books
        WHERE title <> '' AND isbn = 'Invalid' GROUP BY ALL""",
    "load_fact_book_sales": """SELECT p_partkey + 1 AS book_key, s_suppkey + 1 AS author_key, o.customer_id + 1 AS customer_key,
        CAST(strftime(CAST(order_date AS DATE), '%Y%m%d') AS INT) AS date_key, quantity, CAST(price AS DOUBLE) AS price
        FROM orders_once o JOIN books b ON o.book_isbn = b.isbn JOIN supplier ON s_name = author
        JOIN customer c ON o.customer_id = c_custkey
        WHERE order_date <> '2020-02-30' AND p_size < 50 AND s_acctbal >= 0 AND c_mktsegment <> 'FURNITURE'""",
    "fact_book_sales_rejects": f"""WITH {_SALES_OUTCOMES}
        SELECT order_id, reject_reason, count(*) AS row_count FROM outcomes WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    "fact_book_sales_counters": f"""WITH {_SALES_OUTCOMES}
        SELECT count(*) AS total_processed, count(*) FILTER (WHERE reject_reason IS NULL) AS successfully_loaded,
          count(*) FILTER (WHERE reject_reason <> 'duplicate') AS failed_validation,
          count(*) FILTER (WHERE reject_reason = 'duplicate') AS duplicate_facts FROM outcomes""",
    "keep_expected_columns": """SELECT lower(c_name) AS name, CASE WHEN c_mktsegment = 'FURNITURE' THEN '12345' ELSE '(555) ' ||
        lpad(CAST(c_custkey AS VARCHAR), 7, '0') END AS phone FROM customer""",
    "append_sources": """SELECT true AS is_author, count(*) AS people, count(*) AS phones FROM supplier
        UNION ALL SELECT false, count(*), 0 FROM customer""",
    "validate_field_level": "SELECT * FROM findings",
    "validate_field_summary": """SELECT field, rule, severity, regexp_replace(message, 'len [0-9]+', 'len n') AS message, count(*) AS row_count
        FROM findings GROUP BY ALL""",
    "quality_report_text": """SELECT 'Data Quality Report ' || string_agg(line, ' ' ORDER BY line) AS report FROM (
        SELECT 'Field ' || chr(39) || field || chr(39) || ': [' || severity || '] ' || said || ' (' || count(*) || ' rows)' AS line
        FROM (SELECT *, regexp_replace(message, 'len [0-9]+', 'len n') AS said FROM findings) GROUP BY field, rule, severity, said)""",
    "validate_list_length": """SELECT CAST(doc_id AS VARCHAR) AS row_key, 'words' AS field, CASE WHEN n < 20 THEN 'min_length' ELSE 'max_length' END AS rule,
        CASE WHEN n < 20 THEN 'Too short (length ' || n || ' < min_length 20)' ELSE 'Too long (length ' || n || ' > max_length 1000)' END
        AS message, 'ERROR' AS severity FROM (SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents) WHERE n < 20 OR n > 1000""",
    "validate_schema": "SELECT 'pub_date' AS missing_columns, 'author,genre,recommended,series' AS extra_columns, count(*) AS rows_seen FROM part",
    "field_quality_gaps": """SELECT field, good / total AS actual, required, greatest(0, required - good / total) AS gap FROM (
        SELECT 'customer_id' AS field, count(customer_id) AS good, count(*) AS total, CAST(1 AS DOUBLE) AS required FROM customers
        UNION ALL SELECT 'email', count(email), count(*), CAST(0.95 AS DOUBLE) FROM customers
        UNION ALL SELECT 'phone', count(phone), count(*), CAST(0.7 AS DOUBLE) FROM customers
        UNION ALL SELECT 'name', count(name), count(*), CAST(0.9 AS DOUBLE) FROM customers
        UNION ALL SELECT 'age', 0, count(*), CAST(0.6 AS DOUBLE) FROM customers)""",
    "run_health_report": """WITH steps AS (
          SELECT event_type AS step, min(epoch_us(ts) / 1000000.0::DOUBLE) AS began, max(epoch_us(ts) / 1000000.0::DOUBLE + floor(value)) AS ended,
            count(*) AS n, count(*) FILTER (WHERE value <= 100) AS good FROM events GROUP BY ALL
        ), whole AS (SELECT * FROM steps UNION ALL SELECT 'total', min(began), max(ended), sum(n)::BIGINT, sum(good)::BIGINT FROM steps),
        limits AS (SELECT *, CASE step WHEN 'click' THEN 1000000::DOUBLE WHEN 'error' THEN 4000000::DOUBLE ELSE 2591000::DOUBLE END AS sla FROM whole)
        SELECT step, round(ended - began, 3) AS duration_seconds, n AS records_processed, good::DOUBLE / n AS quality_score,
          sla AS sla_seconds, ended - began <= sla AS sla_met FROM limits""",
    "column_profile": f"""WITH raw_books AS (SELECT CASE WHEN p_size = 1 THEN ' ' ELSE '  ' || upper(p_name) || E'\\t' END AS title, author, lower(genre) AS genre,
          CASE WHEN isbn = 'Invalid' THEN 'INVALID' ELSE isbn END AS isbn, lower(series) AS series, nullif(recommended, '') AS recommended
          FROM books JOIN part USING (p_partkey, p_size)),
        profile AS (
        SELECT 'title' AS column_name, count(*) - count(title) AS missing, count(DISTINCT title) AS unique_values, count(*) AS n FROM raw_books
        UNION ALL SELECT 'author', count(*) - count(author), count(DISTINCT author), count(*) FROM raw_books
        UNION ALL SELECT 'genre', count(*) - count(genre), count(DISTINCT genre), count(*) FROM raw_books
        UNION ALL SELECT 'isbn', count(*) - count(isbn), count(DISTINCT isbn), count(*) FROM raw_books
        UNION ALL SELECT 'series', count(*) - count(series), count(DISTINCT series), count(*) FROM raw_books
        UNION ALL SELECT 'recommended', count(*) - count(recommended), count(DISTINCT recommended), count(*) FROM raw_books)
        SELECT column_name, missing AS missing_values, {r2("missing / n * 100")} AS percent_missing, unique_values,
          (SELECT count(*) FROM raw_books) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_books)) AS duplicate_rows FROM profile""",
    "document_profile": f"""WITH profile AS (
        SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS missing, count(DISTINCT doc_id) AS unique_values, count(*) AS n FROM documents
        UNION ALL SELECT 'text' AS column_name, count(*) - count(text) AS missing, count(DISTINCT text) AS unique_values, count(*) AS n FROM documents
        UNION ALL SELECT 'lang' AS column_name, count(*) - count(lang) AS missing, count(DISTINCT lang) AS unique_values, count(*) AS n FROM documents
        UNION ALL SELECT 'source' AS column_name, count(*) - count(source) AS missing, count(DISTINCT source) AS unique_values, count(*) AS n FROM documents
        UNION ALL SELECT 'n_chars' AS column_name, count(*) - count(n_chars) AS missing, count(DISTINCT n_chars) AS unique_values, count(*) AS n FROM documents)
        SELECT column_name, missing AS missing_values, {r2("missing / n * 100")} AS percent_missing, unique_values,
          (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents)) AS duplicate_rows
        FROM profile""",
    "duplicate_values": "SELECT text, count(*) AS frequency FROM documents GROUP BY text HAVING count(*) > 1",
    "duplicate_id_check": """SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_ids, count(*) - count(DISTINCT order_id)
        AS surplus_rows FROM raw_orders""",
    "null_counts": """SELECT CAST(0 AS BIGINT) AS title, CAST(0 AS BIGINT) AS author, CAST(0 AS BIGINT) AS genre, CAST(0 AS BIGINT) AS isbn,
        count(*) - count(series) AS series, count(*) FILTER (WHERE recommended = '') AS recommended FROM books""",
    "column_summary": f"""SELECT 'balance' AS column_name, count(c_acctbal) AS value_count, {r2("avg(c_acctbal)", 4)} AS mean_value,
        {r2("stddev_samp(c_acctbal)", 4)} AS stddev_value, min(c_acctbal) AS min_value, max(c_acctbal) AS max_value FROM customer
        UNION ALL SELECT 'c_nationkey', count(c_nationkey), {r2("avg(c_nationkey)", 4)}, {r2("stddev_samp(c_nationkey)", 4)},
        CAST(min(c_nationkey) AS DOUBLE), CAST(max(c_nationkey) AS DOUBLE) FROM customer""",
    "bookstore_dates": """SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date, CAST(year(full_date) AS INT) AS year_number,
        CAST(month(full_date) AS INT) AS month_number, CAST(day(full_date) AS INT) AS day_number FROM (SELECT CAST(unnest(generate_series(
        min(TRY_CAST(order_date AS DATE)), max(TRY_CAST(order_date AS DATE)), INTERVAL 1 DAY)) AS DATE) AS full_date FROM raw_orders)""",
}

# A twin that opens its own WITH is nested, so that the roles stay visible to it.
ORACLES = {
    name: ROLES_SQL + (f"SELECT * FROM ({sql})" if sql.lstrip().startswith("WITH") else sql) for name, sql in _SQL.items()
}
