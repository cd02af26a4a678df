"""Retail queries: stores are suppliers, products are parts, sales are line items."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import at_least
from ..operators.cleaning import add_constant_column
from ..operators.daystates import DayPartitions
from ..plans import retail
from ..session import stage_folder, tune
from ..sources.writers import replace_period, table_row_counts
from . import Query, table


class Roles:
    """The retail frames over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.read = lambda name: table(spark, folder, name)

    @property
    def customers(self) -> DataFrame:
        joined = self.read("customer").join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.col("n_name").alias("state"),
            at_least("c_acctbal", [(5000, 1), (0, 0)], None).alias("loyalty_member"),
        )

    @property
    def stores(self) -> DataFrame:
        joined = self.read("supplier").join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("store_state")
        )

    @property
    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("unit_price"),
        )

    @property
    def sales(self) -> DataFrame:
        joined = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
        )

    @property
    def store_sales(self) -> DataFrame:
        """Sales without the columns that live on the order; saves that join."""
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
            F.col("l_suppkey").alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"),
        )

    @property
    def feed(self) -> DataFrame:
        """One wide staging feed, with the loyalty flag as text."""
        wide = (
            self.sales.join(self.products, "product_id").join(self.stores, "store_id").join(self.customers, "customer_id")
        )
        return wide.withColumn("loyalty_member", F.coalesce(F.col("loyalty_member").cast("string"), F.lit("")))


ROLES_SQL = """
WITH customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         n_name AS state, CASE WHEN c_acctbal >= 5000 THEN 1 WHEN c_acctbal >= 0 THEN 0 END AS loyalty_member
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS store_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS unit_price FROM part),
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id, o_custkey AS customer_id, l_suppkey AS store_id,
         l_partkey AS product_id, CAST(o_orderdate AS DATE) AS sale_date, CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""

RANGE = (date(1997, 1, 1), date(1997, 12, 31))


PERIOD = "period"


def _by_periods(r: Roles) -> tuple[SparkSession, str]:
    """Where the sums of all quarters are stored: the third quarters come late and one quarter is loaded wrong first."""
    quarter = (F.year("sale_date") * 10 + F.quarter("sale_date")).alias(PERIOD)
    sales = r.sales.select("*", quarter)
    spark = sales.sparkSession
    place = f"{stage_folder(spark)}/sales-by-period-{uuid.uuid4().hex}"
    quarters = DayPartitions(spark, f"{place}/sales", PERIOD, sales.schema)
    late, wrong = F.col(PERIOD) % 10 == 3, F.col(PERIOD) == 19962

    def load(rows: DataFrame) -> None:
        replace_period(rows.hint("rebalance", PERIOD), quarters.path, [PERIOD])
        retail.refresh_sales_states(quarters, f"{place}/states", r.products, r.stores)

    doubled = F.when(wrong, F.col("total_amount") * 2).otherwise(F.col("total_amount")).cast("decimal(12,2)")
    load(sales.where(~late).withColumn("total_amount", doubled))
    load(sales.where(late | wrong))
    return spark, f"{place}/states"


def _query(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, folder: build(Roles(tune(spark), folder))


QUERIES: dict[str, Query] = {
    name: _query(build)
    for name, build in {
        "sales_report": lambda r: retail.sales_report(r.products, r.stores, r.sales),
        "sales_report_by_periods": lambda r: retail.sales_report_from_states(*_by_periods(r), PERIOD),
        "monthly_sales_by_periods": lambda r: retail.monthly_sales_from_states(*_by_periods(r), PERIOD),
        "sales_count_by_category": lambda r: retail.sales_count_by_category(r.products, r.store_sales),
        "premium_member_count": lambda r: retail.premium_members(r.customers, r.sales, 2_000_000).agg(
            F.count("*").alias("record_count")
        ),
        "premium_members": lambda r: retail.first_by_id(retail.premium_members(r.customers, r.sales, 2_000_000), "customer_id"),
        "mass_update": lambda r: retail.promote_premium_members(r.customers, r.sales, 2_000_000),
        "sales_by_store": lambda r: retail.sales_by_store(r.stores, r.store_sales),
        "top5_customers": lambda r: retail.top_customers(r.customers, r.sales),
        "top5_customers_by_bounds": lambda r: retail.top_customers_by_bounds(r.customers, r.sales),
        "avg_sale_by_loyalty": lambda r: retail.avg_sale_by_loyalty(r.customers, r.sales),
        "best_store_by_avg": lambda r: retail.best_store_by_avg(r.stores, r.store_sales),
        "sales_over_amount": lambda r: retail.sales_over_amount(r.products, r.stores, r.sales),
        "quantity_by_store_state": lambda r: retail.quantity_by_store_state(r.stores, r.store_sales),
        "top3_categories": lambda r: retail.top_categories(r.products, r.store_sales),
        "multi_state_customers": lambda r: retail.multi_state_customers(r.customers, r.stores, r.sales),
        "monthly_sales": lambda r: retail.monthly_sales(r.sales),
        "best_month": lambda r: retail.best_month(r.sales),
        "customer_purchases_view": lambda r: retail.customer_purchases(r.customers, r.products, r.sales),
        "sales_by_date_range": lambda r: retail.sales_by_date_range(r.sales, *RANGE).withColumn(
            "total_amount", F.col("total_amount").cast("double")
        ),
        "split_flat_feed_customers": lambda r: retail.split_flat_feed(r.feed)["customers"],
        "split_flat_feed_stores": lambda r: retail.split_flat_feed(r.feed)["stores"],
        "split_flat_feed_products": lambda r: retail.split_flat_feed(r.feed)["products"],
        "split_flat_feed_sales": lambda r: retail.split_flat_feed(r.feed)["sales"].withColumn(
            "total_amount", F.col("total_amount").cast("double")
        ),
        "add_constant_column": lambda r: add_constant_column(r.products, "discount", 0, "decimal(10,2)").withColumn(
            "discount", F.col("discount").cast("double")
        ),
        "select_distinct": lambda r: r.stores.select("store_state").distinct(),
        "table_row_counts": lambda r: table_row_counts(
            {"customers": r.customers, "stores": r.stores, "products": r.products, "sales": r.sales}
        ),
    }.items()
}

_SQL = {
    "sales_report": """SELECT category, store_state, CAST(year(sale_date) AS INT) AS sale_year,
        CAST(sum(total_amount) AS DOUBLE) AS total_sales_amount, CAST(sum(quantity) AS BIGINT) AS total_quantity
        FROM sales JOIN products USING (product_id) JOIN stores USING (store_id) GROUP BY ALL""",
    "sales_count_by_category": """SELECT category, count(sale_id) AS sale_count
        FROM products JOIN sales USING (product_id) GROUP BY category""",
    "premium_member_count": """SELECT count(*) AS record_count FROM (SELECT customer_id FROM customers
        JOIN sales USING (customer_id) GROUP BY customer_id HAVING sum(total_amount) > 2000000)""",
    "premium_members": """SELECT customer_id, first_name, last_name FROM customers WHERE customer_id IN
        (SELECT customer_id FROM sales GROUP BY customer_id HAVING sum(total_amount) > 2000000)
        ORDER BY customer_id LIMIT 5""",
    "mass_update": """SELECT customer_id, first_name, last_name, state, CASE WHEN customer_id IN
        (SELECT customer_id FROM sales GROUP BY customer_id HAVING sum(total_amount) > 2000000)
        THEN 1 ELSE loyalty_member END AS loyalty_member FROM customers""",
    "sales_by_store": """SELECT store_name, CAST(sum(total_amount) AS DOUBLE) AS total_sales
        FROM stores JOIN sales USING (store_id) GROUP BY store_name""",
    "top5_customers": """SELECT customer_id, first_name, last_name, CAST(sum(total_amount) AS DOUBLE) AS total_purchases
        FROM customers JOIN sales USING (customer_id) GROUP BY ALL ORDER BY total_purchases DESC, customer_id LIMIT 5""",
    "avg_sale_by_loyalty": """SELECT loyalty_member, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_sale_amount
        FROM customers JOIN sales USING (customer_id) GROUP BY loyalty_member""",
    "best_store_by_avg": """SELECT store_name, CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_sale_amount
        FROM stores JOIN sales USING (store_id) GROUP BY store_name ORDER BY avg_sale_amount DESC, store_name LIMIT 1""",
    "sales_over_amount": """SELECT sale_id, customer_id, product_name, store_name, CAST(total_amount AS DOUBLE) AS total_amount
        FROM sales JOIN products USING (product_id) JOIN stores USING (store_id) WHERE total_amount > 500""",
    "quantity_by_store_state": """SELECT store_state, CAST(sum(quantity) AS BIGINT) AS total_quantity
        FROM stores JOIN sales USING (store_id) GROUP BY store_state""",
    "top3_categories": """SELECT category, CAST(sum(total_amount) AS DOUBLE) AS total_sales
        FROM products JOIN sales USING (product_id) GROUP BY category ORDER BY total_sales DESC, category LIMIT 3""",
    "multi_state_customers": """SELECT customer_id, first_name, last_name, count(DISTINCT store_state) AS state_count
        FROM customers JOIN sales USING (customer_id) JOIN stores USING (store_id) GROUP BY ALL
        HAVING count(DISTINCT store_state) > 1""",
    "monthly_sales": """SELECT CAST(year(sale_date) AS INT) AS sale_year, CAST(month(sale_date) AS INT) AS sale_month,
        CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales GROUP BY ALL""",
    "best_month": """SELECT CAST(year(sale_date) AS INT) AS sale_year, CAST(month(sale_date) AS INT) AS sale_month,
        CAST(sum(total_amount) AS DOUBLE) AS total_sales FROM sales GROUP BY ALL
        ORDER BY total_sales DESC, sale_year, sale_month LIMIT 1""",
    "customer_purchases_view": """SELECT customer_id, first_name, last_name, state, loyalty_member, sale_id, store_id,
        sale_date, quantity, CAST(total_amount AS DOUBLE) AS total_amount, product_id, product_name, category, unit_price
        FROM customers JOIN sales USING (customer_id) JOIN products USING (product_id)""",
    "sales_by_date_range": """SELECT sale_id, customer_id, store_id, product_id, sale_date, quantity,
        CAST(total_amount AS DOUBLE) AS total_amount FROM sales
        WHERE sale_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
    "split_flat_feed_customers": """SELECT DISTINCT customer_id, first_name, last_name, state, loyalty_member FROM sales
        JOIN customers USING (customer_id) JOIN products USING (product_id) JOIN stores USING (store_id)""",
    "split_flat_feed_stores": """SELECT DISTINCT store_id, store_name, store_state FROM sales
        JOIN customers USING (customer_id) JOIN products USING (product_id) JOIN stores USING (store_id)""",
    "split_flat_feed_products": """SELECT DISTINCT product_id, product_name, category, unit_price FROM sales
        JOIN customers USING (customer_id) JOIN products USING (product_id) JOIN stores USING (store_id)""",
    "split_flat_feed_sales": """SELECT sale_id, customer_id, store_id, product_id, sale_date, quantity,
        CAST(total_amount AS DOUBLE) AS total_amount FROM sales
        JOIN customers USING (customer_id) JOIN products USING (product_id) JOIN stores USING (store_id)""",
    "add_constant_column": "SELECT *, CAST(0 AS DOUBLE) AS discount FROM products",
    "select_distinct": "SELECT DISTINCT store_state FROM stores",
    "table_row_counts": """SELECT 'customers' AS table_name, count(*) AS row_count FROM customers
        UNION ALL SELECT 'stores', count(*) FROM stores UNION ALL SELECT 'products', count(*) FROM products
        UNION ALL SELECT 'sales', count(*) FROM sales""",
}

_SQL["top5_customers_by_bounds"] = _SQL["top5_customers"]
_SQL["sales_report_by_periods"] = _SQL["sales_report"]
_SQL["monthly_sales_by_periods"] = _SQL["monthly_sales"]
ORACLES = {name: ROLES_SQL + sql for name, sql in _SQL.items()}
