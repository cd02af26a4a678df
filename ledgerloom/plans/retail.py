"""Retail sales reports.

Frames: ``customers`` (customer_id, first_name, last_name, state, loyalty_member), ``stores``
(store_id, store_name, store_state), ``products`` (product_id, product_name, category,
unit_price) and ``sales`` (sale_id, customer_id, store_id, product_id, sale_date, quantity,
total_amount). Where a report needs one dimension, sales are summed per foreign key before they meet it, so the join sees
one row per key and a popular product or store costs no more than any other. ``sales_report`` and
``multi_state_customers`` need several at once and join single sales; skewed keys are left to AQE.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conditions import case_bucket
from ..functions.numbers import ratio
from ..operators.daystates import DayPartitions, DayStates
from ..operators.dimensions import flag_members
from ..operators.topk import top_by_sum


def _per_key(sales: DataFrame, key: str) -> DataFrame:
    return sales.groupBy(key).agg(
        F.count("sale_id").alias("sale_count"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amount_count"),
        F.sum("quantity").alias("quantity"),
    )


def split_flat_feed(staging: DataFrame) -> dict[str, DataFrame]:
    """Derive customers, stores, products and sales from one wide feed.

    Loyalty text '1' and '0' become 1 and 0, anything else NULL.
    """
    loyalty = case_bucket([(F.col("loyalty_member") == "1", 1), (F.col("loyalty_member") == "0", 0)])
    return {
        "customers": staging.select(
            "customer_id", "first_name", "last_name", "state", loyalty.alias("loyalty_member")
        ).distinct(),
        "stores": staging.select("store_id", "store_name", "store_state").distinct(),
        "products": staging.select("product_id", "product_name", "category", "unit_price").distinct(),
        "sales": staging.select(
            "sale_id", "customer_id", "store_id", "product_id", "sale_date", "quantity", "total_amount"
        ),
    }


def sales_count_by_category(products: DataFrame, sales: DataFrame) -> DataFrame:
    joined = _per_key(sales, "product_id").join(products, "product_id")
    return joined.groupBy("category").agg(F.sum("sale_count").alias("sale_count"))


def premium_members(customers: DataFrame, sales: DataFrame, min_spend: float = 1000) -> DataFrame:
    """Customers whose total spend is above ``min_spend``, one row each."""
    spend = sales.groupBy("customer_id").agg(F.sum("total_amount").alias("amount"))
    big = spend.where(F.col("amount") > min_spend)
    return customers.select("customer_id", "first_name", "last_name").join(big, "customer_id", "left_semi")


def promote_premium_members(customers: DataFrame, sales: DataFrame, min_spend: float = 1000) -> DataFrame:
    """All customers, with the loyalty flag set for premium members."""
    members = premium_members(customers, sales, min_spend)
    return flag_members(customers, members, "customer_id", {"loyalty_member": F.lit(1)})


def first_by_id(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    return df.orderBy(key).limit(rows)


def sales_by_store(stores: DataFrame, sales: DataFrame) -> DataFrame:
    joined = _per_key(sales, "store_id").join(stores, "store_id")
    return joined.groupBy("store_name").agg(F.sum("amount").cast("double").alias("total_sales"))


def top_customers(customers: DataFrame, sales: DataFrame, rows: int = 5) -> DataFrame:
    """Biggest spenders, by customer id."""
    joined = _per_key(sales, "customer_id").join(customers, "customer_id")
    return (
        joined.select("customer_id", "first_name", "last_name", F.col("amount").cast("double").alias("total_purchases"))
        .orderBy(F.desc("total_purchases"), "customer_id")
        .limit(rows)
    )


def top_customers_by_bounds(customers: DataFrame, sales: DataFrame, rows: int = 5) -> DataFrame:
    """``top_customers``, summing only customers that bounds leave in question. Sales of unknown customers don't count."""
    known = sales.join(customers.select("customer_id"), "customer_id", "left_semi")
    best = top_by_sum(known, "customer_id", "total_amount", "amount", rows).rows
    return (
        best.join(customers, "customer_id")
        .select("customer_id", "first_name", "last_name", F.col("amount").cast("double").alias("total_purchases"))
        .orderBy(F.desc("total_purchases"), "customer_id")
    )


def _average() -> Column:
    return ratio(F.sum("amount"), F.sum("amount_count"))


def avg_sale_by_loyalty(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Average sale per loyalty flag; customers without a flag form their own group."""
    joined = _per_key(sales, "customer_id").join(customers, "customer_id")
    return joined.groupBy("loyalty_member").agg(_average().alias("avg_sale_amount"))


def best_store_by_avg(stores: DataFrame, sales: DataFrame) -> DataFrame:
    joined = _per_key(sales, "store_id").join(stores, "store_id")
    averages = joined.groupBy("store_name").agg(_average().alias("avg_sale_amount"))
    return averages.orderBy(F.desc("avg_sale_amount"), "store_name").limit(1)


def sales_over_amount(products: DataFrame, stores: DataFrame, sales: DataFrame, min_amount: float = 500) -> DataFrame:
    """Single sales above an amount, with product and store names."""
    big = sales.where(F.col("total_amount") > min_amount)
    return (
        big.join(products.select("product_id", "product_name"), "product_id")
        .join(stores.select("store_id", "store_name"), "store_id")
        .select(
            "sale_id", "customer_id", "product_name", "store_name", F.col("total_amount").cast("double").alias("total_amount")
        )
    )


def quantity_by_store_state(stores: DataFrame, sales: DataFrame) -> DataFrame:
    joined = _per_key(sales, "store_id").join(stores, "store_id")
    return joined.groupBy("store_state").agg(F.sum("quantity").alias("total_quantity"))


def top_categories(products: DataFrame, sales: DataFrame, rows: int = 3) -> DataFrame:
    joined = _per_key(sales, "product_id").join(products, "product_id")
    totals = joined.groupBy("category").agg(F.sum("amount").cast("double").alias("total_sales"))
    return totals.orderBy(F.desc("total_sales"), "category").limit(rows)


def multi_state_customers(customers: DataFrame, stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Customers who bought in more than one store state."""
    visited = sales.select("customer_id", "store_id").join(stores.select("store_id", "store_state"), "store_id")
    states = visited.groupBy("customer_id").agg(F.countDistinct("store_state").alias("state_count"))
    return (
        states.where("state_count > 1")
        .join(customers, "customer_id")
        .select("customer_id", "first_name", "last_name", "state_count")
    )


def monthly_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month")).agg(
        F.sum("total_amount").cast("double").alias("total_sales")
    )


def best_month(sales: DataFrame) -> DataFrame:
    return monthly_sales(sales).orderBy(F.desc("total_sales"), "sale_year", "sale_month").limit(1)


def customer_purchases(customers: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Every sale with its customer's and its product's attributes."""
    bought = sales.join(products, "product_id").join(customers, "customer_id")
    return bought.select(
        *customers.columns,
        "sale_id",
        "store_id",
        "sale_date",
        "quantity",
        F.col("total_amount").cast("double").alias("total_amount"),
        *products.columns,
    )


def sales_by_date_range(sales: DataFrame, start: date, end: date) -> DataFrame:
    return sales.where(F.col("sale_date").between(F.lit(start), F.lit(end)))


def sales_report(products: DataFrame, stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Amount and quantity per category, store state and year."""
    joined = sales.join(products.select("product_id", "category"), "product_id").join(
        stores.select("store_id", "store_state"), "store_id"
    )
    return joined.groupBy("category", "store_state", F.year("sale_date").alias("sale_year")).agg(
        F.sum("total_amount").cast("double").alias("total_sales_amount"), F.sum("quantity").alias("total_quantity")
    )


def _sales_states(period: str, products: DataFrame | None = None, stores: DataFrame | None = None, version: str = "") -> DayStates:
    amount, quantity = F.sum("total_amount").alias("amount"), F.sum("quantity").alias("quantity")
    year, month = F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month")

    def cells(sales: DataFrame) -> DataFrame:
        joined = sales.join(products.select("product_id", "category"), "product_id")
        joined = joined.join(stores.select("store_id", "store_state"), "store_id")
        return joined.groupBy(period, "category", "store_state", year).agg(amount, quantity)

    return DayStates({"cells": cells, "months": lambda sales: sales.groupBy(period, year, month).agg(amount)}, version)


def refresh_sales_states(sales: DayPartitions, store: str, products: DataFrame, stores: DataFrame, version: str = "") -> list[str]:
    """Bring the partial sums of the periods of ``sales`` up to date; returns the partitions that were read.

    A period that was loaded again has its sums replaced, one that is gone loses them, so a corrected or withdrawn load is taken
    back without reading other periods. Sums hold the categories and states of the time they were made: give another
    ``version`` whenever ``products`` or ``stores`` change, and all periods are made anew.
    """
    return _sales_states(sales.day, products, stores, version).refresh(sales, store)


def sales_report_from_states(spark: SparkSession, store: str, period: str) -> DataFrame:
    """``sales_report`` from the periods' sums; the sales are not read."""
    cells = _sales_states(period).read(spark, store)["cells"]
    return cells.groupBy("category", "store_state", "sale_year").agg(
        F.sum("amount").cast("double").alias("total_sales_amount"), F.sum("quantity").alias("total_quantity")
    )


def monthly_sales_from_states(spark: SparkSession, store: str, period: str) -> DataFrame:
    """``monthly_sales`` from the periods' sums."""
    months = _sales_states(period).read(spark, store)["months"]
    return months.groupBy("sale_year", "sale_month").agg(F.sum("amount").cast("double").alias("total_sales"))
