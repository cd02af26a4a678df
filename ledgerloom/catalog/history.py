"""Facts against the version of their day, and histories from states in any order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum
from ..operators.ordered import as_of, history
from ..session import tune
from . import Query, dsum, table

#: Priorities that open a new version of a customer's tier.
TIERS = ("1-URGENT", "2-HIGH")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(tune(spark), folder, "orders")
    return orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority", "o_orderstatus", "o_totalprice")


def asof_holder_version(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the tier its customer held on that day."""
    orders = _orders(spark, folder)
    versions = orders.where(F.col("o_orderpriority").isin(*TIERS)).select(
        "o_custkey", F.col("day").alias("tier_since"), F.col("o_orderpriority").alias("tier"), F.col("o_orderkey").alias("version_id")
    )
    facts = orders.select("o_orderkey", "o_custkey", "day")
    return as_of(facts, versions, "o_custkey", "day", "tier_since", ["tier", "tier_since", "version_id"], ["version_id"])


def asof_tier_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and revenue by the tier that was valid on the order's day, not the current one."""
    prices = _orders(spark, folder).select("o_orderkey", "o_totalprice")
    tiers = asof_holder_version(spark, folder).join(prices, "o_orderkey")
    return tiers.groupBy(F.coalesce("tier", F.lit("none")).alias("tier")).agg(F.count("*").alias("orders"), exact_sum("o_totalprice").alias("revenue"))


def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' versions of priority and status, from all orders as states."""
    return history(_orders(spark, folder), "o_custkey", "day", ["o_orderpriority", "o_orderstatus"], ["o_orderkey"])


QUERIES: dict[str, Query] = {
    "asof_holder_version": asof_holder_version,
    "asof_tier_revenue": asof_tier_revenue,
    "scd2_history": scd2_history,
}

_VERSIONS = """versions AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS tier_since, arg_max(o_orderpriority, o_orderkey) AS tier, max(o_orderkey) AS version_id
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL
), facts AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders),
joined AS (
  SELECT f.*, v.tier, v.tier_since, v.version_id FROM facts f
  ASOF LEFT JOIN versions v ON f.o_custkey = v.o_custkey AND f.day >= v.tier_since
)"""

ORACLES: dict[str, str] = {
    "asof_holder_version": f"WITH {_VERSIONS} SELECT o_orderkey, o_custkey, day, tier, tier_since, version_id FROM joined",
    "asof_tier_revenue": f"""WITH {_VERSIONS} SELECT coalesce(tier, 'none') AS tier, count(*) AS orders, {dsum("o_totalprice")} AS revenue
        FROM joined GROUP BY 1""",
    "scd2_history": """WITH single AS (
          SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority,
            arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY ALL
        ), marked AS (
          SELECT *, lag(o_orderpriority) OVER w AS p, lag(o_orderstatus) OVER w AS s, row_number() OVER w AS place FROM single
          WINDOW w AS (PARTITION BY o_custkey ORDER BY day)
        ), changed AS (
          SELECT * FROM marked WHERE place = 1 OR p IS DISTINCT FROM o_orderpriority OR s IS DISTINCT FROM o_orderstatus
        ), ended AS (SELECT *, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS following FROM changed)
        SELECT o_custkey, day, o_orderpriority, o_orderstatus, CAST(following - INTERVAL 1 DAY AS DATE) AS valid_to, following IS NULL AS is_current
        FROM ended""",
}
