"""The relational and scalar building blocks, one query each, on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions.conditions import at_least, case_bucket, flag
from ..functions.numbers import cap, exact_avg, exact_sum, percent, ratio, round_to, sum_where, zscore
from ..functions.text import strip
from ..operators.aggregates import distinct_counts, exact_quantiles, with_share
from ..operators.dimensions import date_rows
from ..operators.keys import first_per_key, keys_without_match
from ..session import stage_table, tune
from . import Query, davg, dsum, r2, table

AS_OF = date(2001, 12, 31)


class Tables:
    """The given tables by name."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._read = lambda name: table(spark, folder, name)

    def __getattr__(self, name: str) -> DataFrame:
        return self._read(name)


def _order_days(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


def _quantiles(t: Tables) -> DataFrame:
    prices = stage_table(t.orders.select("o_totalprice"), "order-prices")
    found = exact_quantiles(prices, "o_totalprice", [0.5, 0.7, 0.9, 0.95], scale=2)
    return prices.agg(
        F.count("*").alias("orders"), *[F.lit(v).cast("double").alias(f"p{n}") for n, v in zip((50, 70, 90, 95), found)]
    )


def _segments(t: Tables) -> DataFrame:
    spend = stage_table(
        t.orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("spend"), F.count("*").alias("orders")), "spend"
    )
    medium, high = exact_quantiles(spend, "spend", [0.7, 0.9], scale=2)
    amount = F.col("spend").cast("decimal(18,2)")
    segment = case_bucket([(amount >= F.lit(high), "high"), (amount >= F.lit(medium), "medium")], "low")
    return spend.groupBy(segment.alias("segment")).agg(F.count("*").alias("customers"), F.sum("orders").alias("orders"))


_BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    # joins
    "join_inner": lambda t: t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    .groupBy("r_name", "o_orderstatus")
    .agg(F.count("*").alias("orders"), exact_sum("o_totalprice").alias("total")),
    "join_left_default": lambda t: t.customer.join(
        t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("events"), exact_avg("value").alias("avg_value")),
        "c_custkey",
        "left",
    )
    .fillna({"events": 0, "avg_value": 3.5})
    .select("c_custkey", "events", "avg_value"),
    "join_left_on_predicate": lambda t: t.part.alias("p").join(
        t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("returns")),
        "p_partkey",
        "left",
    ).select("p_partkey", "returns"),
    "join_left_anti": lambda t: t.customer.join(t.events.select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey"),
    "join_left_semi": lambda t: t.customer.join(
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).count().where("count >= 15"), "c_custkey", "left_semi"
    ).select("c_custkey", "c_name"),
    "join_orphan_count": lambda t: t.documents.groupBy("doc_id").count().join(t.labels.withColumn("known", F.lit(1)), "doc_id", "left").agg(
        F.sum("count").alias("documents"), F.sum(F.when(F.col("known").isNull(), F.col("count"))).alias("unlabelled")
    ),
    "key_set_difference": lambda t: keys_without_match(t.documents, t.labels, "doc_id"),
    "join_alias": lambda t: t.nation.alias("a").join(t.nation.alias("b"), F.col("a.n_regionkey") == F.col("b.n_nationkey")).select(
        F.col("a.n_name").alias("nation"), F.col("b.n_name").alias("namesake")
    ),
    # aggregates
    "group_by": lambda t: t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        exact_sum("l_extendedprice").alias("total"),
        exact_avg("l_extendedprice").alias("average"),
        F.max("l_extendedprice").alias("highest"),
        F.min("l_extendedprice").alias("lowest"),
    ),
    "count_distinct": lambda t: distinct_counts(t.lineitem, "l_returnflag", {"suppliers": "l_suppkey", "parts": "l_partkey"}),
    "conditional_sum": lambda t: t.orders.groupBy("o_orderpriority").agg(
        sum_where(F.col("o_orderstatus") == "F", "o_totalprice").alias("finished"),
        F.sum(flag(F.col("o_totalprice") > 250_000)).alias("large_orders"),
    ),
    "global_aggregate": lambda t: t.lineitem.agg(
        F.count("*").alias("n"), exact_sum("l_extendedprice").alias("total"), F.max("l_shipdate").cast("date").alias("last_day")
    ),
    "having": lambda t: t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")).where("orders >= 15"),
    "collect_list": lambda t: t.conversations.select("conv_id", "role").distinct().groupBy("conv_id").agg(
        F.array_join(F.sort_array(F.collect_list("role")), ",").alias("roles")
    ),
    "percent_of_total": lambda t: with_share(
        t.events.groupBy("event_type").agg(F.count("*").alias("events"), exact_sum("value").alias("total")), "total", "share"
    ),
    "ratio_of_aggregates": lambda t: t.lineitem.groupBy("l_linestatus").agg(
        ratio(F.sum(flag(F.col("l_returnflag") == "R")), F.count("*")).alias("return_rate"),
        percent(F.sum(flag(F.col("l_returnflag") == "N")), F.sum(flag(F.col("l_tax") > 1))).alias("undefined"),
    ),
    "quantiles": _quantiles,
    "quantile_segments": _segments,
    "standard_deviation": lambda t: t.lineitem.groupBy("l_returnflag").agg(round_to(F.stddev("l_quantity")).alias("sd")),
    # windows, sorting and set operations
    "row_number_first": lambda t: first_per_key(
        t.orders.select("o_custkey", "o_totalprice", "o_orderkey"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"]
    ),
    "order_by_rank": lambda t: t.orders.groupBy("o_orderpriority")
    .agg(F.count("*").alias("orders"))
    .orderBy(case_bucket([(F.col("o_orderpriority") == "1-URGENT", 1)], 2), F.desc("orders"), "o_orderpriority"),
    "top_k": lambda t: t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10),
    "union_all": lambda t: t.customer.select(F.col("c_name").alias("name"), F.lit("customer").alias("kind")).unionByName(
        t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"))
    ),
    "distinct": lambda t: t.documents.select("lang", "source").distinct(),
    # scalar families
    "case_bucket": lambda t: t.orders.groupBy(
        at_least("o_totalprice", [(400_000, "large"), (100_000, "medium")], "small").alias("size")
    ).agg(F.count("*").alias("orders")),
    "cap": lambda t: t.events.select("event_id", cap("value", 100.0).alias("capped")),
    "round_floor_zscore": lambda t: t.orders.select(
        "o_orderkey",
        round_to(F.col("o_totalprice") / 1000).alias("thousands"),
        F.floor(F.col("o_totalprice") / 1000).alias("whole_thousands"),
        zscore("o_totalprice", 5000, 10000).alias("z"),
    ),
    "string_functions": lambda t: t.part.select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.left("p_name", F.lit(3)).alias("first_three"),
        F.substring("p_name", 2, 4).alias("middle"),
        F.instr("p_name", " ").alias("space_at"),
        F.reverse("p_name").alias("reversed"),
        F.length("p_name").alias("name_length"),
        F.replace("p_name", F.lit("red"), F.lit("RED")).alias("replaced"),
        F.concat_ws("/", "p_brand", "p_type").alias("joined"),
        strip(F.concat(F.lit(" \t"), "p_name", F.lit("\n "))).alias("stripped"),
    ),
    "json_field": lambda t: t.events.select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("int"), F.lit(0)).alias("k")),
    "date_parts": lambda t: date_rows(_order_days(t).select("day").distinct(), "day"),
    "date_age_fraction": lambda t: _order_days(t).select("o_orderkey", d.years_since("day", AS_OF).alias("years")),
    "season": lambda t: _order_days(t).groupBy(d.season("day").alias("season")).agg(F.count("*").alias("orders")),
    "hour_of_day": lambda t: t.events.groupBy(F.hour("ts").alias("hour"), F.dayofweek("ts").alias("weekday")).agg(F.count("*").alias("events")),
    "fill_missing": lambda t: t.documents.join(t.labels, "doc_id", "left").fillna({"quality": -1, "toxic": 0}).groupBy("quality", "toxic").agg(
        F.count("*").alias("documents")
    ),
}


def _query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(Tables(tune(spark), folder))


QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDERS.items()}


def _disc(p: float, column: str) -> str:
    return f"CAST(min({column}) FILTER (WHERE cd >= {p}) AS DOUBLE)"


ORACLES = {
    "join_inner": f"""SELECT r_name, o_orderstatus, count(*) AS orders, {dsum("o_totalprice")} AS total FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "join_left_default": f"""SELECT c_custkey, coalesce(events, 0) AS events, coalesce(avg_value, 3.5) AS avg_value FROM customer LEFT JOIN
        (SELECT user_id, count(*) AS events, {davg("value")} AS avg_value FROM events GROUP BY user_id) ON c_custkey = user_id""",
    "join_left_on_predicate": """SELECT p_partkey, CASE WHEN count(l_partkey) > 0 THEN count(l_partkey) END AS returns FROM part
        LEFT JOIN lineitem ON p_partkey = l_partkey AND l_returnflag = 'R' GROUP BY p_partkey""",
    "join_left_anti": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)",
    "join_left_semi": """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey
        HAVING count(*) >= 15)""",
    "join_orphan_count": """SELECT count(*) AS documents, count(*) FILTER (WHERE l.doc_id IS NULL) AS unlabelled FROM documents d
        LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "key_set_difference": "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
    "join_alias": "SELECT a.n_name AS nation, b.n_name AS namesake FROM nation a JOIN nation b ON a.n_regionkey = b.n_nationkey",
    "group_by": f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {dsum("l_extendedprice")} AS total, {davg("l_extendedprice")} AS average,
        max(l_extendedprice) AS highest, min(l_extendedprice) AS lowest FROM lineitem GROUP BY ALL""",
    "count_distinct": "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL",
    "conditional_sum": f"""SELECT o_orderpriority, coalesce({dsum("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END")}, 0) AS finished,
        CAST(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) AS BIGINT) AS large_orders FROM orders GROUP BY ALL""",
    "global_aggregate": f"SELECT count(*) AS n, {dsum('l_extendedprice')} AS total, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem",
    "having": "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey HAVING count(*) >= 15",
    "collect_list": "SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY conv_id",
    "percent_of_total": f"""SELECT *, {r2("total / sum(total) OVER () * 100")} AS share FROM (SELECT event_type, count(*) AS events,
        {dsum("value")} AS total FROM events GROUP BY ALL)""",
    "ratio_of_aggregates": """SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS return_rate,
        CAST(NULL AS DOUBLE) AS undefined FROM lineitem GROUP BY ALL""",
    "quantiles": f"""SELECT count(*) AS orders, {_disc(0.5, "v")} AS p50, {_disc(0.7, "v")} AS p70, {_disc(0.9, "v")} AS p90, {_disc(0.95, "v")} AS p95
        FROM (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS v, cume_dist() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2))) AS cd FROM orders)""",
    "quantile_segments": """WITH spend AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v, count(*) AS orders FROM orders GROUP BY o_custkey),
        ranked AS (SELECT *, cume_dist() OVER (ORDER BY v) AS cd FROM spend),
        bounds AS (SELECT min(v) FILTER (WHERE cd >= 0.7) AS medium, min(v) FILTER (WHERE cd >= 0.9) AS high FROM ranked)
        SELECT CASE WHEN v >= high THEN 'high' WHEN v >= medium THEN 'medium' ELSE 'low' END AS segment, count(*) AS customers,
        CAST(sum(orders) AS BIGINT) AS orders FROM spend, bounds GROUP BY 1""",
    "standard_deviation": f"SELECT l_returnflag, {r2('stddev_samp(l_quantity)')} AS sd FROM lineitem GROUP BY ALL",
    "row_number_first": """SELECT o_custkey, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "order_by_rank": """SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority
        ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END, orders DESC, o_orderpriority""",
    "top_k": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "union_all": "SELECT c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier",
    "distinct": "SELECT DISTINCT lang, source FROM documents",
    "case_bucket": """SELECT CASE WHEN o_totalprice >= 400000 THEN 'large' WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'small' END AS size,
        count(*) AS orders FROM orders GROUP BY 1""",
    "cap": "SELECT event_id, least(value, 100) AS capped FROM events",
    "round_floor_zscore": f"""SELECT o_orderkey, {r2("o_totalprice / 1000")} AS thousands, CAST(floor(o_totalprice / 1000) AS BIGINT) AS whole_thousands,
        (o_totalprice - 5000) / 10000 AS z FROM orders""",
    "string_functions": """SELECT p_partkey, upper(p_name) AS upper_name, left(p_name, 3) AS first_three, substr(p_name, 2, 4) AS middle,
        CAST(instr(p_name, ' ') AS INT) AS space_at, reverse(p_name) AS reversed, CAST(length(p_name) AS INT) AS name_length,
        replace(p_name, 'red', 'RED') AS replaced, p_brand || '/' || p_type AS joined, p_name AS stripped FROM part""",
    "json_field": """SELECT event_id, coalesce(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INT), 0) AS k FROM events""",
    "date_parts": """SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, day AS full_date, CAST(year(day) AS INT) AS year_number,
        CAST(quarter(day) AS INT) AS quarter_number, CAST(month(day) AS INT) AS month_number, CAST(day(day) AS INT) AS day_number,
        CAST(isodow(day) - 1 AS INT) AS day_of_week, CAST(weekofyear(day) AS INT) AS week_of_year, dayname(day) AS day_name,
        monthname(day) AS month_name, isodow(day) >= 6 AS is_weekend, isodow(day) < 6 AS is_business_day, false AS is_holiday
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
    "date_age_fraction": "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') / 365.25::DOUBLE AS years FROM orders",
    "season": """SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
        WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season, count(*) AS orders FROM orders GROUP BY 1""",
    "hour_of_day": """SELECT CAST(hour(ts) AS INT) AS hour, CAST(dayofweek(ts) + 1 AS INT) AS weekday, count(*) AS events FROM events GROUP BY ALL""",
    "fill_missing": """SELECT coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic, count(*) AS documents FROM documents LEFT JOIN labels
        USING (doc_id) GROUP BY ALL""",
}
