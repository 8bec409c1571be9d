"""The seven reports over the given tables.

Parts play the films, suppliers with their nation the actors, nations the categories and
cities, line items the links between them and the payments, orders the rentals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions import bucket_label, contains_text, full_name, starts_with_any_case
from daymark.operators import Hop, chain, count_distinct_by
from daymark.plans import report_shapes as shapes
from daymark.queries.inputs import table


def _nation(spark, sf_dir, key: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key), "n_name", *more)


def _lines(spark, sf_dir, **columns: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*[F.col(c).alias(a) for a, c in columns.items()])


def _by_people(spark, sf_dir, lines: DataFrame, event: str) -> DataFrame:
    """Lines with the name of their supplier: (full_name, event)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    named = chain(lines, (supplier, "s_suppkey"), (_nation(spark, sf_dir, "s_nationkey"), "s_nationkey"))
    return named.select(full_name("s_name", "n_name").alias("full_name"), event)


def rep_count_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shapes.items_per_label(
        table(spark, sf_dir, "part"),
        _lines(spark, sf_dir, p_partkey="l_partkey", s_suppkey="l_suppkey"),
        [
            Hop(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey"),
            Hop(_nation(spark, sf_dir, "s_nationkey"), "s_nationkey", "n_name"),
        ],
        item="p_partkey",
        label_as="cat",
        count_as="f_cnt",
    )


def rep_top10_distinct_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken_part = chain(
        _lines(spark, sf_dir, o_orderkey="l_orderkey", s_suppkey="l_suppkey"),
        (table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey"),
    )
    named = _by_people(spark, sf_dir, taken_part, "o_orderkey")
    counts = count_distinct_by(named, "full_name", "o_orderkey", "rent_cnt", few_repeats=True)
    return shapes.busiest_people(counts, "full_name", "rent_cnt", 10)


def rep_top1_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")
    )
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    top = shapes.highest_total_label(
        payments,
        "amount",
        [
            Hop(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey"),
            Hop(customer, "o_custkey", "c_nationkey"),
            Hop(_nation(spark, sf_dir, "c_nationkey", "n_regionkey"), "c_nationkey", "n_regionkey"),
            Hop(region, "n_regionkey", "r_name"),
        ],
        label_as="name",
        total_as="revenue",
    )
    return top.select("name", F.col("revenue").cast("double").alias("revenue"))


def rep_never_stocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("title")
    )
    return shapes.titles_without_stock(
        orders, _lines(spark, sf_dir, o_orderkey="l_orderkey"), "o_orderkey", "title"
    )


def rep_rank3_in_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    promoted = table(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO").select("p_partkey", "p_name")
    taken_part = chain(
        _lines(spark, sf_dir, p_partkey="l_partkey", s_suppkey="l_suppkey"), (promoted, "p_partkey")
    )
    named = _by_people(spark, sf_dir, taken_part, "p_name")
    counts = count_distinct_by(named, "full_name", "p_name", "f_cnt")
    return shapes.people_in_top_ranks(counts, "full_name", "f_cnt", 3)


def rep_active_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    status = F.col("o_orderstatus")
    return shapes.conditional_counts_per_label(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        "o_orderkey",
        {"cnt_active": status == "F", "cnt_inactive": status == "O"},
        [
            Hop(customer, "o_custkey", "c_nationkey"),
            Hop(_nation(spark, sf_dir, "c_nationkey"), "c_nationkey", "n_name"),
        ],
        label_as="city",
        order_by="cnt_inactive",
    )


def rep_bucket_argmax_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixed, ring = starts_with_any_case("p_name", "B"), contains_text("p_name", "ring")
    label = bucket_label([(prefixed, "start_w_b"), (ring, "contains_ring")], "other")
    parts = (
        table(spark, sf_dir, "part")
        .filter(prefixed | ring)
        .select("p_partkey", label.alias("city_group"), F.col("p_type").alias("Category"))
    )
    lines = _lines(
        spark, sf_dir, p_partkey="l_partkey", o_orderkey="l_orderkey", l_shipdate="l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # Parts first: only lines of parts in a bucket go on to meet their orders.
    spans = chain(lines, (parts, "p_partkey"), (orders, "o_orderkey"))
    hours = shapes.hours_of(spans, "l_shipdate", "o_orderdate", "rent_hours")
    return shapes.busiest_label_per_bucket(hours, "city_group", "Category", "rent_hours")


QUERIES = {
    "rep_count_by_category": rep_count_by_category,
    "rep_top10_distinct_rentals": rep_top10_distinct_rentals,
    "rep_top1_revenue": rep_top1_revenue,
    "rep_never_stocked": rep_never_stocked,
    "rep_rank3_in_category": rep_rank3_in_category,
    "rep_active_inactive": rep_active_inactive,
    "rep_bucket_argmax_hours": rep_bucket_argmax_hours,
}

ORACLES = {
    "rep_count_by_category": """
        SELECT n_name AS cat, count(p_partkey) AS f_cnt FROM part
        JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey GROUP BY 1 ORDER BY 2 DESC, 1""",
    "rep_top10_distinct_rentals": """
        SELECT concat(s_name, ' ', n_name) AS full_name, count(DISTINCT o_orderkey) AS rent_cnt
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "rep_top1_revenue": """
        SELECT r_name AS name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "rep_never_stocked": """
        SELECT o_orderpriority AS title FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
        WHERE l_orderkey IS NULL""",
    "rep_rank3_in_category": """
        WITH counts AS (
          SELECT concat(s_name, ' ', n_name) AS full_name, count(DISTINCT p_name) AS f_cnt
          FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey
          JOIN nation ON n_nationkey = s_nationkey WHERE p_type = 'PROMO' GROUP BY 1),
        third AS (SELECT min(f_cnt) AS least FROM (SELECT f_cnt FROM counts ORDER BY f_cnt DESC LIMIT 3))
        SELECT full_name, f_cnt FROM counts, third WHERE f_cnt >= least""",
    "rep_active_inactive": """
        SELECT n_name AS city, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS cnt_active,
               count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS cnt_inactive
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY 1 ORDER BY 3 DESC, 1""",
    "rep_bucket_argmax_hours": """
        WITH bucket AS (
          SELECT p_partkey, p_type, 'start_w_b' AS city_group FROM part WHERE p_name ILIKE 'B%'
          UNION ALL SELECT p_partkey, p_type, 'contains_ring' FROM part WHERE p_name LIKE '%ring%' AND p_name NOT ILIKE 'B%'),
        totals AS (
          SELECT city_group, p_type, CAST(sum(24 * date_part('day', l_shipdate - o_orderdate)
                   + date_part('hour', l_shipdate - o_orderdate)) AS BIGINT) AS rent_hours
          FROM bucket JOIN lineitem ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY city_group ORDER BY rent_hours DESC, p_type) AS place FROM totals)
        SELECT city_group, p_type AS "Category", rent_hours FROM placed WHERE place = 1""",
}
