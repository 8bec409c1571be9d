"""Projection, filter, join, aggregation, window, sort and scalar queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.functions import (
    bucket_label,
    contains_text,
    date_parts,
    full_name,
    interval_day,
    interval_hour,
    starts_with_any_case,
    value_or_null,
    whole_hours,
)
from daymark.operators import (
    Hop,
    ascending,
    best_per_group,
    carry_totals,
    chain,
    count_by_condition,
    count_distinct_by,
    descending,
    drop_duplicate_rows,
    grouped_for_join,
    rank_at_most,
    through_bridge,
    top_n,
    unmatched,
    with_rank,
)
from daymark.queries.inputs import feed, scratch, table
from daymark.sinks import land_json_by_date
from daymark.sources import read_landed_feed

QUERIES = {}
ORACLES = {}


def _query(sql: str):
    """Register a query under its function name, with its SQL counterpart."""

    def register(run):
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql
        return run

    return register


# ---------------------------------------------------------------- frames and fragments


def _suppliers(spark, sf_dir) -> DataFrame:
    """Suppliers with their nation: (s_suppkey, s_name, s_nationkey, n_name)."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return supplier.join(nation, "s_nationkey")


def _lines_per_supplier(spark, sf_dir) -> DataFrame:
    """(s_suppkey, n_lines)."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.count("l_orderkey").alias("n_lines"))
    )


def _since_first(spark, sf_dir) -> DataFrame:
    """Events with the first timestamp of their user."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    first = grouped_for_join(events, "user_id", F.min("ts").alias("first_ts"))
    return events.join(first, "user_id")


_SINCE_FIRST = """(SELECT e.*, f.first_ts FROM events AS e JOIN
    (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id) AS f ON f.user_id = e.user_id)"""

_BUCKET = """CASE WHEN p_name ILIKE 'B%' THEN 'start_w_b'
                 WHEN p_name LIKE '%ring%' THEN 'contains_ring' ELSE 'other' END"""


def _part_bucket():
    return bucket_label(
        [
            (starts_with_any_case("p_name", "B"), "start_w_b"),
            (contains_text("p_name", "ring"), "contains_ring"),
        ],
        "other",
    )


def _quantity_per_bucket_and_type(spark, sf_dir) -> DataFrame:
    """(bucket, p_type, n_lines): lines per part are summed before parts are looked up."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.struct(_part_bucket().alias("bucket"), "p_type").alias("kind")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", F.lit(1).cast("bigint").alias("n_lines"))
    totals = carry_totals(lines, "n_lines", [Hop(parts, "l_partkey", "kind")])
    return totals.select("kind.bucket", "kind.p_type", "n_lines")


_LINES_PER_BUCKET = f"""(SELECT {_BUCKET} AS bucket, p_type, count(*) AS n_lines
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)"""


# ---------------------------------------------------------------- projections and filters


@_query("""SELECT o.o_orderkey, c.c_name, o.o_orderpriority
           FROM orders AS o JOIN customer AS c ON c.c_custkey = o.o_custkey""")
def prj_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders").alias("o"), table(spark, sf_dir, "customer").alias("c")
    joined = o.join(c, F.col("c.c_custkey") == F.col("o.o_custkey"))
    return joined.select("o.o_orderkey", "c.c_name", "o.o_orderpriority")


@_query("""SELECT a.p_partkey AS part_id, a.p_type AS "Category" FROM part AS a""")
def prj_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "part").alias("a")
    return a.select(F.col("a.p_partkey").alias("part_id"), F.col("a.p_type").alias("Category"))


@_query("SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO'")
def flt_eq_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO").select("p_partkey", "p_name")


@_query("""SELECT d.doc_id, d.lang FROM documents AS d LEFT JOIN labels AS l ON l.doc_id = d.doc_id
           WHERE l.quality IS NULL""")
def flt_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return documents.join(labels, "doc_id", "left").filter(F.col("quality").isNull()).select("doc_id", "lang")


@_query("""SELECT n_name, s_name, n_lines, r FROM (
             SELECT n_name, s_name, n_lines, rank() OVER (PARTITION BY n_name ORDER BY n_lines DESC) AS r
             FROM (SELECT n_name, s_name, count(*) AS n_lines FROM lineitem
                   JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
                   GROUP BY n_name, s_name)) WHERE r <= 2""")
def flt_compare_le(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines_per_supplier(spark, sf_dir).join(_suppliers(spark, sf_dir), "s_suppkey")
    counts = lines.groupBy("n_name", "s_name").agg(F.sum("n_lines").alias("n_lines"))
    return rank_at_most(counts, "n_lines", 2, partition="n_name").select("n_name", "s_name", "n_lines", "r")


@_query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR p_name LIKE 'blue%'")
def flt_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return (
        table(spark, sf_dir, "part")
        .filter(name.contains("ring") | name.startswith("blue"))
        .select("p_partkey", "p_name")
    )


@_query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'B%'")
def flt_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(starts_with_any_case("p_name", "B"))
        .select("p_partkey", "p_name")
    )


@_query("""SELECT p_partkey, p_name, p_type FROM part
           WHERE p_name ILIKE 'R%' AND p_type = 'PROMO' OR p_name LIKE '%bolt%'""")
def flt_and_or_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixed = starts_with_any_case("p_name", "R") & (F.col("p_type") == "PROMO")
    return (
        table(spark, sf_dir, "part")
        .filter(prefixed | contains_text("p_name", "bolt"))
        .select("p_partkey", "p_name", "p_type")
    )


@_query(f"SELECT p_partkey, {_BUCKET} AS bucket FROM part")
def prj_case_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", _part_bucket().alias("bucket"))


@_query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE NULL END AS finished_for
           FROM orders""")
def prj_case_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = value_or_null(F.col("o_orderstatus") == "F", "o_custkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", finished.alias("finished_for"))


@_query("""SELECT a.o_custkey, a.n_orders FROM
             (SELECT o_custkey, count(o_orderkey) AS n_orders FROM orders GROUP BY o_custkey) AS a
           WHERE a.n_orders <= 8""")
def sub_derived_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n_orders"))
    return per_customer.filter(F.col("n_orders") <= 8)


@_query("""SELECT CAST(ts AS DATE) AS date, CAST(user_id AS INTEGER) AS product_id FROM events
           WHERE CAST(ts AS DATE) IN (DATE '2023-12-31', DATE '2024-01-05', DATE '2024-03-01')""")
def flt_missing_date_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = f"{scratch(spark, 'missing')}/feed", feed(spark, sf_dir)
    land_json_by_date(rows, path)
    return read_landed_feed(spark, path, ["2023-12-31", "2024-01-05", "2024-03-01"])


# ---------------------------------------------------------------- joins


@_query("""SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey""")
def join_inner_equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("c_custkey") == F.col("o_custkey"), "inner")
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@_query("""SELECT p_brand, s_name, count(*) AS n_links FROM part JOIN lineitem ON l_partkey = p_partkey
           JOIN supplier ON s_suppkey = l_suppkey GROUP BY p_brand, s_name""")
def join_bridge_m2n(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    linked = through_bridge(parts, bridge, suppliers, "p_partkey", "s_suppkey")
    return linked.groupBy("p_brand", "s_name").agg(F.count(F.lit(1)).alias("n_links"))


@_query("""SELECT r.r_name AS customer_region, sn.n_name AS supplier_nation, p_type, count(*) AS n_lines
           FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
           JOIN nation AS sn ON sn.n_nationkey = s_nationkey JOIN orders ON o_orderkey = l_orderkey
           JOIN customer ON c_custkey = o_custkey JOIN nation AS cn ON cn.n_nationkey = c_nationkey
           JOIN region AS r ON r.r_regionkey = cn.n_regionkey GROUP BY 1, 2, 3""")
def join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_orderkey").alias("o_orderkey"),
    )
    nation = table(spark, sf_dir, "nation")
    joined = chain(
        lines,
        (table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey"),
        (table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey"),
        (
            nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation")),
            "s_nationkey",
        ),
        (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey"),
        (
            table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"),
            "o_custkey",
        ),
        (nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey"),
        (
            table(spark, sf_dir, "region").select(
                F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("customer_region")
            ),
            "n_regionkey",
        ),
    )
    return joined.groupBy("customer_region", "supplier_nation", "p_type").agg(F.count(F.lit(1)).alias("n_lines"))


@_query("""SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def join_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The branch of dimensions is joined on its own, so the fact is moved once.
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    places = chain(table(spark, sf_dir, "customer"), (nation, "c_nationkey"), (region, "n_regionkey"))
    located = places.select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name", "r_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(located, "o_custkey").select("o_orderkey", "c_name", "n_name", "r_name")


@_query("""SELECT o_orderkey, n_lines FROM orders LEFT JOIN
             (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey)
           ON l_orderkey = o_orderkey""")
def join_left_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")


@_query("""SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
           WHERE l_orderkey IS NULL""")
def join_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return unmatched(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines, "o_orderkey")


# ---------------------------------------------------------------- aggregations


@_query("SELECT l_suppkey, count(l_orderkey) AS n_lines FROM lineitem GROUP BY l_suppkey")
def agg_count_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("l_orderkey").alias("n_lines"))


@_query("SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey")
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_distinct_by(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_orderkey", "n_orders")


@_query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
           FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_sum_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(amount.alias("amount"))


@_query(f"""SELECT event_type, CAST(sum(date_part('day', ts - first_ts) * 24
             + date_part('hour', ts - first_ts)) AS BIGINT) AS hours FROM {_SINCE_FIRST} GROUP BY event_type""")
def agg_sum_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = _since_first(spark, sf_dir)
    return spans.groupBy("event_type").agg(F.sum(whole_hours("ts", "first_ts")).alias("hours"))


@_query("""SELECT o_custkey, count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS n_finished,
             count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS n_open
           FROM orders GROUP BY o_custkey""")
def agg_count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    conditions = {"n_finished": status == "F", "n_open": status == "O"}
    return count_by_condition(table(spark, sf_dir, "orders"), "o_custkey", conditions, "o_orderkey")


@_query("""SELECT o_orderstatus, o_orderpriority, count(o_orderkey) AS n_orders FROM orders
           GROUP BY 1, 2""")
def agg_group_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT o_orderstatus, o_orderpriority, count(o_orderkey) AS n_orders
           FROM {orders} GROUP BY 1, 2""",
        orders=table(spark, sf_dir, "orders"),
    )


@_query(f"""SELECT {_BUCKET} AS bucket, concat(p_brand, ' ', p_type) AS label, count(*) AS n_parts
            FROM part GROUP BY 1, 2""")
def agg_group_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = full_name("p_brand", "p_type").alias("label")
    return (
        table(spark, sf_dir, "part")
        .groupBy(_part_bucket().alias("bucket"), label)
        .agg(F.count(F.lit(1)).alias("n_parts"))
    )


@_query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def agg_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


# ---------------------------------------------------------------- windows


@_query("""SELECT l_suppkey, count(*) AS n_lines, rank() OVER (ORDER BY count(*) DESC) AS r
           FROM lineitem GROUP BY l_suppkey""")
def win_rank_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _lines_per_supplier(spark, sf_dir).withColumnRenamed("s_suppkey", "l_suppkey")
    return with_rank(counts, "n_lines")


@_query(f"""SELECT bucket, p_type, n_lines,
              CAST(row_number() OVER (PARTITION BY bucket ORDER BY n_lines DESC, p_type) AS INTEGER) AS rn
            FROM {_LINES_PER_BUCKET}""")
def win_row_number_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The window orders part types within a bucket: a fixed vocabulary, not rows.
    w = Window.partitionBy("bucket").orderBy(descending("n_lines"), ascending("p_type"))
    return _quantity_per_bucket_and_type(spark, sf_dir).withColumn("rn", F.row_number().over(w))


@_query("""SELECT c_mktsegment, c_nationkey, count(*) AS n_customers,
             CAST(rank() OVER (PARTITION BY c_mktsegment ORDER BY count(*) DESC) AS INTEGER) AS r
           FROM customer GROUP BY c_mktsegment, c_nationkey""")
def win_over_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per segment and nation reaches the window.
    counts = (
        table(spark, sf_dir, "customer")
        .groupBy("c_mktsegment", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )
    w = Window.partitionBy("c_mktsegment").orderBy(descending("n_customers"))
    return counts.withColumn("r", F.rank().over(w))


@_query("""SELECT o_custkey, n_orders, r FROM (
             SELECT o_custkey, count(*) AS n_orders, rank() OVER (ORDER BY count(*) DESC) AS r
             FROM orders GROUP BY o_custkey) WHERE r <= 3""")
def win_topk_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return rank_at_most(counts, "n_orders", 3)


@_query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (
             SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
             FROM orders) WHERE rn = 1""")
def win_argmax_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return best_per_group(orders, "o_custkey", [descending("o_totalprice")], tie_break=["o_orderkey"])


# ---------------------------------------------------------------- sort and top-n


@_query("SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def ord_desc_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The key as last sort column lets the range shuffle cut runs of equal counts.
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.orderBy(descending("n_orders"), "o_custkey")


@_query("""SELECT c_custkey, c_mktsegment, c_nationkey FROM customer
           ORDER BY 3 DESC, 2, 1""")
def ord_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return customers.orderBy(descending("c_nationkey"), ascending("c_mktsegment"), "c_custkey")


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY 2 DESC, 1 LIMIT 10")
def ord_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_n(orders, [descending("o_totalprice")], 10, tie_break=["o_orderkey"])


@_query("""SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def ord_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _lines_per_supplier(spark, sf_dir).withColumnRenamed("s_suppkey", "l_suppkey")
    return top_n(counts, [descending("n_lines")], 1, tie_break=["l_suppkey"])


# ---------------------------------------------------------------- scalar functions


@_query("""SELECT s_suppkey, concat(s_name, ' ', n_name) AS full_name FROM supplier
           JOIN nation ON n_nationkey = s_nationkey""")
def fn_concat_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).select("s_suppkey", full_name("s_name", "n_name").alias("full_name"))


@_query(f"""SELECT event_id, CAST(epoch_us(ts) - epoch_us(first_ts) AS BIGINT) AS elapsed_us FROM {_SINCE_FIRST}""")
def fn_ts_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The interval itself has no type both engines share; compare it in microseconds.
    iv = F.col("ts") - F.col("first_ts")
    seconds = interval_day(iv) * 86400 + interval_hour(iv) * 3600 + F.date_part(F.lit("minute"), iv) * 60
    micros = (F.date_part(F.lit("second"), iv) * 1_000_000).cast("bigint")
    return _since_first(spark, sf_dir).select(
        "event_id", (seconds.cast("bigint") * 1_000_000 + micros).alias("elapsed_us")
    )


@_query(f"SELECT event_id, CAST(date_part('day', ts - first_ts) AS INTEGER) AS days FROM {_SINCE_FIRST}")
def fn_interval_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = interval_day(F.col("ts") - F.col("first_ts"))
    return _since_first(spark, sf_dir).select("event_id", days.alias("days"))


@_query(f"SELECT event_id, CAST(date_part('hour', ts - first_ts) AS INTEGER) AS hours FROM {_SINCE_FIRST}")
def fn_interval_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = interval_hour(F.col("ts") - F.col("first_ts")).cast("int")
    return _since_first(spark, sf_dir).select("event_id", hours.alias("hours"))


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_part('day', l_shipdate - o_orderdate) * 24
             + date_part('hour', l_shipdate - o_orderdate) AS BIGINT) AS hours
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def fn_whole_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", whole_hours("l_shipdate", "o_orderdate").alias("hours")
    )


@_query("""SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
             strftime(ts, '%d') AS day FROM events""")
def fn_date_parts_fmt(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        "event_id", *[c.alias(n) for n, c in date_parts(iso).items()]
    )
