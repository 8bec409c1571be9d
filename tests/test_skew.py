"""The queries over tables in which one key holds a third of the rows, against SQL.

Every join is shuffled and partitions count as skewed early, so the split paths run.
"""

import duckdb
import pytest

from daymark.queries import ORACLES, QUERIES
from daymark.queries.inputs import SCHEMAS
from tests.test_parity import _rows

HOT = {
    "lineitem": """SELECT * REPLACE (
        CASE WHEN hash(l_linenumber, l_partkey) % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN hash(l_orderkey) % 3 = 0 THEN 2 ELSE l_partkey END AS l_partkey,
        CASE WHEN hash(l_shipdate) % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey) FROM src""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM src",
    "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END AS c_nationkey) FROM src",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 1 THEN ts - to_days(dayofmonth(ts)::INTEGER - 9) ELSE ts END AS ts) FROM src""",
}
# A database table per query would only repeat test_parity.
NAMES = sorted(n for n in QUERIES if "jdbc" not in n and not n.startswith("pipe_") and n not in ("src_catalog_discovery", "snk_table_dump_csv"))


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
        query = HOT.get(name, "SELECT * FROM src")
        con.execute(f"COPY ({query}) TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 4096)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64KB",
        "spark.sql.files.openCostInBytes": "16KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield str(folder), con
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, name):
    folder, con = skewed
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, folder)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, want.fetchall())


@pytest.mark.parametrize(
    "name",
    ["rep_count_by_category", "rep_top10_distinct_rentals", "rep_rank3_in_category", "rep_bucket_argmax_hours",
     "join_inner_equi", "join_bridge_m2n", "join_chain", "join_snowflake", "agg_sum_expr", "fn_whole_hours"],
)
def test_hot_key_is_split(spark, skewed, name):
    folder, _ = skewed
    df = QUERIES[name](spark, folder)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan
