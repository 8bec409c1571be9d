"""Snapshot, feed and dump runs over an embedded database in this process."""

import datetime as dt
import json
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymark.csv_dialects import PLAIN
from daymark.plans import dated_feed
from daymark.plans.dated_feed import run_dated_feed
from daymark.plans.snapshot import Database, run_snapshot
from daymark.plans.table_dump import dump_all
from daymark.queries.inputs import database, scratch
from daymark.sinks import append_table, load_table, overwrite_table
from daymark.sources import FEED_SCHEMA, TableSpec, discover_tables, read_parquet, read_table


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def db(spark):
    named = database(spark)
    return Database(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", named.properties)


def feed_frame(spark, *pairs):
    return spark.createDataFrame([(dt.date.fromisoformat(d), p) for d, p in pairs], FEED_SCHEMA)


D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


# ---------------------------------------------------------------- JDBC reads and writes


def test_partitioned_read_is_whole(spark, db):
    df = spark.range(1000).select(F.expr("if(id % 100 = 0, null, id * 7)").alias("k"), F.col("id").alias("v"))
    overwrite_table(df, db.url, "t", db.properties)
    plain = read_table(spark, db.url, "t", db.properties)
    cut = read_table(spark, db.url, "t", db.properties, partition_by="k", num_partitions=4)
    assert plain.rdd.getNumPartitions() == 1 and cut.rdd.getNumPartitions() == 4
    assert rows(cut) == rows(plain) == rows(df)
    by_hand = read_table(
        spark, db.url, "t", db.properties, predicates=['MOD("v", 3) = 0', 'MOD("v", 3) <> 0']
    )
    assert by_hand.rdd.getNumPartitions() == 2 and rows(by_hand) == rows(df)
    overwrite_table(df.limit(0), db.url, "nothing", db.properties)
    assert read_table(spark, db.url, "nothing", db.properties, partition_by="k").count() == 0


def test_filters_and_columns_reach_the_database(spark, db):
    overwrite_table(spark.range(10).withColumn("v", F.col("id") * 2), db.url, "t", db.properties)
    df = read_table(spark, db.url, "t", db.properties).filter("id > 7").select("v")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,7)" in plan and "ReadSchema: struct<v:bigint>" in plan


def test_overwrite_append_and_truncate(spark, db):
    df = spark.range(5).toDF("v")
    assert overwrite_table(df, db.url, "t", db.properties) == 5
    assert append_table(df, db.url, "t", db.properties) == 5
    assert read_table(spark, db.url, "t", db.properties).count() == 10
    assert overwrite_table(df, db.url, "t", db.properties, truncate=True) == 5
    assert read_table(spark, db.url, "t", db.properties).count() == 5


def test_discovery(spark, db):
    for name in ("b_one", "b_two"):
        overwrite_table(spark.range(1), db.url, name, db.properties)
    assert rows(discover_tables(spark, db.url, db.properties)) == Counter([("B_ONE",), ("B_TWO",)])


def test_load_is_repeatable_and_slices_by_date(spark, db):
    first = feed_frame(spark, (D1, 1), (D1, 1), (D2, 2))
    for _ in range(2):
        assert load_table(first, db.url, "t", db.properties, "date", [D1, D2]) == 3
    load_table(feed_frame(spark, (D2, 5)), db.url, "t", db.properties, "date", [D2])
    load_table(feed_frame(spark, (D3, 6)), db.url, "t", db.properties, "date", [D3])
    day = dt.date.fromisoformat
    kept = read_table(spark, db.url, "t", db.properties)
    assert rows(kept) == Counter({(day(D1), 1): 2, (day(D2), 5): 1, (day(D3), 6): 1})
    assert load_table(feed_frame(spark), db.url, "t", db.properties, "date", [D3]) == 0
    assert kept.count() == 3
    assert load_table(feed_frame(spark, (D1, 8)), db.url, "t", db.properties) == 1
    assert rows(read_table(spark, db.url, "t", db.properties)) == Counter([(day(D1), 8)])
    assert rows(discover_tables(spark, db.url, db.properties)) == Counter([("T",)])


def test_rows_of_a_task_that_commits_twice_are_there_once(spark, db, monkeypatch):
    from daymark.sinks import relational

    plain, calls = relational.observed, []

    def commit_some_twice(df, write):
        seen = plain(df, write)
        calls.append(seen["rows"])
        if len(calls) == 1:
            again = df.filter(F.spark_partition_id() == 0)
            again.write.jdbc(db.url, "t_stage", mode="append", properties=dict(db.properties))
        return seen

    monkeypatch.setattr(relational, "observed", commit_some_twice)
    df = spark.range(0, 40, 1, 4).select((F.col("id") % 10).alias("v"))
    assert load_table(df, db.url, "t", db.properties) == 40
    assert calls == [40, 40]
    assert rows(read_table(spark, db.url, "t", db.properties)) == rows(df)


def test_table_that_stays_wrong_is_reported(spark, db, monkeypatch):
    from daymark.sinks import relational

    monkeypatch.setattr(relational, "observed", lambda df, write: (write(df), {"rows": 7})[1])
    with pytest.raises(RuntimeError, match="3 rows after 3 attempts to write 7"):
        overwrite_table(spark.range(3), db.url, "t", db.properties)


def test_direct_append(spark, db):
    for _ in range(2):
        assert append_table(spark.range(3), db.url, "t", db.properties, staged=False) == 3
    assert read_table(spark, db.url, "t", db.properties).count() == 6


def test_declared_warehouse_types(spark, db, tmp_path):
    overwrite_table(spark.range(3).selectExpr("id", "'n' AS name"), db.url, "t", db.properties)
    spec = TableSpec("t", column_types="name VARCHAR(40)")
    run_snapshot(spark, db, [spec], D1, str(tmp_path / "b"), str(tmp_path / "s"), db, "dwh_")
    # The default type, CLOB, cannot be compared by this database.
    distinct = '(SELECT DISTINCT "name" FROM dwh_t) d'
    assert rows(spark.read.jdbc(db.url, distinct, properties=dict(db.properties))) == Counter([("n",)])


def test_failed_load_leaves_the_table_alone(spark, db):
    load_table(spark.range(3), db.url, "t", db.properties)
    with pytest.raises(Exception):
        load_table(spark.range(3).toDF("other"), db.url, "t", db.properties)
    assert rows(read_table(spark, db.url, "t", db.properties)) == Counter([(0,), (1,), (2,)])


# ---------------------------------------------------------------- snapshot run


@pytest.fixture
def shop(spark, db):
    clients = spark.createDataFrame(
        [(1, "Ann", None), (1, "Ann", None), (2, 'B "b", c', ""), (3, "two\nlines", " x ")],
        "id bigint, name string, note string",
    )
    orders = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1, 1, 2, 3, 123000 + i)) for i in range(20)], "id bigint, at timestamp_ntz"
    )
    overwrite_table(clients, db.url, "clients", db.properties)
    overwrite_table(orders, db.url, "orders", db.properties)
    return {"clients": clients, "orders": orders}, [
        TableSpec("clients", schema=clients.schema, partition_by="id", dedupe=True),
        TableSpec("orders", schema=orders.schema, partition_by="id"),
    ]


def test_snapshot_run_is_repeatable(spark, db, shop, tmp_path):
    frames, specs = shop
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for _ in range(2):
        counts = run_snapshot(spark, db, specs, D1, bronze, silver, db, "dwh_")
        assert (counts["clients"].bronze, counts["clients"].silver, counts["clients"].warehouse) == (4, 3, 3)
        assert (counts["orders"].bronze, counts["orders"].silver, counts["orders"].warehouse) == (20, 20, 20)
    assert os.path.isdir(f"{bronze}/{D1}/clients.csv")
    for name in ("clients", "orders"):
        expected = rows(frames[name].distinct())
        assert rows(read_parquet(spark, f"{silver}/{name}")) == expected
        assert rows(read_table(spark, db.url, f"dwh_{name}", db.properties)) == expected
    assert read_parquet(spark, f"{silver}/orders").dtypes == frames["orders"].dtypes


def test_snapshot_without_schema_is_text(spark, db, shop, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    counts = run_snapshot(spark, db, [TableSpec("orders")], D1, bronze, silver)
    assert counts["orders"].warehouse is None
    assert read_parquet(spark, f"{silver}/orders").dtypes == [("id", "string"), ("at", "string")]


def test_older_headerless_form(spark, db, tmp_path):
    source = spark.range(4).selectExpr("id % 2 AS id", "'n' AS name").repartition(2)
    overwrite_table(source, db.url, "clients", db.properties)
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    spec = TableSpec("clients", dedupe=True)
    run_snapshot(spark, db, [spec], D1, bronze, silver, dialect=PLAIN, header=False)
    assert rows(read_parquet(spark, f"{silver}/clients")) == Counter([("id", "name"), ("0", "n"), ("1", "n")])


# ---------------------------------------------------------------- dated feed run


def test_feed_run_is_repeatable(spark, db, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    feed = feed_frame(spark, (D1, 1), (D1, 1), (D2, 2))

    def run(rows_of_day, dates):
        return run_dated_feed(spark, rows_of_day, dates, bronze, silver, db, "oos")

    for _ in range(2):
        counts = run(feed, [D1, D2, D3])
        assert (counts.bronze, counts.silver, counts.rejected, counts.warehouse) == (3, 3, 0, 3)
    day = dt.date.fromisoformat
    expected = Counter({(day(D1), 1): 2, (day(D2), 2): 1})
    read = lambda: rows(read_table(spark, db.url, "oos", db.properties).select("date", "product_id"))
    assert read() == expected
    # A late correction of one date leaves the other as it is.
    assert run(feed_frame(spark, (D2, 7), (D2, 8), (D3, 1)), D2).warehouse == 2
    assert read() == Counter({(day(D1), 1): 2, (day(D2), 7): 1, (day(D2), 8): 1})
    # A date without feed changes nothing.
    assert run(feed, D3).warehouse == 0
    assert read() == Counter({(day(D1), 1): 2, (day(D2), 7): 1, (day(D2), 8): 1})


def test_error_body_is_counted_and_kept_out(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for day, body in {D1: [{"date": D1, "product_id": 4}], D2: {"message": "failed"}}.items():
        os.makedirs(f"{bronze}/date={day}")
        with open(f"{bronze}/date={day}/body.json", "w") as f:
            json.dump(body, f)
    assert dated_feed.refine(spark, bronze, silver, [D1, D2]) == (1, 1)
    assert rows(read_parquet(spark, silver).select("date", "product_id")) == Counter([(dt.date(2024, 1, 1), 4)])


def test_a_rerun_replaces_its_dates(spark, db, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def run(*pairs, dates=(D1, D2)):
        return run_dated_feed(spark, feed_frame(spark, *pairs), list(dates), bronze, silver, db, "oos")

    def stored():
        kept = rows(read_parquet(spark, silver).select("date", "product_id"))
        assert rows(read_table(spark, db.url, "oos", db.properties).select("date", "product_id")) == kept
        return kept

    day = dt.date.fromisoformat
    assert run((D1, 1), (D1, 2), (D2, 3)).silver == 3
    # Day one has no records any more; day three was never run and is not touched.
    run((D3, 9), dates=(D3,))
    counts = run((D2, 4))
    assert (counts.bronze, counts.silver, counts.warehouse) == (1, 1, 1)
    assert stored() == Counter([(day(D2), 4), (day(D3), 9)])
    # Day two has only a rejected record.
    feed = spark.createDataFrame([(day(D2), None)], "date date, product_id int")
    counts = run_dated_feed(spark, feed, [D1, D2], bronze, silver, db, "oos")
    assert (counts.bronze, counts.silver, counts.rejected, counts.warehouse) == (1, 0, 1, 0)
    assert stored() == Counter([(day(D3), 9)])


def test_records_without_a_date_are_rejected_and_counted(spark, tmp_path):
    from daymark.queries.inputs import all_dates

    feed = spark.createDataFrame(
        [(None, None), (None, 7), (dt.date.fromisoformat(D1), 1)], "date date, product_id int"
    )
    assert all_dates(feed) == [D1]
    counts = run_dated_feed(spark, feed, D1, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert (counts.bronze, counts.silver, counts.rejected) == (1, 1, 2)


def test_append_mode_and_full_history_repeat_rows(spark, db, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    feed = feed_frame(spark, (D1, 1), (D2, 2))
    for day in (D1, D2):
        dated_feed.land(feed, bronze, day)
        assert dated_feed.refine(spark, bronze, silver, day, mode="append") == (1, 0)
        dated_feed.load(spark, silver, db, "oos", day, full_history=True)
    # Day one arrives with both runs, day two with the second.
    assert read_table(spark, db.url, "oos", db.properties).count() == 3
    dated_feed.refine(spark, bronze, silver, D1, mode="append")
    assert read_parquet(spark, silver).count() == 3


# ---------------------------------------------------------------- dump


def test_dump_of_all_and_of_a_list(spark, db, shop, tmp_path):
    root = str(tmp_path)
    assert dump_all(spark, db, root, D1) == {"clients": 4, "orders": 20}
    assert os.path.isdir(f"{root}/{D1}/orders.csv")
    assert dump_all(spark, db, root, D1, tables=["orders"], layout="ymd") == {"orders": 20}
    assert os.path.isdir(f"{root}/orders/year=2024/month=01/day=01")


def test_dump_keeps_tables_apart(spark, db, tmp_path):
    options = {**db.properties}
    for name, n in (('"Users"', 3), ('"users"', 5), ('"order"', 2)):
        spark.range(n).withColumn("year", F.lit(1999)).write.jdbc(db.url, name, properties=options)
    with pytest.raises(ValueError, match="one path"):
        dump_all(spark, db, str(tmp_path), D1)
    # A reserved word as a name, and a column named like a directory level.
    assert dump_all(spark, db, str(tmp_path), D1, prefix="ord", layout="ymd") == {"er": 2}
    got = spark.read.csv(f"{tmp_path}/er/year=2024/month=01/day=01", header=True)
    assert rows(got.select("year")) == Counter({("1999",): 2})


def test_layouts_refuse_to_hide_columns(spark, tmp_path):
    from daymark.sinks import write_by_day, write_by_run_date

    frame = spark.range(2).withColumn("ds", F.lit("x")).withColumn("Year", F.lit(1))
    with pytest.raises(ValueError, match="ds"):
        write_by_run_date(frame, str(tmp_path), F.lit(D1))
    with pytest.raises(ValueError, match="year"):
        write_by_day(frame, str(tmp_path), F.lit(D1))


def test_a_table_listed_twice_is_refused(spark):
    from daymark.sources import for_each_table

    with pytest.raises(ValueError, match="twice"):
        for_each_table(["a", "a"], lambda n: n)


# ---------------------------------------------------------------- sessions without a database


def test_runs_go_through_every_zone_without_a_database(spark, sf_dir, monkeypatch):
    from daymark.queries import QUERIES, flows

    def no_database(spark):
        raise AssertionError("the runs need none")

    monkeypatch.setattr(flows, "database", no_database)
    for name in ("pipe_snapshot", "pipe_dated_feed"):
        assert QUERIES[name](spark, sf_dir).count() > 0
    found = {r.table_name: r for r in QUERIES["pipe_snapshot"](spark, sf_dir).collect()}
    assert all(r.silver_content == r.warehouse_content and r.silver_rows == r.warehouse_rows for r in found.values())


def test_named_database_is_used(spark):
    spark.conf.set("spark.daymark.jdbc.url", "jdbc:x:y")
    spark.conf.set("spark.daymark.jdbc.user", "someone")
    try:
        named = database(spark)
        assert named.url == "jdbc:x:y" and named.properties["user"] == "someone"
    finally:
        spark.conf.unset("spark.daymark.jdbc.url")
        spark.conf.unset("spark.daymark.jdbc.user")


# ---------------------------------------------------------------- scratch


def test_scratch_is_in_the_shared_folder(spark):
    a, b = scratch(spark, "x"), scratch(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir")) and os.path.isdir(a)


def test_cluster_session_needs_shared_folder_and_database():
    from types import SimpleNamespace

    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="spark://host:7077"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(bare, "x")
    with pytest.raises(RuntimeError, match="spark.daymark.jdbc.url"):
        database(bare)
