"""Physical plans: what is pushed down, how hot keys are split, what is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from daymark.operators import Hop, best_per_group, carry_totals, descending, rank_at_most, unmatched, with_rank
from daymark.plans import rental_reports
from daymark.queries import QUERIES
from daymark.queries.inputs import feed
from daymark.sinks import upsert_dates
from daymark.sources import read_parquet
from daymark.sources.feed import on_dates


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture
def conf(spark):
    changed = []

    def set_(**pairs):
        for key, value in pairs.items():
            name = "spark.sql." + key.replace("__", ".")
            spark.conf.set(name, value)
            changed.append(name)

    yield set_
    for name in changed:
        spark.conf.unset(name)


@pytest.fixture
def splitting(conf):
    """Hot partitions count as such from 20 KB on, and nothing is broadcast."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__enabled="false",
    )


def hot(spark, n=200_000, key="k"):
    """A third of the rows on one key."""
    return spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias(key),
        F.col("id").alias("v"),
    )


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = initial_plan(QUERIES["rep_count_by_category"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan
    assert "ReadSchema: struct<p_partkey:bigint>" in plan
    promo = initial_plan(QUERIES["flt_eq_literal"](spark, sf_dir))
    assert "EqualTo(p_type,PROMO)" in promo


def test_dates_prune_directories(spark, tmp_path):
    path = str(tmp_path / "silver")
    upsert_dates(spark.sql("SELECT DATE'2024-01-01' + CAST(id AS INT) AS date, id FROM range(5)"), path)
    plan = initial_plan(on_dates(read_parquet(spark, path), ["2024-01-02"]))
    assert re.search(r"PartitionFilters: \[.*date#\d+ [>=]+ 2024-01-02", plan)


def test_dates_of_timestamps_reach_the_scan(spark, sf_dir):
    plan = initial_plan(on_dates(feed(spark, sf_dir), ["2024-01-02", "2024-01-09"]))
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00), LessThan(ts,2024-01-10T00:00)" in plan


def test_anti_join_is_direct(spark, sf_dir):
    plan = initial_plan(QUERIES["rep_never_stocked"](spark, sf_dir))
    assert "LeftAnti" in plan and "LeftOuter" not in plan


def test_best_row_is_limited_before_the_shuffle(spark):
    plan = initial_plan(best_per_group(hot(spark), "k", [descending("v")]))
    assert "WindowGroupLimit [k" in plan and "Partial" in plan.split("Exchange")[-1]


def test_global_rank_window_sees_values_not_rows(spark):
    counts = hot(spark).groupBy((F.col("v") % 700).alias("name")).agg(F.count("*").alias("n"))
    plan = final_plan(rank_at_most(counts, "n", 3))
    assert "TakeOrderedAndProject(limit=3" in plan and "Exchange SinglePartition" not in plan
    assert "ReusedExchange" in plan  # the counts are computed once
    # a window in one task sees a row for each range of values, never the values
    whole = initial_plan(with_rank(counts.withColumn("n", F.col("n") / 3), "n"))
    singles = [whole[m.start() :].split("\n")[1] for m in re.finditer("Exchange SinglePartition", whole)]
    assert singles and all("HashAggregate(keys=[n#" not in s for s in singles)


def test_unmatched_splits_a_hot_left_key(spark, splitting):
    right = hot(spark).filter("v % 2 = 0").filter("k <> 7")
    df = unmatched(hot(spark), right, "k").groupBy(F.col("v") % 10).count()
    assert "SortMergeJoin(skew=true)" in final_plan(df)


def test_carried_totals_split_a_hot_bridge_key(spark, splitting):
    facts = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("n"))
    df = carry_totals(facts, "n", [Hop(hot(spark), "k", "v", repeats=True)])
    total = df.agg(F.sum("n"), F.count("*")).first()
    assert tuple(total) == (200_000, 200_000)
    assert "SortMergeJoin(skew=true)" in final_plan(df)


def test_carried_totals_group_on_the_join_key(spark, splitting):
    dim = spark.range(5000).select(F.col("id").cast("int").alias("k"), (F.col("id") % 9).alias("g"))
    plan = initial_plan(carry_totals(hot(spark), "v", [Hop(dim, "k", "g")]))
    # One shuffle of the facts serves grouping and join; then the frame, then the result.
    assert plan.count("Exchange hashpartitioning") == 3
    before_join = plan.split("SortMergeJoin")[1]
    assert "partial_sum(v" in before_join


def test_actor_report_splits_a_hot_film(spark, splitting):
    n = 60_000
    rental = spark.range(n).select(F.col("id").alias("rental_id"), F.col("id").alias("inventory_id"))
    inventory = rental.select(
        "inventory_id", F.when(F.col("rental_id") % 3 == 0, 7).otherwise(F.col("rental_id") % 4000).alias("film_id")
    )
    film = spark.range(4000).toDF("film_id")
    film_actor = spark.range(8000).select((F.col("id") % 4000).alias("film_id"), (F.col("id") % 50).alias("actor_id"))
    actor = spark.range(50).select(
        F.col("id").alias("actor_id"), F.col("id").cast("string").alias("first_name"), F.lit("x").alias("last_name")
    )
    tables = dict(rental=rental, inventory=inventory, film=film, film_actor=film_actor, actor=actor)
    df = rental_reports.most_rented_actors(tables)
    expected = (
        rental.join(inventory, "inventory_id").join(film_actor, "film_id").join(actor, "actor_id")
        .groupBy(F.concat_ws(" ", "first_name", "last_name").alias("full_name"))
        .agg(F.count_distinct("rental_id").alias("rent_cnt"))
    )
    best = {tuple(r) for r in df.collect()}
    assert len(best) == 10 and best <= {tuple(r) for r in expected.collect()}
    assert "SortMergeJoin(skew=true) [film_id" in final_plan(df)


def test_first_events_split_a_hot_user(spark, sf_dir, splitting):
    from daymark.operators import grouped_for_join

    events = hot(spark)
    df = events.join(grouped_for_join(events, "k", F.min("v").alias("first")), "k")
    assert df.count() == 200_000
    assert "SortMergeJoin(skew=true)" in final_plan(df.groupBy(F.col("v") - F.col("first")).count())


def test_no_python_in_any_plan(spark, sf_dir):
    for name, run in QUERIES.items():
        if name.startswith(("src_", "snk_", "pipe_")):
            continue
        plan = initial_plan(run(spark, sf_dir))
        assert "Python" not in plan and "Pandas" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_pairs_that_rarely_repeat_are_shuffled_before_they_are_collapsed(spark, sf_dir):
    """No task holds the pairs of its share of a join, and tasks of the count grow with the input."""
    from daymark.operators import count_distinct_by
    from daymark.operators.sizes import tasks_by_input
    from daymark.queries import QUERIES

    rows = [("a", 1), ("a", 1), ("a", None), ("b", None), (None, 2), (None, 2), (None, 3), ("a", 2)]
    df = spark.createDataFrame(rows, "name string, value int")
    found = count_distinct_by(df, "name", "value", "n", few_repeats=True)
    assert sorted(found.collect(), key=str) == sorted(count_distinct_by(df, "name", "value", "n").collect(), key=str)
    assert {r.name: r.n for r in found.collect()} == {"a": 2, "b": 0, None: 2}

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    one = tasks_by_input(lines, 1000)
    assert one > 1 and tasks_by_input(lines.unionAll(lines), 1000) >= 2 * one - 1
    plan = QUERIES["rep_top10_distinct_rentals"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString().splitlines()
    shuffled = next(i for i, line in enumerate(plan) if "REPARTITION_BY_NUM" in line)
    joined = next(i for i, line in enumerate(plan) if "Join" in line)
    assert shuffled < joined and not any("Aggregate" in line for line in plan[shuffled:])
