"""The warehouse folder, content sums, as-of snapshots and exact CSV: repeats, failures and changes."""

import datetime as dt
import glob
import json
import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daymark.csv_dialects import EXACT
from daymark.operators import rank_at_most, with_rank
from daymark.plans.dated_feed import run_dated_feed
from daymark.plans.snapshot import run_snapshot
from daymark.sinks import FolderWarehouse, content_sum, overwrite_parquet, snapshot_path, write_csv_snapshot
from daymark.sources import TableSpec, read_csv, read_csv_raw, read_parquet

D1, D2 = "2024-01-01", "2024-01-02"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def warehouse(tmp_path):
    return FolderWarehouse(str(tmp_path / "warehouse"))


def frame(spark, data, ddl="id int, name string"):
    return spark.createDataFrame(data, ddl)


def fails():
    return F.raise_error(F.lit("broken")).cast("int")


# ---------------------------------------------------------------- replace


def test_replace_follows_the_schema(spark, warehouse):
    assert warehouse.replace(frame(spark, [(1, "a"), (2, None)]), "t")["rows"] == 2
    changed = [
        ("id int, name string, more double", [(1, "a", 0.5)]), ("id int", [(7,)]), ("id string, name int", [("x", 3)]), ("id string", []),
    ]
    for ddl, data in changed:  # a column more, one less, other types, no rows
        warehouse.replace(frame(spark, data, ddl), "t")
        got = warehouse.read(spark, "t")
        assert got.schema.simpleString() == frame(spark, data, ddl).schema.simpleString() and rows(got) == Counter(data)


def test_failed_load_leaves_the_table_alone(spark, warehouse):
    warehouse.replace(frame(spark, [(1, "a")]), "t")
    bad = spark.range(50).select(F.when(F.col("id") == 49, fails()).otherwise(1).alias("id"))
    for load in (
        lambda: warehouse.replace(bad, "t"), lambda: warehouse.append(bad.withColumn("name", F.lit("x")), "t", "r"),
    ):
        with pytest.raises(Exception, match="broken"):
            load()
        assert rows(warehouse.read(spark, "t")) == Counter([(1, "a")])
    assert warehouse.version(spark, "t").number == 1
    warehouse.replace(frame(spark, [(2, "b")]), "t")  # also removes what the failed loads left
    assert len(glob.glob(f"{warehouse.root}/t/data-*")) == 2


def test_readers_of_the_version_before_go_on(spark, warehouse):
    warehouse.replace(frame(spark, [(1, "a")]), "t")
    before = warehouse.read(spark, "t")
    warehouse.replace(frame(spark, [(2, "b")]), "t")
    assert rows(before) == Counter([(1, "a")]) and rows(warehouse.read(spark, "t")) == Counter([(2, "b")])
    for i in range(5):
        warehouse.replace(frame(spark, [(i, "c")]), "t")
    assert len(glob.glob(f"{warehouse.root}/t/data-*")) == 2 and len(glob.glob(f"{warehouse.root}/t/_version-*")) == 2


def test_a_load_that_another_one_overtook_is_refused(spark, warehouse, monkeypatch):
    warehouse.replace(frame(spark, [(1, "a")]), "t")
    stale = warehouse.version(spark, "t")
    warehouse.replace(frame(spark, [(2, "b")]), "t")
    with monkeypatch.context() as m:
        m.setattr(FolderWarehouse, "version", lambda self, spark, table: stale)
        with pytest.raises(RuntimeError, match="another load"):
            warehouse.replace(frame(spark, [(3, "c")]), "t")
    assert rows(warehouse.read(spark, "t")) == Counter([(2, "b")])
    with pytest.raises(LookupError):
        warehouse.read(spark, "nothing")


# ---------------------------------------------------------------- append and dates


def test_a_run_is_entered_once(spark, warehouse):
    for run, data in (("a", [(1, "x")]), ("a", [(1, "x")]), ("b", [(1, "x"), (2, "y")]), ("a", [(9, "z")]), ("b", [])):
        assert warehouse.append(frame(spark, data), "t", run)["rows"] == {"a": 1, "b": 2}[run]
    assert rows(warehouse.read(spark, "t")) == Counter([(1, "x"), (1, "x"), (2, "y")])


def test_appends_may_add_columns_only(spark, warehouse):
    warehouse.append(frame(spark, [(1, "x")]), "t", "a")
    warehouse.append(frame(spark, [(2, "y", 1.5)], "id int, name string, more double"), "t", "b")
    assert rows(warehouse.read(spark, "t")) == Counter([(1, "x", None), (2, "y", 1.5)])
    for ddl, data in (("id int", [(1,)]), ("id string, name string, more double", [("1", "x", 0.0)])):
        with pytest.raises(ValueError, match="replace the table"):
            warehouse.append(frame(spark, data, ddl), "t", "c")


def test_dates_are_replaced(spark, warehouse):
    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    ddl = "date date, n int"
    load = lambda data, dates: warehouse.replace_dates(frame(spark, data, ddl), "t", "date", dates)["rows"]
    assert load([(day[0], 1), (day[0], 1), (day[1], 2), (None, 9), (day[2], 3)], [D1, D2]) == 3
    assert load([(day[1], 5)], D2) == 1 and load([(day[1], 5)], [D2]) == 1
    assert rows(warehouse.read(spark, "t")) == Counter([(day[0], 1), (day[0], 1), (day[1], 5)])
    assert rows(warehouse.read(spark, "t", D2)) == Counter([(day[1], 5)])
    assert load([], [D1, D2]) == 0
    assert warehouse.read(spark, "t").schema.simpleString() == "struct<date:date,n:int>" and rows(warehouse.read(spark, "t")) == Counter()
    warehouse.replace(frame(spark, [(day[0], 1)], ddl), "whole")
    with pytest.raises(ValueError, match="not loaded by dates"):
        warehouse.replace_dates(frame(spark, [(day[0], 1)], ddl), "whole", "date", D1)


def test_feed_runs_into_a_folder(spark, warehouse, tmp_path):
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    feed = frame(spark, [(first, 1), (first, 2), (second, 3), (None, 4)], "date date, product_id int")
    zones = (str(tmp_path / "b"), str(tmp_path / "s"))
    for _ in range(2):
        counts = run_dated_feed(spark, feed, [D1, D2], *zones, warehouse)
        assert (counts.bronze, counts.silver, counts.rejected, counts.warehouse) == (3, 3, 1, 3)
    assert run_dated_feed(spark, feed.filter("product_id = 2"), D1, *zones, warehouse).warehouse == 1
    want = Counter([(first, 2), (second, 3)])
    assert rows(warehouse.read(spark, "out_of_stock").select("date", "product_id")) == want
    for _ in range(2):  # the same list of run dates enters the history once
        run_dated_feed(spark, feed.filter("product_id = 2"), D1, *zones, warehouse, table="history", full_history=True)
    assert rows(warehouse.read(spark, "history").select("date", "product_id")) == want


# ---------------------------------------------------------------- content sums


def test_content_sum_sees_every_change(spark):
    ddl = "id int, name string, price double, at timestamp, raw binary, list array<int>"
    base = [
        (1, "a", 1.5, dt.datetime(2024, 1, 1, 2, 3, 4, 5), b"x", [1, 2]), (2, None, None, None, None, None), (2, "", -0.25, None, b"", []),
        (3, "~", 1e300, dt.datetime(1999, 1, 1), b"\x00", [None]),
    ]
    total = lambda data: frame(spark, data, ddl).repartition(3).agg(content_sum(frame(spark, data, ddl))).first()[0]
    want = total(base)
    assert total(base[::-1]) == want and total([]) == "0"
    others = [base[1:], base + base[:1]]
    for i, column, value in (
        (0, 1, "b"), (1, 1, ""), (1, 1, "~"), (0, 2, 1.5000000000000002), (0, 3, dt.datetime(2024, 1, 1, 2, 3, 4, 6)), (0, 4, b"y"), (0, 5, [1]), (3, 0, 4),
    ):
        changed = [list(r) for r in base]
        changed[i][column] = value
        others.append([tuple(r) for r in changed])
    sums = [total(data) for data in others]
    assert want not in sums and len(set(sums)) == len(sums)


def test_a_changed_value_in_any_zone_shows(spark, sf_dir, monkeypatch):
    """A name or price that a zone gets wrong turns that zone's sum, and those after it, red."""
    from daymark.plans import snapshot
    from daymark.queries import QUERIES

    good = {r.table_name: r for r in QUERIES["pipe_snapshot"](spark, sf_dir).collect()}
    spoil = lambda df: df.withColumn("p_name", F.when(F.col("p_partkey") == 3, "other").otherwise(F.col("p_name"))) if "p_name" in df.columns else df
    for reader in ("read_csv", "read_parquet"):
        real = getattr(snapshot, reader)
        with monkeypatch.context() as m:
            m.setattr(snapshot, reader, lambda *a, real=real, **k: spoil(real(*a, **k)))
            bad = {r.table_name: r for r in QUERIES["pipe_snapshot"](spark, sf_dir).collect()}
        assert bad["customer"] == good["customer"] and bad["part"].bronze_content == good["part"].bronze_content
        assert (bad["part"].silver_content == good["part"].silver_content) == (reader == "read_parquet")
        assert bad["part"].warehouse_content != good["part"].warehouse_content


def test_sums_are_taken_while_writing(spark, tmp_path):
    df = frame(spark, [(1, "a"), (2, "\\N")])
    want = df.agg(content_sum(df)).first()[0]
    written = overwrite_parquet(df, str(tmp_path / "p"), content=True)
    assert written == 2 and written.content == want
    csv = write_csv_snapshot(df, str(tmp_path), D1, "t", EXACT, content=True)
    assert csv.content == want and overwrite_parquet(df, str(tmp_path / "q")).content is None


def test_sums_need_no_string_or_object_per_row(spark, tmp_path):
    """Each text is made once a row, in generated code, and what is added up are numbers."""
    from daymark.sinks import counted_content

    rows = [(i, f"n{i}", i / 7, dt.datetime(2024, 1, 1, 0, 0, i % 60, i)) for i in range(500)] + [(None, None, None, None)] * 3
    df = frame(spark, rows, "_digest0 int, name string, price double, at timestamp")  # a name that the sum would take
    want = df.agg(content_sum(df)).first()[0]
    found = counted_content(df.repartition(3), "n", "content")
    assert tuple(found.first()) == (503, want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "sum(cast" not in plan.lower() and "partial_sum((shiftright(digest" in plan
    path = str(tmp_path / "t")
    written = overwrite_parquet(df, path, content=True)
    assert (written, written.content) == (503, want)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


# ---------------------------------------------------------------- as of a date


def test_tables_of_one_moment(spark, tmp_path):
    """The source changes between two tables and between two runs; a backfill of a date does not."""
    path = {name: str(tmp_path / name) for name in ("clients", "orders")}
    ddl = "id int, since date, until date"
    d = [dt.date(2024, 1, i) for i in range(1, 9)]
    for name in path:
        overwrite_parquet(frame(spark, [(1, d[0], None), (2, d[0], d[1]), (3, d[1], None)], ddl), path[name])
    when = "since <= DATE '{date}' AND (until IS NULL OR until > DATE '{date}')"
    specs = [TableSpec(n, schema=frame(spark, [], ddl).schema, as_of=when) for n in path]

    def source(spec):
        rows = read_parquet(spark, path[spec.name])
        if spec.name == "orders":  # more rows arrive once the first table is read
            overwrite_parquet(frame(spark, [(4, d[5], None)], ddl).unionAll(frame(spark, [tuple(r) for r in rows.collect()], ddl)), f"{path['orders']}-new")
            return read_parquet(spark, f"{path['orders']}-new")
        return rows

    for _ in range(2):
        run_snapshot(spark, source, specs, D1, str(tmp_path / "b"), str(tmp_path / "s"), parallel=1)
        assert all({r.id for r in read_parquet(spark, str(tmp_path / "s" / n)).collect()} == {1, 2} for n in path)
    run_snapshot(spark, source, specs, D2, str(tmp_path / "b"), str(tmp_path / "s"), parallel=1)
    assert all({r.id for r in read_parquet(spark, str(tmp_path / "s" / n)).collect()} == {1, 3} for n in path)
    plan = specs[0].rows_of(read_parquet(spark, path["clients"]), D2)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "LessThanOrEqual(since,2024-01-02)" in plan


# ---------------------------------------------------------------- exact CSV


def test_no_value_looks_like_null(spark, tmp_path):
    values = ["\\N", "\\\\N", "\\", "\\\\", "", None, "N", "a\\N", '\\"', '"\\N"', "\\,\n", " \\N", "\\\\\\N\n"]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "id int, `a.b` string, v string")
    write_csv_snapshot(df, str(tmp_path), D1, "t", EXACT)
    path = snapshot_path(str(tmp_path), D1, "t")
    want = Counter((i, v, v) for i, v in enumerate(values))
    assert rows(read_csv(spark, path, df.schema, EXACT)) == want
    assert rows(read_csv(spark, path, dialect=EXACT)) == Counter((str(i), v, w) for i, v, w in want.elements())
    raw = [r for r in read_csv_raw(spark, path, EXACT).collect() if r[0] != "id"]
    assert Counter((int(r[0]), r[1], r[2]) for r in raw) == want


# ---------------------------------------------------------------- ranks of any metric


@pytest.mark.parametrize("kind", ["double", "decimal(12,3)", "string", "timestamp"])
@pytest.mark.parametrize("nulls", ["last", "first"])
def test_rank_of_any_metric(spark, kind, nulls):
    numbers = [(i * 7919) % 613 for i in range(3000)] + [5] * 2000
    value = {
        "double": lambda n: n / 8 - 20, "decimal(12,3)": lambda n: Decimal(n) / 8, "string": lambda n: f"v{n:04d}", "timestamp": lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(seconds=n),
    }[kind]
    data = [(i, value(n) if n % 50 else None) for i, n in enumerate(numbers)]
    if kind == "double":
        data += [(-1, float("nan")), (-2, float("inf")), (-3, float("-inf")), (-4, 0.0), (-5, -0.0)]
    df = spark.createDataFrame(data, f"id int, v {kind}")
    df.createOrReplaceTempView("ranked_values")
    want = rows(spark.sql(f"SELECT id, rank() OVER (ORDER BY v DESC NULLS {nulls}) AS r FROM ranked_values"))
    assert rows(with_rank(df, "v", nulls=nulls).select("id", F.col("r").cast("int"))) == want
    for k in (7, 4000):
        top = rows(rank_at_most(df, "v", k, nulls=nulls).select("id", F.col("r").cast("int")))
        assert top == Counter({x: n for x, n in want.items() if x[1] <= k})
        assert rows(rank_at_most(df, "v", k, as_=None, nulls=nulls).select("id")) == Counter({(x[0],): n for x, n in top.items()})
    empty = df.filter("id > 100000")
    assert with_rank(empty, "v").count() == 0 and rank_at_most(empty, "v", 3, as_=None).count() == 0


def test_all_equal_and_all_null(spark):
    for v in (1.5, None):
        df = spark.createDataFrame([(i, v) for i in range(100)], "id int, v double")
        assert rows(with_rank(df, "v").select("r")) == Counter({(1,): 100})
        assert rank_at_most(df, "v", 2, as_=None).count() == 100


def test_versions_are_plain_files(spark, warehouse):
    warehouse.append(frame(spark, [(1, "x")]), "t", "r1")
    (path,) = glob.glob(f"{warehouse.root}/t/_version-*.json")
    held = json.load(open(path))
    assert held["runs"] == [["r1", 1]] and all(os.path.isdir(f"{warehouse.root}/t/{p}") for p, _ in held["parts"])
