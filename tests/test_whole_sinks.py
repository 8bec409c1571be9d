"""The sink queries write every row and every column."""

from collections import Counter

from daymark.queries import QUERIES


def test_append_keeps_rows_without_a_date(spark, tmp_path):
    rows = "VALUES (1L, TIMESTAMP_NTZ '2024-01-10 01:00:00', 5L), (2L, NULL, 6L), (3L, TIMESTAMP_NTZ '2024-02-01 00:00:00', 7L)"
    events = spark.sql(f"SELECT *, 'view' AS event_type, 1.0D AS value, '{{}}' AS props FROM {rows} AS e(event_id, ts, user_id)")
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["snk_parquet_append"](spark, str(tmp_path)).collect()
    assert Counter((str(r.date), r.product_id) for r in found) == Counter([("2024-01-10", 5), ("None", 6), ("2024-02-01", 7)])


def test_day_layout_holds_every_column(spark, sf_dir):
    written = QUERIES["snk_layout_ymd"](spark, sf_dir).inputFiles()[0].rsplit("/year=", 1)[0]
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = spark.read.parquet(written)
    assert set(found.columns) == {*events.columns, "year", "month", "day"}
    assert Counter(found.select(*events.columns).collect()) == Counter(events.collect())
