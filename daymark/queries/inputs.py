"""Where queries read from and write to."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.plans.snapshot import Database
from daymark.sinks import counted_content, overwrite_table

_EMBEDDED_URL = "jdbc:derby:memory:daymark;create=true"
_EMBEDDED_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
# Timestamps without a zone stay that way, in the frame and in CSV text.
_READ_OPTIONS = {"preferTimestampNTZ": "true"}


# The given tables.  A declared schema spares the job that reads it from file footers.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory for one call, below the shared folder in ``spark.checkpoint.dir``.

    A session with one local JVM and no such folder gets a temporary one.  Whatever the
    folder is, the new directory is removed when the driver JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{tempfile.gettempdir()}/daymark"
    directory = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return directory


def database(spark: SparkSession) -> Database:
    """The database named in ``spark.daymark.jdbc.{url,user,password,driver}``.

    Without one, a session with one local JVM uses an embedded in-memory database.  That
    is visible in its own process only, so on a cluster the setting is required.
    """
    url = spark.conf.get("spark.daymark.jdbc.url", None)
    if url:
        named = {k: spark.conf.get(f"spark.daymark.jdbc.{k}", None) for k in ("user", "password", "driver")}
        return Database(url, {**_READ_OPTIONS, **{k: v for k, v in named.items() if v}})
    if not is_local(spark):
        raise RuntimeError("set spark.daymark.jdbc.url: an in-memory database is not shared by executors")
    spark._jvm.java.lang.System.setProperty(
        "derby.stream.error.file", f"{tempfile.gettempdir()}/daymark-derby.log"
    )
    return Database(_EMBEDDED_URL, {**_READ_OPTIONS, "driver": _EMBEDDED_DRIVER})


def prefix(label: str, sf_dir: str) -> str:
    """Database table prefix of one query at one scale."""
    return f"{label}_{zlib.crc32(sf_dir.encode()):08x}_"


def fill(db: Database, name: str, df: DataFrame) -> str:
    """Put ``df`` into the database as the source table ``name``."""
    overwrite_table(df, db.url, name, db.properties)
    return name


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a dated feed: the day, and the user as the listed product."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("user_id").cast("int").alias("product_id")
    )


def all_dates(feed_rows: DataFrame) -> list[str]:
    """The calendar days of a feed, as run dates; one row per day reaches the driver."""
    return [r.date.isoformat() for r in feed_rows.select("date").distinct().collect() if r.date is not None]


def contents(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and content sum of each frame: ``table_name``, ``n_rows``, ``content``."""
    found = [
        counted_content(df, "n_rows", "content").select(F.lit(name).alias("table_name"), "n_rows", "content")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, found)


def contents_sql(names: Iterable[str]) -> str:
    """The same over the given tables of these names."""
    return " UNION ALL ".join(_contents_sql(name) for name in names)


def _contents_sql(name: str) -> str:
    cells = []
    for column, kind in (field.split() for field in SCHEMAS[name].split(", ")):
        text = f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')" if kind == "TIMESTAMP_NTZ" else f"CAST({column} AS VARCHAR)"
        cells.append(f"CASE WHEN {column} IS NULL THEN '~' ELSE length({text}) || ':' || {text} END")
    row = " || ".join(cells)
    return (
        f"SELECT '{name}' AS table_name, count(*) AS n_rows,"
        f" CAST(coalesce(sum(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS content FROM {name}"
    )
