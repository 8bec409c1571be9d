"""Tables and files that all executors share, and results that cut a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the driver ends.

    Only a session with one local JVM may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/daymark-llm"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    path = fs.makeQualified(path)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written as a table below ``folder`` and read back, with no lineage behind it."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(folder: str, *names: str, spark: SparkSession) -> None:
    """Delete tables that ``staged`` wrote, once what was read from them is a table itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        at = path(f"{folder}/{name}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    """Tasks of an exchange; the session's setting grows with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def most_frequent(counted: DataFrame, most: int, folder: str) -> list:
    """The ``most`` frequent words of ``word``, ``n``, summed first: rows in order of n, then word.

    The driver gets the histogram of the sums, which has a row for each different one (at most the square root
    of twice their total), and then the rows that are frequent enough, not every task's best.
    """
    counted = staged(counted.groupBy("word").agg(F.sum("n").alias("n")), folder, "counts")
    cutoff, upto = 1, 0
    for row in sorted(counted.groupBy("n").agg(F.count("*").alias("words")).collect(), key=lambda row: -row.n):
        cutoff, upto = row.n, upto + row.words
        if upto >= most:
            break
    return counted.where(F.col("n") >= cutoff).orderBy(F.desc("n"), "word").limit(most).collect()


def row_key(documents: DataFrame) -> list:
    """Two columns that tell a row's document apart: its id (null: the least long) and a hash of its text."""
    return [
        F.coalesce(documents["doc_id"].cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(F.coalesce(documents["text"], F.lit(""))).alias("text_key"),
    ]


def write_file(uri: str, data: bytes) -> None:
    """Write one file of a shared folder from a task.  Names must be new: a repeated task takes another."""
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def map_file(uri: str):
    """The bytes of a file of the shared folder: mapped where the folder is mounted, else read."""
    import numpy as np
    from pyarrow.fs import FileSystem, LocalFileSystem

    fs, path = FileSystem.from_uri(uri)
    if isinstance(fs, LocalFileSystem):
        return np.memmap(path, np.uint8, "r").view(np.ndarray)
    with fs.open_input_file(path) as source:
        return np.frombuffer(source.read(), np.uint8)


def send_files(spark: SparkSession, uris: list[str]) -> None:
    """Let every machine fetch these files once; tasks find them by name through SparkFiles."""
    for uri in uris:
        spark.sparkContext.addFile(uri)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    import os
    import shutil

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="daymark-"), "daymark_package"), "zip",
        os.path.dirname(package), os.path.basename(package),
    )
    context.addPyFile(archive)
