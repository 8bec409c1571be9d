"""A warehouse of Parquet tables in a shared folder, every load of which is all or nothing.

A table is a folder.  Its rows lie in data folders that are never changed once written, and
``_version-<number>.json`` names those that count, with the schema and the runs that were
entered.  A load writes a new data folder and then the next version file, which appears under its
name in one rename; before that, and if the load fails, readers find the version before.  Two loads of one
table must not run at a time.  Data folders that neither of the last two versions names are removed
by the next load.

A replace takes the schema of its rows, whatever the table had before.  The other loads may add
columns, which are NULL in earlier rows; a column of another type or a lost one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from daymark.sinks.audit import observed
from daymark.sources.feed import run_dates

#: A level of the data folders of dated loads; not a column of the table.
_DAY = "_load_day"


@dataclass(frozen=True)
class Version:
    """What counts in a table: data folders, each with the date its rows are of, if any."""

    number: int
    schema: StructType
    parts: tuple[tuple[str, str | None], ...] = ()
    runs: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class FolderWarehouse:
    """Where the tables are.

    Loads return ``rows`` and any further ``metrics`` of the written rows.
    """

    root: str

    def read(self, spark: SparkSession, table: str, dates: str | Sequence[str] | None = None) -> DataFrame:
        """The table's current rows; with ``dates``, those of data folders that may hold these dates."""
        version = self.version(spark, table)
        if version is None:
            raise LookupError(f"no table {table} in {self.root}")
        days = None if dates is None else {d.isoformat() for d in run_dates(dates)}
        paths = [f"{self._at(table)}/{path}" for path, day in version.parts if days is None or day is None or day in days]
        if not paths:
            return spark.createDataFrame([], version.schema)
        return spark.read.schema(version.schema).parquet(*paths)

    def replace(self, df: DataFrame, table: str, with_content: bool = False, **metrics: Column) -> dict:
        """Replace the table, schema included; ``with_content`` also returns the content sum of the rows."""
        path, seen = self._write(df, table, metrics, with_content=with_content)
        self._publish(df.sparkSession, table, _nullable(df.schema), [(path, None)], [])
        return seen

    def append(self, df: DataFrame, table: str, run: str, **metrics: Column) -> dict:
        """Add rows once for each ``run``: a run that was entered before changes nothing and gives its rows again."""
        spark, before = df.sparkSession, self.version(df.sparkSession, table)
        entered = dict(before.runs) if before else {}
        if run in entered:
            return {"rows": entered[run]}
        schema = _merged(before.schema, df.schema) if before else _nullable(df.schema)
        path, seen = self._write(df, table, metrics)
        parts = before.parts if before else ()
        self._publish(spark, table, schema, [*parts, (path, None)], [*entered.items(), (run, seen["rows"])])
        return seen

    def replace_dates(self, df: DataFrame, table: str, date_col: str, dates: str | Sequence[str], **metrics: Column) -> dict:
        """Replace the rows of the given dates by those that ``df`` has of them; other dates are kept."""
        spark, before = df.sparkSession, self.version(df.sparkSession, table)
        days = sorted({d.isoformat() for d in run_dates(dates)})
        schema = _merged(before.schema, df.schema) if before else _nullable(df.schema)
        if before and any(day is None for _, day in before.parts):
            raise ValueError(f"{table} was not loaded by dates")
        wanted = df.where(F.col(date_col).cast("date").isin([F.lit(d).cast("date") for d in days]))
        present = F.collect_set(F.col(date_col).cast("date").cast("string"))  # one for each given date at most
        path, seen = self._write(
            wanted.hint("rebalance", date_col), table, {"rows": F.count(F.lit(1)), "_days": present, **metrics},
            lambda out: out.withColumn(_DAY, F.col(date_col).cast("date")).write.partitionBy(_DAY),
        )
        kept = [(p, day) for p, day in (before.parts if before else ()) if day not in days]
        self._publish(
            spark, table, schema, kept + [(f"{path}/{_DAY}={day}", day) for day in sorted(seen.pop("_days"))],
            before.runs if before else (),
        )
        return seen

    def version(self, spark: SparkSession, table: str) -> Version | None:
        """The table's current version, None where there is no table."""
        fs, at = _file_system(spark, self._at(table))
        numbers = _numbers(fs, at)
        if not numbers:
            return None
        stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(at, _name(numbers[-1])))
        try:
            held = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        pairs = {name: tuple((a, b) for a, b in held[name]) for name in ("parts", "runs")}
        return Version(numbers[-1], StructType.fromJson(held["schema"]), **pairs)

    def _at(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _write(self, df: DataFrame, table: str, metrics: dict, writer=lambda out: out.write, with_content: bool = False) -> tuple[str, dict]:
        path = f"data-{uuid.uuid4().hex}"
        wanted = {"rows": F.count(F.lit(1)), **metrics}
        return path, observed(df, lambda out: writer(out).parquet(f"{self._at(table)}/{path}"), with_content, **wanted)

    def _publish(self, spark: SparkSession, table: str, schema: StructType, parts, runs) -> None:
        """Make these data folders the table, in one rename, and remove those that are no longer of use."""
        fs, at = _file_system(spark, self._at(table))
        before = self.version(spark, table)
        number = before.number + 1 if before else 1
        path = spark._jvm.org.apache.hadoop.fs.Path
        held = json.dumps({"schema": schema.jsonValue(), "parts": list(parts), "runs": list(runs)})
        made, final = path(at, f".{uuid.uuid4().hex}"), path(at, _name(number))
        out = fs.create(made, False)
        try:
            out.write(bytearray(held.encode()))
        finally:
            out.close()
        if fs.exists(final) or not fs.rename(made, final):
            fs.delete(made, False)
            raise RuntimeError(f"another load of {table} has made version {number}")
        used = {p.split("/")[0] for p, _ in [*parts, *(before.parts if before else ())]}
        for status in fs.listStatus(at):
            name = status.getPath().getName()
            old = name.startswith("_version-") and name < _name(number - 1)
            if old or (name.startswith("data-") and name not in used):
                fs.delete(status.getPath(), True)


def _name(number: int) -> str:
    return f"_version-{number:010d}.json"


def _numbers(fs, at) -> list[int]:
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    return sorted(int(n[len("_version-") : -len(".json")]) for n in names if n.startswith("_version-"))


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _nullable(schema: StructType) -> StructType:
    """As Parquet gives it back."""
    return StructType([StructField(f.name, f.dataType) for f in schema])


def _merged(table: StructType, rows: StructType) -> StructType:
    """The table's columns and those that ``rows`` adds."""
    given = {f.name: f.dataType for f in rows}
    wrong = [f.name for f in table if given.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns {wrong} are missing or of another type; replace the table to change them")
    known = set(table.names)
    return StructType([*table.fields, *(StructField(f.name, f.dataType) for f in rows if f.name not in known)])
