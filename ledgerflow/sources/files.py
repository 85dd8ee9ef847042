"""File sources and sinks.

* Zip archives of CSV files (A1, A2): Spark has no zip codec, so a Python
  data source lists the archives and members on the driver (names only) and
  reads one (archive, member) per partition, streaming its lines; parsing is
  ``from_csv`` in the JVM with an explicit schema.  Zip members cannot be
  split, so a one-off conversion to Parquet is the way to read them twice.
* Plain CSV (A3) with an explicit schema (inference is opt-in: it costs a
  full extra scan).
* Sinks (A6, A7, A9): each report table is written as Parquet or JSON.
"""

from __future__ import annotations

import glob
import io
import os
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ledgerflow.session import stored


class _MemberPartition(InputPartition):
    def __init__(self, archive: str, member: str):
        super().__init__((archive, member))
        self.archive, self.member = archive, member


class _ZipReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        wanted = options.get("members")
        self.members = [m.strip() for m in wanted.split(",")] if wanted else None

    def partitions(self):
        archives = sorted(glob.glob(self.path)) if any(ch in self.path for ch in "*?[") else [self.path]
        parts = []
        for a in archives:
            with zipfile.ZipFile(a) as z:
                for name in z.namelist():
                    if name.endswith("/"):
                        continue
                    if self.members is None or name in self.members or os.path.basename(name) in self.members:
                        parts.append(_MemberPartition(a, name))
        return parts

    def read(self, partition):
        with zipfile.ZipFile(partition.archive) as z, z.open(partition.member) as fh:
            for i, line in enumerate(io.TextIOWrapper(fh, encoding="utf-8", newline="")):
                yield (partition.member, i, line.rstrip("\r\n"))


class ZipLines(DataSource):
    """``spark.read.format('ziplines').option('members', 'a.csv,b.csv').load(path)``
    -> ``(member, line_no, line)``; ``path`` may be a glob of archives."""

    @classmethod
    def name(cls):
        return "ziplines"

    def schema(self):
        return "member string, line_no long, line string"

    def reader(self, schema):
        return _ZipReader(self.options)


def register_sources(spark: SparkSession) -> None:
    spark.dataSource.register(ZipLines)


def read_zip_csv(spark: SparkSession, path: str, schema: StructType | str, member: str | None = None,
                 header: bool = True, sep: str = ",") -> DataFrame:
    """CSV member(s) of zip archive(s) parsed with ``schema`` (A1, A2).

    Members are chosen by name (the reference picks them by position, which
    breaks when an archive is repacked)."""
    register_sources(spark)
    r = spark.read.format("ziplines")
    if member:
        r = r.option("members", member)
    lines = r.load(path)
    if header:
        lines = lines.filter(F.col("line_no") > 0)
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = lines.select(F.from_csv("line", ddl, {"sep": sep}).alias("r"))
    return parsed.select("r.*")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True,
             mode: str = "PERMISSIVE", infer: bool = False) -> DataFrame:
    """CSV with an explicit schema (A3); ``infer=True`` reproduces the
    reference's ``inferSchema`` (one extra scan).  Bad records become nulls
    (``PERMISSIVE``) or fail the job (``FAILFAST``)."""
    r = spark.read.option("header", header).option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


CORRUPT = "_corrupt_record"


def read_csv_quarantine(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV parsed with ``schema`` (A3, C8): the rows that fit it, and the others with their raw line as
    ``_corrupt_record`` beside what could be parsed.

    The parsed rows are written once: Spark does not take the corrupt column alone out of a raw file, and both halves then
    come from one parse."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = spark.read.schema(f"{ddl}, {CORRUPT} string").option("header", header).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT).csv(path)
    rows = stored(rows, "parsed-csv")
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.filter(F.col(CORRUPT).isNotNull())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Write a report or chart table (A6, A7, A9); ``overwrite`` is atomic per
    job through Spark's commit protocol."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_tables(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """Write several named tables under ``root`` (one folder each)."""
    out = []
    for name, df in tables.items():
        p = f"{root.rstrip('/')}/{name}"
        write_table(df, p, fmt)
        out.append(p)
    return out


def show_schema_and_preview(df: DataFrame, n: int = 5) -> str:
    """A5: schema tree and the first ``n`` rows as text (driver holds n rows)."""
    return df.schema.treeString() + "\n" + df.limit(n).toPandas().to_string()
