"""Helpers shared by the training-data operators of this subpackage.

Conventions used throughout:

* *words* are maximal runs of characters other than space and U+0009-U+000D;
  ``bytes.split()`` on the UTF-8 text is exactly that rule;
* folds are drawn with ``crc32`` of the id's decimal text, so they do not
  depend on partitioning;
* tables that several jobs reuse are written once as Parquet below the shared
  folder named by ``spark.checkpoint.dir`` and read back: a lost executor costs
  a re-read, not a recomputation, and later joins see plain scans whose
  exchanges adaptive execution may split.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir, ship_package
from ledgerflow.sources.tables import read_table

WORD = r"[^\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows handled per Python call inside a task; a task's memory follows this and
#: the longest texts, never the size of its partition.
SLICE_ROWS = 256

__all__ = ["WORD", "DOCUMENT_COLUMNS", "SLICE_ROWS", "read_table", "shared_path", "shared_table", "fold", "map_rows",
           "filter_rows", "setup", "near_share"]


def setup(spark: SparkSession) -> None:
    """Ship this package to the Python workers (idempotent).  No session
    setting is changed here: the cluster's own settings hold."""
    ship_package(spark)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    return a scan of it."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str | Column, n: int) -> Column:
    """``crc32(id as text) mod n``; a null id counts as the empty string."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def near_share(id_col: str, salt: str, share: float) -> Column:
    """A predicate true for about ``share`` of the rows, drawn by a hash of the id."""
    if share >= 1:
        return F.lit(True)
    h = F.pmod(F.xxhash64(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(1_000_003))
    return h < F.lit(int(share * 1_000_003) + 1)


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str,
             start: Callable[[], object] | None = None) -> DataFrame:
    """Apply ``fn`` to slices of rows inside Arrow batches.

    ``fn`` gets ``{column: values}`` of at most ``SLICE_ROWS`` rows and returns
    ``{column: values}`` for ``schema`` (any number of rows).  ``start`` runs
    once per task; its result is passed as ``fn``'s second argument."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out_schema)
    names = [f.name for f in out_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (start(),) if start else ()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                got = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}, *state)
                yield pa.RecordBatch.from_arrays([_column(got[n], arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, out_schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    """An Arrow array; a list of numpy arrays becomes a list column without a detour over Python numbers."""
    if pa.types.is_list(kind) and len(values) and all(isinstance(v, np.ndarray) for v in values):
        ends = np.cumsum([0] + [len(v) for v in values]).astype(np.int32)
        flat = pa.array(np.concatenate(values)).cast(kind.value_type)
        return pa.ListArray.from_arrays(pa.array(ends), flat, type=kind)
    return pa.array(values, type=kind)


def filter_rows(df: DataFrame, column: str, keep: Callable[[list], list[bool]],
                start: Callable[[], object] | None = None) -> DataFrame:
    """Rows of ``df`` for which ``keep`` (given the values of ``column``) is
    true.  Every column passes through untouched, whatever its name."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (start(),) if start else ()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                yield part.filter(pa.array(keep(part.column(at).to_pylist(), *state), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
