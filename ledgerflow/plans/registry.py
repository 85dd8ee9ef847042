"""Registry of named queries and their SQL oracles.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Its oracle, when the result is
expressible in plain SQL, is DuckDB text over the same parquet tables, with
the transaction views of :mod:`ledgerflow.sources.fixtures` prepended as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.sources.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}  # name -> 'D' (SQL oracle) or 'R' (rows only + pytest)


def _prepared(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ledgerflow.session import prepare
        prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Decorator adding a query (and its oracle SQL, if any) to the registry."""

    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = _prepared(fn)
        if sql is not None:
            ORACLE[name] = with_views(sql, *views) if views else sql.strip()
            CHECK[name] = "D"
        else:
            CHECK[name] = "R"
        return fn

    return deco


def rounded(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """Round floating columns (all, or ``cols``) to ``digits`` so statistics
    computed in a different order by another engine compare equal; the oracle
    SQL applies the same rounding.  Exact columns are left alone."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DoubleType, FloatType

    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and (cols is None or f.name in cols):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
