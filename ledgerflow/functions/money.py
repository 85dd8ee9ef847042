"""Exact aggregates for two-decimal money columns.

Summing doubles gives a result that depends on the order rows arrive in, so
the same query can differ in the last bits between runs, partitionings or
task retries.  Amounts carried in cents are summed as ``bigint`` instead:
exact, order-independent, and still a single codegen'd long addition per
row (a ``decimal`` sum of that width falls back to a slower object path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def cents_sum(c: Column) -> Column:
    """Exact sum of a money column, as double (empty -> null)."""
    return F.sum(cents(c)).cast("double") / F.lit(100.0)


def cents_mean(c: Column) -> Column:
    """Mean of a money column from the exact cent total (empty -> null)."""
    return F.sum(cents(c)).cast("double") / (F.count(c) * 100).cast("double")


def cents_avg(c: Column) -> Column:
    """:func:`cents_mean` under the name ``avg`` (for ``{col}_avg`` aliases)."""
    return cents_mean(c)


cents_sum.__name__ = "sum"
cents_mean.__name__ = "mean"
cents_avg.__name__ = "avg"


def sql_sum(c: str) -> str:
    """DuckDB text computing the same value as :func:`cents_sum`."""
    return f"(CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / 100.0)"


def sql_mean(c: str) -> str:
    """DuckDB text computing the same value as :func:`cents_mean`."""
    return f"(CAST(sum(CAST(round({c} * 100) AS BIGINT)) AS DOUBLE) / CAST(count({c}) * 100 AS DOUBLE))"
