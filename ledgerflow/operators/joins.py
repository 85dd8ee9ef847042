"""Joins (D1-D3, X1).  No hints: adaptive execution broadcasts a side whose
measured bytes allow it and splits skewed keys otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def merge(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left",
          suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """pandas-style equi-join (D1): key columns once, clashing non-key names
    get ``suffixes``.  A plain hash/sort-merge join on the key; skewed keys are
    split by AQE's skew-join handling."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in right.columns]
    return left.select(*lsel).join(right.select(*rsel), keys, how)


def aligned_difference(a: DataFrame, b: DataFrame, on: str | Sequence[str], a_col: str, b_col: str,
                       out: str = "difference") -> DataFrame:
    """Index-aligned ``a - b`` (D2): full outer join on the key columns; a key
    missing on either side gives null, as pandas' aligned subtraction does."""
    keys = [on] if isinstance(on, str) else list(on)
    j = a.select(*keys, F.col(a_col).alias("_a")).join(b.select(*keys, F.col(b_col).alias("_b")), keys, "full")
    return j.select(*keys, (F.col("_a") - F.col("_b")).alias(out))


def convert_currency(df: DataFrame, rates: DataFrame, key: str, amount: str,
                     rate_col: str = "rate", out: str = "amount_converted") -> DataFrame:
    """Multiply ``amount`` by the rate looked up on ``key``.

    A missing rate gives a null converted amount (left join keeps the transaction)."""
    return df.join(rates, key, "left").withColumn(out, F.col(amount) * F.col(rate_col))
