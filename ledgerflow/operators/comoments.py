"""Co-moments of many column pairs in one pass (P5).

Every task folds its Arrow batches into the packed moments of all pairs ``i < j`` over the rows that have both
values: their number, both means, both sums of squares and the sum of products about those means.  Blocks are merged
by the usual update of two partial moments, first inside the task, then over the tasks' rows (pairs x tasks of
them, grouped by pair), so the plan is one scan and one small exchange at any number of columns.

Every block shifts a column by one of its own values first, so sums of squares lose no digits to a
large mean.  What remains of a constant column after merging is rounding of its means; a variance that small
counts as none.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 8192
MOMENTS = "i int, j int, n double, mi double, mj double, vi double, vj double, c double"


def block_moments(x: np.ndarray) -> np.ndarray:
    """``(n, mi, mj, vi, vj, c)`` of all column pairs of a matrix, NaN being missing."""
    there = ~np.isnan(x)
    first = x[there.argmax(axis=0), np.arange(x.shape[1])] if len(x) else np.zeros(x.shape[1])
    first = np.where(np.isfinite(first), first, 0.0)
    m = there.astype(np.float64)
    z = np.where(there, x - first, 0.0)
    n = m.T @ m
    safe = np.maximum(n, 1.0)
    mean = (z.T @ m) / safe  # of column i over the rows that have j
    sq = (z * z).T @ m
    v = np.maximum(sq - safe * mean * mean, 0.0)
    c = z.T @ z - safe * mean * mean.T
    return np.stack([n, mean + first[:, None], mean.T + first[None, :], v, v.T, c])


def merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of the rows of both."""
    n = a[0] + b[0]
    safe = np.maximum(n, 1.0)
    di, dj, w = b[1] - a[1], b[2] - a[2], a[0] * b[0] / safe
    return np.stack([n, a[1] + di * b[0] / safe, a[2] + dj * b[0] / safe, a[3] + b[3] + di * di * w, a[4] + b[4] + dj * dj * w, a[5] + b[5] + di * dj * w])


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per pair of columns with its moments, ``cols[i] < cols[j]`` in the given order; missing
    are null and NaN."""
    cols = list(cols)
    x = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])

    def fold(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                m = np.column_stack([pc.fill_null(part.column(i), float("nan")).to_numpy(zero_copy_only=False) for i in range(len(cols))])
                got = block_moments(m)
                total = got if total is None else merge_moments(total, got)
        i, j = np.triu_indices(len(cols), 1)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]],
                                             names=["i", "j", "n", "mi", "mj", "vi", "vj", "c"])

    parts = x.mapInArrow(fold, MOMENTS).filter(F.col("n") > 0)
    w = Window.partitionBy("i", "j")  # one row per task
    n = F.sum("n").over(w)
    di, dj = (F.col(m) - F.sum(F.col(m) * F.col("n")).over(w) / n for m in ("mi", "mj"))
    parts = parts.select("i", "j", "n", "mi", "mj", (F.col("vi") + F.col("n") * di * di).alias("vi"), (F.col("vj") + F.col("n") * dj * dj).alias("vj"),
                         (F.col("c") + F.col("n") * di * dj).alias("c"))
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "vi", "vj", "c")], *[F.max(F.abs(c)).alias(c) for c in ("mi", "mj")])
    # The rounding of a mean is about 1e-16 of it.
    none = {v: F.col(v) <= F.col("n") * F.pow(F.col(m) * 1e-14, F.lit(2.0)) for v, m in (("vi", "mi"), ("vj", "mj"))}
    return total.select("i", "j", "n", *[F.when(none[v], 0.0).otherwise(F.col(v)).alias(v) for v in ("vi", "vj")], "c")


def pair_correlations(df: DataFrame, cols: Sequence[str], name: str = "pearson") -> DataFrame:
    """``(column_a, column_b, <name>)`` of every pair; null for fewer than two rows with both values or a
    constant column among them."""
    cols = list(cols)
    pairs = [(i, j, cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    every = df.sparkSession.createDataFrame(pairs, "i int, j int, column_a string, column_b string")
    if not pairs:
        return every.select("column_a", "column_b", F.lit(None).cast("double").alias(name))
    r = F.col("c") / F.nullif(F.sqrt(F.col("vi")) * F.sqrt(F.col("vj")), F.lit(0.0))
    r = F.when(~F.isnan(r) & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    return every.join(pair_moments(df, cols), ["i", "j"], "left").select("column_a", "column_b", r.alias(name))
