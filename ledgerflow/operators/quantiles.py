"""Quantiles of many columns in one distributed job.

``percentile`` keeps every distinct value of a group in one buffer and merges
them in a single task, which does not survive a high-cardinality column at
scale.  The exact path here ranks values without a single-task step:

1. unpivot to ``(column, v)`` and count rows per distinct value; the partial
   aggregate collapses a hot value to one row per map task, so a value held
   by a third of all rows costs no more than any other;
2. split each column's value range into buckets at sketch quantiles (one
   ``percentile_approx`` pass; the bounds are ``buckets`` numbers per column,
   applied by ``Bucketizer``'s binary search in the JVM);
3. a running count per ``(column, bucket)`` window plus each bucket's offset
   (a window over the small bucket-totals table) gives every distinct value
   its rank interval;
4. the values whose interval holds ``floor``/``ceil`` of ``q * (n - 1)`` are
   kept and linearly interpolated, the definition pandas, numpy and DuckDB's
   ``quantile_cont`` share.

Every step is deterministic, so a retried task recomputes the same rows.
``method='approx'`` uses ``percentile_approx`` alone (bounded memory, rank
error about ``n / accuracy``), the reference's own choice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unpivot(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "v",
            extra: Sequence[str] = ()) -> DataFrame:
    """Wide numeric columns -> ``(name, value)`` rows with nulls/NaN dropped.

    ``extra`` names per-column companions: ``extra=['b']`` carries column
    ``f'{c}__b'`` along as field ``b``."""
    items = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value),
                               *[F.col(f"{c}__{e}").alias(e) for e in extra]) for c in cols])
    fields = [f"_s.{name}", f"_s.{value}"] + [f"_s.{e}" for e in extra]
    return df.select(F.explode(items).alias("_s")).select(*fields).filter(
        F.col(value).isNotNull() & ~F.isnan(F.col(value)))


def bucket_bounds(df: DataFrame, cols: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Sketch quantiles at ``i / buckets`` per column, deduplicated.

    One aggregate pass; returns ``buckets - 1`` numbers per column at most
    (bounded driver data, independent of the row count)."""
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 4 * buckets).alias(c)
                   for c in cols]).first()
    # Infinite values stay in the outer buckets; NaN is no value.
    return {c: sorted(set(x for x in (row[c] or []) if x is not None and math.isfinite(x))) for c in cols}


# Rows per bucket aimed at, and the most buckets a bounds sketch is asked for.
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 65_536


def _default_buckets(df: DataFrame) -> int:
    """Buckets from the row count, so the work of one window task does not grow
    with the table (one column-free count; Parquet answers it from footers)."""
    return min(MAX_BUCKETS, max(8, -(-df.count() // ROWS_PER_BUCKET)))


def rank_spans(long: DataFrame, group: Sequence[str], value: str = "v", bucket: str = "b",
               descending: bool = False) -> DataFrame:
    """For every distinct ``(group, value)`` its row count and the span of
    0-based ranks it occupies in ``value`` order within ``group``:
    ``(group..., value, cnt, first, last, total)``.

    ``bucket`` must be monotone in ``value`` within a group (a Bucketizer
    index); windows run per ``(group, bucket)`` so no task holds a whole group.
    """
    group = list(group)
    b = F.col(bucket)
    distinct = long.groupBy(*group, bucket, value).agg(F.count(F.lit(1)).alias("cnt"))
    vorder = F.col(value).desc() if descending else F.col(value).asc()
    border = b.desc() if descending else b.asc()
    w_run = Window.partitionBy(*group, bucket).orderBy(vorder).rowsBetween(Window.unboundedPreceding, 0)
    ranked = distinct.withColumn("cum", F.sum("cnt").over(w_run))
    totals = distinct.groupBy(*group, bucket).agg(F.sum("cnt").alias("n"))
    w_off = Window.partitionBy(*group).orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, bucket,
                            F.coalesce(F.sum("n").over(w_off), F.lit(0)).alias("start"),
                            F.sum("n").over(Window.partitionBy(*group)).alias("total"))
    return ranked.join(offsets, [*group, bucket]).select(
        *group, value, "cnt", "total",
        (F.col("start") + F.col("cum") - F.col("cnt")).alias("first"),
        (F.col("start") + F.col("cum") - 1).alias("last"))


def bucketize(df: DataFrame, cols: Sequence[str], buckets: int) -> DataFrame:
    """Cast ``cols`` to double and add ``{c}__b`` bucket indexes (monotone in
    the value) from sketch bounds; JVM binary search per row."""
    cols = list(cols)
    bounds = bucket_bounds(df, cols, buckets)
    splits = [[float("-inf")] + (bounds[c] or [0.0]) + [float("inf")] for c in cols]
    dbl = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    bz = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"{c}__b" for c in cols],
                    handleInvalid="keep")
    return bz.transform(dbl)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles -> ``(column, prob, value)``."""
    cols = list(cols)
    buckets = buckets or _default_buckets(df)
    long = unpivot(bucketize(df.select(*cols), cols, buckets), cols, extra=["b"])
    spans = rank_spans(long, ["column"])
    pos = F.col("prob") * (F.col("total") - 1)
    cand = spans.withColumn("prob", F.explode(F.array(*[F.lit(float(q)) for q in probs]))).select(
        "column", "prob", "v", pos.alias("pos"), "first", "last")
    lo, hi = F.floor("pos"), F.ceil("pos")
    is_lo = (lo >= F.col("first")) & (lo <= F.col("last"))
    is_hi = (hi >= F.col("first")) & (hi <= F.col("last"))
    picked = cand.filter(is_lo | is_hi).groupBy("column", "prob").agg(
        F.max(F.when(is_lo, F.col("v"))).alias("v_lo"), F.max(F.when(is_hi, F.col("v"))).alias("v_hi"),
        F.first("pos").alias("pos"))
    frac = F.col("pos") - F.floor("pos")
    return picked.select("column", "prob",
                         F.when((frac == 0) | (F.col("v_lo") == F.col("v_hi")), F.col("v_lo"))
                         .otherwise(F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("value"))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     rel_err: float = 0.05) -> DataFrame:
    """Sketch-based quantiles of all columns in one aggregate pass."""
    accuracy = max(1, int(round(1.0 / rel_err))) if rel_err > 0 else 1_000_000
    long = unpivot(df, cols)
    agg = long.groupBy("column").agg(
        F.percentile_approx("v", [float(q) for q in probs], accuracy).alias("qs"))
    return agg.select("column", F.posexplode("qs").alias("i", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(q)) for q in probs]), F.col("i") + 1).alias("prob"),
        "value")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = "exact", rel_err: float = 0.05) -> DataFrame:
    """Quantiles of several columns -> ``(column, prob, value)``.

    ``exact``: linear interpolation between order statistics, by distributed
    ranks at every size.  ``approx``: ``percentile_approx`` with ``rel_err``."""
    if method == "exact":
        return exact_quantiles(df, cols, probs)
    if method == "approx":
        return approx_quantiles(df, cols, probs, rel_err)
    raise ValueError(f"unknown method {method!r}")
