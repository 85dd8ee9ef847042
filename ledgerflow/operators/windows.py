"""Window features (G1-G8) and the distributed whole-table window.

The reference computes ``shift``/``rolling``/``cumsum`` over the frame's row
order with no partition key, or per month (at most 12 groups).  A Spark
window with no or few partition keys runs in that many tasks, so at scale it
does not finish.  G0 instead gives every row its exact position ``_g`` in a
total order and cuts the table into equal chunks:

* range-partition on the (unique) order key, sort within partitions, take the
  index inside each partition, checkpoint (so all later uses see one
  materialisation), and add the partition's offset from the small table of
  partition counts;
* ``chunk = _g // N``; for lag/rolling the last ``k-1`` rows of a chunk are
  copied into the next chunk, for lead the first rows into the previous one;
  windows run per chunk and only the home rows are kept;
* per-group running counts and sums use per-(chunk, group) partial totals and
  their prefix over chunks; per-group rank uses value-bucket rank spans.

No step needs more than one chunk (or one value bucket) in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.quantiles import _default_buckets, bucketize, rank_spans
from ledgerflow.session import cut_lineage


def _order_cols(order_by: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


# --- G0: global position -----------------------------------------------------

def with_global_index(df: DataFrame, order_by: Sequence[str], partitions: int | None = None,
                      name: str = "_g") -> DataFrame:
    """Add the 0-based position of each row in ``order_by`` order.

    ``order_by`` must be unique (add an id as tie-break), so the order and
    every index are deterministic.  Adds ``_chunk_hint`` (the range partition)
    as well."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _order_cols(order_by)
    ordered = (df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_idx", F.monotonically_increasing_id()
                           - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    ordered = cut_lineage(ordered)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: this window is over ``n_parts`` rows only.
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_idx"))
            .drop("_off", "_idx"))


# Most rows of a chunk: the work of one window task does not grow with the table.
ROWS_PER_CHUNK = 1_000_000


def chunk_size(total_rows: int, partitions: int, reach: int) -> int:
    """Rows per chunk: balanced over ``partitions``, at most ``ROWS_PER_CHUNK``, never below the halo."""
    return max(reach + 1, min(ROWS_PER_CHUNK, -(-max(total_rows, 1) // max(partitions, 1))))


def with_halo(dfg: DataFrame, n: int, back: int, fwd: int, g: str = "_g") -> DataFrame:
    """Rows of their chunk plus halo copies: the last ``back`` rows of the
    previous chunk and the first ``fwd`` rows of the next.  ``_home`` marks
    the originals."""
    if n <= max(back, fwd):
        raise ValueError("chunk size must exceed the window reach")
    chunk = F.floor(F.col(g) / n).cast("long")
    pos = F.col(g) % n
    home = dfg.withColumn("_chunk", chunk).withColumn("_home", F.lit(True))
    parts = [home]
    if back:
        parts.append(dfg.filter(pos >= n - back).withColumn("_chunk", chunk + 1).withColumn("_home", F.lit(False)))
    if fwd:
        parts.append(dfg.filter(pos < fwd).withColumn("_chunk", chunk - 1).withColumn("_home", F.lit(False)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rolling_full(agg, c: Column, w: Window, k: int) -> Column:
    """pandas ``rolling(k)`` value: null unless all ``k`` rows are non-null."""
    return F.when(F.count(c).over(w) == k, agg(c).over(w))


def shift_rolling_on(dfg: DataFrame, value: str, n: int, k: int = 3, g: str = "_g") -> DataFrame:
    """lead(1), lag(1), rolling-k mean/max/min of ``value`` on rows that
    carry G0 positions ``g``, chunk size ``n`` (G3, G4, G6, G7)."""
    u = with_halo(dfg, n, back=max(k - 1, 1), fwd=1, g=g)
    w = Window.partitionBy("_chunk").orderBy(g)
    wr = w.rowsBetween(-(k - 1), 0)
    c = F.col(value)
    out = u.select(
        "*",
        F.lead(c, 1).over(w).alias(f"next_{value}"),
        F.lag(c, 1).over(w).alias(f"prev_{value}"),
        rolling_full(F.avg, c, wr, k).alias(f"rolling_avg_{k}"),
        rolling_full(F.max, c, wr, k).alias("rolling_max"),
        rolling_full(F.min, c, wr, k).alias("rolling_min"),
    )
    # Halo rows only feed their neighbours' frames; the first rows of chunk 0
    # have no predecessor, which is the table start, so nothing is missing.
    return out.filter("_home").drop("_home", "_chunk")


def global_shift_rolling(df: DataFrame, order_by: Sequence[str], value: str, k: int = 3,
                         partitions: int | None = None) -> DataFrame:
    """Whole-table lead/lag/rolling of ``value`` in ``order_by`` order."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dfg = with_global_index(df, order_by, n_parts)
    n = chunk_size(dfg.count(), n_parts, max(k - 1, 1))
    return shift_rolling_on(dfg, value, n, k).drop("_pid", "_g")


def group_running(dfg: DataFrame, group: str, value: str, n: int, g: str = "_g",
                  count_name: str = "row_number", sum_name: str = "cumulative_sum") -> DataFrame:
    """Per-group row number and running sum in global order.

    Works on G0 positions: partial totals per (chunk, group) and their prefix
    over chunks (a small table) are added to a within-chunk window.  A null
    value leaves the running sum null on its own row and is skipped after."""
    chunk = F.floor(F.col(g) / n).cast("long")
    x = dfg.withColumn("_chunk", chunk)
    part = x.groupBy("_chunk", group).agg(F.count(F.lit(1)).alias("_n"),
                                          F.coalesce(F.sum(value), F.lit(0)).alias("_s"))
    wp = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    pref = part.select("_chunk", group, F.coalesce(F.sum("_n").over(wp), F.lit(0)).alias("_n0"),
                       F.coalesce(F.sum("_s").over(wp), F.lit(0)).alias("_s0"))
    w = Window.partitionBy("_chunk", group).orderBy(g).rowsBetween(Window.unboundedPreceding, 0)
    y = x.join(pref, ["_chunk", group], "left")
    return y.select(
        *[c for c in dfg.columns],
        (F.col("_n0") + F.row_number().over(Window.partitionBy("_chunk", group).orderBy(g))).alias(count_name),
        F.when(F.col(value).isNotNull(), F.col("_s0") + F.sum(value).over(w)).alias(sum_name),
    )


def group_rank_desc(df: DataFrame, group: str, value: str, out: str = "rank",
                    buckets: int | None = None) -> DataFrame:
    """``rank(method='min', ascending=False)`` of ``value`` within ``group``
    (G2); null values get a null rank.  One plus the rows of the group with a
    larger value, from bucketed rank spans; joined back on (group, value)."""
    buckets = buckets or _default_buckets(df)
    keyed = bucketize(df.select(group, value).filter(F.col(value).isNotNull()), [value], buckets)
    long = keyed.select(group, F.col(value).alias("v"), F.col(f"{value}__b").alias("b"))
    spans = rank_spans(long, [group], descending=True).select(
        F.col(group).alias("_grp"), F.col("v").alias("_v"), (F.col("first") + 1).alias(out))
    cond = F.col(group).eqNullSafe(F.col("_grp")) & (F.col(value).cast("double") == F.col("_v"))
    # Rows without a value have no rank and stay out of the join, where they would share one key.
    ranked = df.filter(F.col(value).isNotNull()).join(spans, cond, "left").drop("_grp", "_v")
    nulls = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast(ranked.schema[out].dataType))
    return ranked.unionByName(nulls)


def window_features(df: DataFrame, order_by: Sequence[str], amount: str = "TransactionAmt",
                    ts: str = "sample_datetime", k: int = 3, partitions: int | None = None,
                    cents_col: str | None = None) -> DataFrame:
    """All reference window features (G1-G7), distributed: month,
    row_number, rank, next/prev amount, cumulative_sum, rolling avg/max/min.

    With ``cents_col`` (amount in integer cents) the running sum is exact and
    independent of how the table is chunked.  Only the order key, the timestamp and
    the amount go through the exchanges and the checkpoint; other columns are
    joined back on the (unique) order key at the end."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = list(dict.fromkeys([*order_by, ts, amount] + ([cents_col] if cents_col else [])))
    others = [c for c in df.columns if c not in needed and c != "month"]
    if others:
        slim = window_features(df.select(*needed), order_by, amount, ts, k, partitions, cents_col)
        added = [c for c in slim.columns if c not in needed]
        key = F.struct(*[F.col(c) for c in order_by])  # a struct compares nulls as equal
        right = slim.select(key.alias("_key"), *added)
        return df.drop("month").join(right, key == F.col("_key"), "left").drop("_key")
    base = df.select(*needed).withColumn("month", F.month(ts))
    dfg = with_global_index(base, order_by, n_parts)
    n = chunk_size(dfg.count(), n_parts, max(k - 1, 1))
    shifted = shift_rolling_on(dfg, amount, n, k)
    run = group_running(shifted, "month", cents_col or amount, n)
    if cents_col:
        run = run.withColumn("cumulative_sum", F.col("cumulative_sum").cast("double") / F.lit(100.0))
    ranked = group_rank_desc(run, "month", amount)
    return (ranked.withColumnRenamed(f"next_{amount}", "next_transaction_amt")
            .withColumnRenamed(f"prev_{amount}", "prev_transaction_amt")
            .drop("_pid", "_g"))


def window_features_plain(df: DataFrame, order_by: Sequence[str], amount: str = "TransactionAmt",
                          ts: str = "sample_datetime", k: int = 3) -> DataFrame:
    """Same features with plain Spark windows (reference form, small data
    and tests only: the whole-table windows run in a single task)."""
    base = df.withColumn("month", F.month(ts))
    o = _order_cols(order_by)
    wm = Window.partitionBy("month").orderBy(*o)
    wg = Window.orderBy(*o)
    wr = wg.rowsBetween(-(k - 1), 0)
    c = F.col(amount)
    return base.select(
        "*",
        F.row_number().over(wm).alias("row_number"),
        F.when(c.isNotNull(), F.rank().over(Window.partitionBy("month").orderBy(c.desc_nulls_last()))).alias("rank"),
        F.lead(c, 1).over(wg).alias("next_transaction_amt"),
        F.lag(c, 1).over(wg).alias("prev_transaction_amt"),
        F.when(c.isNotNull(), F.sum(c).over(wm.rowsBetween(Window.unboundedPreceding, 0))).alias("cumulative_sum"),
        rolling_full(F.avg, c, wr, k).alias(f"rolling_avg_{k}"),
        rolling_full(F.max, c, wr, k).alias("rolling_max"),
        rolling_full(F.min, c, wr, k).alias("rolling_min"),
    )


# --- G8: rolling statistics over an aggregated period series ----------------

def rolling_period_stats(series: DataFrame, period: str, value: str, k: int = 7) -> DataFrame:
    """Rolling mean and sample std of the last ``k`` periods (G8), null until
    ``k`` values are present.  The input is one row per period (already
    aggregated, so its size is the number of periods, not of rows)."""
    w = Window.orderBy(period).rowsBetween(-(k - 1), 0)
    c = F.col(value)
    return series.select("*", rolling_full(F.avg, c, w, k).alias("rolling_mean"),
                         rolling_full(F.stddev_samp, c, w, k).alias("rolling_std"))
