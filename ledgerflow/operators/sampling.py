"""Sampling, range partitioning and caching (H1-H9).

Samples are chosen by a seeded hash of a key instead of ``rand()``, so a
retried task (or a rerun) selects the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows aimed at in the one bucket per stratum that is ranked.
ROWS_PER_BUCKET = 100_000


def unit_hash(key: str, seed: int) -> Column:
    """A number of [0, 2**60) from the MD5 digest of key and seed, the same in any engine."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


SPAN = 1 << 60


def simple_sample(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Reproducible Bernoulli sample (H5): a row is kept when its seeded hash
    falls in the lowest ``fraction`` of the hash range.  One narrow filter;
    the size is ``fraction * n`` in expectation."""
    return df.filter(unit_hash(key, seed) < F.lit(int(fraction * SPAN)))


def stratified_sample(df: DataFrame, fraction: float, stratum: str, key: str, seed: int = 42,
                      buckets: int | None = None) -> DataFrame:
    """Exact proportional stratified sample (H6): from each stratum the
    ``round(fraction * n_stratum)`` rows with the smallest seeded hash.

    No task holds a whole stratum: rows are spread over ``buckets`` hash
    buckets per stratum, counts per (stratum, bucket) give the bucket that
    holds the cut-off rank, rows of lower buckets are kept whole, and only
    that boundary bucket is ranked by a window.  A label with a third of all
    rows is cut into ``buckets`` pieces like any other.  Their number follows the
    row count (a bucket holds at most about ``ROWS_PER_BUCKET`` rows)."""
    buckets = buckets or max(64, -(-df.count() // ROWS_PER_BUCKET))
    frac_pos = F.col("_h").cast("double") / F.lit(float(SPAN))
    x = df.withColumn("_h", unit_hash(key, seed)).withColumn("_b", F.floor(frac_pos * buckets).cast("int"))
    counts = x.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(stratum).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(stratum)
    plan = counts.select(stratum, "_b", "_n", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"),
                         F.round(F.sum("_n").over(w_all) * F.lit(fraction)).cast("long").alias("_take"))
    plan = plan.withColumnRenamed(stratum, "_s").withColumnRenamed("_b", "_b2")
    y = x.join(plan, F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_b2"))).drop("_s", "_b2")  # null is a stratum too
    whole = y.filter(F.col("_before") + F.col("_n") <= F.col("_take"))
    edge = y.filter((F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_n") > F.col("_take")))
    wr = Window.partitionBy(stratum, "_b").orderBy("_h", F.col(key))
    edge = edge.withColumn("_r", F.row_number().over(wr)).filter(F.col("_before") + F.col("_r") <= F.col("_take")).drop("_r")
    return whole.unionByName(edge).drop("_h", "_b", "_n", "_before", "_take")


def range_partition(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Range-partition on ``col`` and sort inside each partition (H1, H7).

    ``orderBy`` followed by ``repartitionByRange`` does not leave sorted
    partitions (the optimiser drops the sort); sorting within partitions
    after the exchange does.  ``n`` defaults to the shuffle partition count."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, col).sortWithinPartitions(col)


def cached(df: DataFrame) -> DataFrame:
    """Keep a frame that several jobs reuse (H8); spills to disk rather than
    recomputing when memory is short."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def top_k(df: DataFrame, by: str, k: int = 20, tie: str | None = None, ascending: bool = False) -> DataFrame:
    """Sorted top ``k`` (H2, H3): planned as TakeOrderedAndProject, each task
    keeps only ``k`` rows."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    cols = [o] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*cols).limit(k)


def range_report(df: DataFrame, col: str) -> DataFrame:
    """One row on the physical order of a partitioned frame: its partitions that hold rows, rows, rows out of order
    within their partition, and neighbouring partitions whose ranges overlap."""
    pid = F.spark_partition_id()
    x = df.select(F.col(col).alias("v"), pid.alias("p"), (F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)).alias("i"))
    inside = Window.partitionBy("p").orderBy("i")  # one partition of the frame
    x = x.withColumn("back", F.coalesce((F.lag("v").over(inside) > F.col("v")).cast("long"), F.lit(0)))
    per = x.groupBy("p").agg(F.count(F.lit(1)).alias("rows"), F.sum("back").alias("unsorted"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    over = F.coalesce((F.lag("hi").over(Window.orderBy("p")) > F.col("lo")).cast("long"), F.lit(0))  # one row per partition
    return per.withColumn("over", over).agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"),
                                            F.sum("unsorted").alias("unsorted"), F.sum("over").alias("overlapping"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition, for checking a partitioning."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def session_advice(shuffle_partitions: int, max_partition_mb: int = 128) -> dict[str, str]:
    """Settings the reference recommends (H9, S21) as a config dict."""
    return {"spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.sql.files.maxPartitionBytes": str(max_partition_mb * 1024 * 1024),
            "spark.sql.adaptive.enabled": "true"}


def sample_sizes(sample: DataFrame, stratum: Sequence[str] | str) -> DataFrame:
    return sample.groupBy(stratum).agg(F.count(F.lit(1)).alias("n_sampled"))
