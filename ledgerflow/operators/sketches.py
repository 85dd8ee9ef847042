"""Stored, mergeable sketches per day (E16, E18): summaries of any range of days without its raw rows.

``daily_sketches`` folds a table into one row per (day, column): the number of present values, a KLL sketch of the
numbers (quantiles) and an HLL sketch of the values (distinct counts).  The rows are kept in a table,
partitioned by day, to which later days are appended; ``merged`` merges those of a range.  Merging
costs one row per day and column, and what it returns has the sketches' own errors, whatever the range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

KLL_K = 400
HLL_LOG_K = 12
#: Bounds that hold with high probability at these sizes: rank error of a quantile, relative error of a distinct count.
RANK_ERROR = 0.01
DISTINCT_ERROR = 0.06
SCHEMA = "day date, column string, n long, quantiles binary, distinct binary"


def daily_sketches(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    """``(day, column, n, quantiles, distinct)``; ``quantiles`` is null for columns that are no numbers and days without
    numbers.  Rows without a time belong to a null day; NaN is a missing number."""
    kinds = {f.name: isinstance(f.dataType, NumericType) for f in df.schema.fields}
    items = []
    for c in cols:
        v = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) if kinds[c] else F.lit(None).cast("double")
        s = F.when(v.isNotNull(), F.col(f"`{c}`").cast("string")) if kinds[c] else F.col(f"`{c}`").cast("string")
        items.append(F.struct(F.lit(c).alias("column"), v.alias("v"), s.alias("s")))
    long = df.select(F.to_date(ts).alias("day"), F.explode(F.array(*items)).alias("x")).select("day", "x.*").filter(F.col("s").isNotNull())
    got = long.groupBy("day", "column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(KLL_K)).alias("quantiles"),
                                            F.hll_sketch_agg("s", HLL_LOG_K).alias("distinct"), F.count("v").alias("_v"))
    return got.withColumn("quantiles", F.when(F.col("_v") > 0, F.col("quantiles"))).drop("_v")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Add days to the stored table."""
    sketches.write.mode("append").partitionBy("day").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merged(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """``(column, n, quantiles, distinct)`` of the days from ``first`` to ``last``; only their partitions are read."""
    some = sketches.filter((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") <= F.lit(last).cast("date")))
    return some.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
                                      F.hll_union_agg("distinct").alias("distinct"))


def range_quantiles(sketches: DataFrame, first: str, last: str, probs: Sequence[float]) -> DataFrame:
    """``(column, n, prob, value)`` of the numeric columns."""
    x = merged(sketches.filter(F.col("quantiles").isNotNull()), first, last)
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    x = x.select("column", "n", F.explode(F.arrays_zip(wanted.alias("prob"), F.kll_sketch_get_quantile_double("quantiles", wanted).alias("value"))).alias("q"))
    return x.select("column", "n", "q.prob", "q.value")


def range_distinct(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """``(column, n, distinct)``."""
    return merged(sketches, first, last).select("column", "n", F.hll_sketch_estimate("distinct").alias("distinct"))
