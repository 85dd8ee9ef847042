"""Profile tables (P1-P7) and distribution tables.

The reference renders an HTML profile and PNG charts; here each section is a
DataFrame that can be written or inspected.  Every section is a fixed number
of jobs regardless of the column count (wide aggregates, one unpivot).
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.columns import columns_of_type
from ledgerflow.operators.comoments import pair_correlations
from ledgerflow.operators.quality import data_types, top_values
from ledgerflow.operators.quantiles import _default_buckets, bucketize, rank_spans
from ledgerflow.operators.sampling import simple_sample, stratified_sample
from ledgerflow.operators.value_index import ValueIndex, build
from ledgerflow.session import stored

PROFILE_QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95]


def overview(df: DataFrame, index: ValueIndex | None = None) -> DataFrame:
    """Rows, columns, missing cells, duplicate rows -> ``(metric, value)``."""
    index = index or build(df)
    parts = [
        index.rows().select(F.lit("rows").alias("metric"), F.col("n").alias("value")),
        df.sparkSession.createDataFrame([("columns", len(df.columns))], "metric string, value long"),
        index.null_counts().agg(F.lit("missing_cells").alias("metric"),
                                F.coalesce(F.sum("missing"), F.lit(0)).cast("long").alias("value")),
        index.duplicates().select(F.lit("duplicate_rows").alias("metric"), F.col("duplicates").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    money: Sequence[str] = (), index: ValueIndex | None = None) -> DataFrame:
    """Per numeric column n, distinct, zeros, negatives, mean, std, cv,
    skewness (sample-adjusted), kurtosis (population excess), min, max,
    5/25/50/75/95 % quantiles (exact) and IQR -> one row per column, from one value-frequency index.
    Columns in ``money`` (two decimals) get their mean from exact cents.  What has a zero
    denominator (cv at mean 0, skewness of two rows, both of a constant column) is null."""
    cols = list(cols or columns_of_type(df, "numeric"))
    index = index or build(df.select(*[F.col(f"`{c}`") for c in cols]), rows=False)
    mom = index.moments(cols, money).withColumnRenamed("count", "n")
    mom = mom.withColumn("cv", F.col("std") / F.nullif("mean", F.lit(0.0)))
    q = index.quantiles(cols, PROFILE_QUANTILES).groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(round(p * 100)):02d}") for p in PROFILE_QUANTILES])
    return mom.join(q, "column", "left").withColumn("iqr", F.col("p75") - F.col("p25"))


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """Distinct values, string length min/avg/max and the top ``k``
    values (as an array of ``value:count``) per categorical column."""
    cols = list(cols or columns_of_type(df, "categorical"))
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(items).alias("_s")).select("_s.column", "_s.value")
    stats = long.groupBy("column").agg(F.count_distinct("value").alias("distinct"),
                                       F.min(F.length("value")).alias("min_length"),
                                       F.avg(F.length("value")).alias("mean_length"),
                                       F.max(F.length("value")).alias("max_length"))
    top = top_values(df, cols, k).groupBy("column").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "count"))),
                                 lambda s: F.concat_ws(":", s["value"], s["count"].cast("string"))), ", ").alias("top"))
    return stats.join(top, "column", "left")


def timestamp_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Min, max and range in seconds of each timestamp column."""
    cols = list(cols or columns_of_type(df, "timestamp"))
    parts = []
    for c in cols:
        parts.append(df.agg(F.lit(c).alias("column"), F.min(c).cast("timestamp_ntz").alias("min"),
                            F.max(c).cast("timestamp_ntz").alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("range_seconds", F.timestamp_diff("SECOND", F.col("min"), F.col("max")))


def correlations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: Pearson correlation of every column pair over the rows that have both values ->
    ``(column_a, column_b, pearson)``, from one pass of packed co-moments; null with a constant column."""
    return pair_correlations(df, list(cols or columns_of_type(df, "numeric")))


def rank_correlations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: Spearman correlation of every column pair, the Pearson correlation of
    average ranks -> ``(column_a, column_b, spearman)``; null with a constant column.

    A pair is ranked over the rows that have both values.  The columns without a missing value are one
    *group*, ranked together; every other pair is a group of two.  All groups go through the
    same few jobs, however many there are."""
    cols = list(cols or columns_of_type(df, "numeric"))
    x = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    names = x.columns
    x = stored(x.withColumn("_row", F.monotonically_increasing_id()), "rank-rows")  # read several times; its row numbers must not change
    missing = x.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    whole = [i for i, c in enumerate(names) if not missing[c]]
    groups = ([whole] if len(whole) > 1 else []) + [
        [i, j] for i in range(len(cols)) for j in range(i + 1, len(cols)) if missing[names[i]] or missing[names[j]]]
    schema = "column_a string, column_b string, spearman double"
    if not groups:
        return df.sparkSession.createDataFrame([], schema)
    rows = bucketize(x, names, _default_buckets(x))
    items = F.concat(*[F.when(functools.reduce(operator.and_, [F.col(names[i]).isNotNull() for i in g]), F.array(*[
        F.struct(F.lit(k).alias("g"), F.lit(i).alias("i"), F.col(names[i]).alias("v"), F.col(f"{names[i]}__b").alias("b")) for i in g]))
        .otherwise(F.array().cast("array<struct<g:int,i:int,v:double,b:double>>")) for k, g in enumerate(groups)])
    long = rows.select("_row", F.explode(items).alias("_s")).select("_row", "_s.*")
    ranks = rank_spans(long, ["g", "i"]).select("g", "i", "v", ((F.col("first") + F.col("last")) / 2).alias("rank"), ((F.col("total") - 1) / 2).alias("middle"))
    ranked = long.join(ranks, ["g", "i", "v"])
    parts = []
    if len(whole) > 1:
        together = ranked.filter(F.col("g") == 0).groupBy("_row").agg(
            *[F.max(F.when(F.col("i") == i, F.col("rank"))).alias(cols[i]) for i in whole])
        parts.append(pair_correlations(together, [cols[i] for i in whole], "spearman"))
    pairs = [(k, cols[g[0]], cols[g[1]], g[0]) for k, g in enumerate(groups) if len(whole) < 2 or k]
    if pairs:
        every = df.sparkSession.createDataFrame(pairs, "g int, column_a string, column_b string, a int")
        two = ranked.join(F.broadcast(every.select("g", "a")), "g").groupBy("g", "_row").agg(
            F.max(F.when(F.col("i") == F.col("a"), F.col("rank") - F.col("middle"))).alias("da"),  # about the mean rank
            F.max(F.when(F.col("i") != F.col("a"), F.col("rank") - F.col("middle"))).alias("db"))
        varied = (F.min("da") < F.max("da")) & (F.min("db") < F.max("db"))
        r = F.sum(F.col("da") * F.col("db")) / F.nullif(F.sqrt(F.sum(F.col("da") ** 2)) * F.sqrt(F.sum(F.col("db") ** 2)), F.lit(0.0))
        two = two.groupBy("g").agg(F.when(varied, r).alias("spearman"))
        parts.append(every.join(two, "g", "left").select("column_a", "column_b", "spearman"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def associations(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5: Cramer's V of every pair of categorical columns, from pair counts over
    the rows that have both values -> ``(column_a, column_b, cramers_v)``; null where
    a column has fewer than two values."""
    cols = list(cols or columns_of_type(df, "categorical"))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, cramers_v double")
    items = F.array(*[F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(a).cast("string").alias("x"),
                               F.col(b).cast("string").alias("y")) for a, b in pairs])
    pair = ["column_a", "column_b"]
    counts = df.select(F.explode(items).alias("_s")).select("_s.*").filter(F.col("x").isNotNull() & F.col("y").isNotNull()) \
        .groupBy(*pair, "x", "y").agg(F.count(F.lit(1)).alias("n"))
    nx = counts.groupBy(*pair, "x").agg(F.sum("n").alias("nx"))
    ny = counts.groupBy(*pair, "y").agg(F.sum("n").alias("ny"))
    sizes = nx.groupBy(*pair).agg(F.count(F.lit(1)).alias("kx")).join(ny.groupBy(*pair).agg(F.count(F.lit(1)).alias("ky")), pair)
    share = F.col("n").cast("double") * F.col("n") / (F.col("nx").cast("double") * F.col("ny"))
    phi2 = counts.join(nx, [*pair, "x"]).join(ny, [*pair, "y"]).groupBy(*pair).agg((F.sum(share) - 1).alias("phi2"))
    k = F.least("kx", "ky") - 1
    v = F.when(k > 0, F.sqrt(F.greatest(F.col("phi2"), F.lit(0.0)) / k))
    every = df.sparkSession.createDataFrame(pairs, "column_a string, column_b string")
    return every.join(phi2.join(sizes, pair), pair, "left").select(*pair, v.alias("cramers_v"))


def missing_patterns(df: DataFrame) -> DataFrame:
    """Co-occurring missing columns -> ``(pattern, rows)``; the pattern
    names the null columns ('' = complete row)."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in df.columns]
    pat = F.array_join(F.filter(F.array(*flags), lambda x: x.isNotNull()), ",")
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("rows"))


def profile(df: DataFrame, mode: str = "full", fraction: float = 0.2, stratum: str | None = None,
            key: str | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """The profile sections of the full frame, a simple sample, or an
    exact stratified sample."""
    if mode == "sample":
        df = simple_sample(df, fraction, key, seed)
    elif mode == "stratified":
        df = stratified_sample(df, fraction, stratum, key, seed)
    elif mode != "full":
        raise ValueError(f"unknown mode {mode!r}")
    index = build(df)
    out = {"overview": overview(df, index), "types": data_types(df), "missing_patterns": missing_patterns(df)}
    if columns_of_type(df, "numeric"):
        out["numeric"] = numeric_profile(df, index=index)
        out["correlations"] = correlations(df)
        out["rank_correlations"] = rank_correlations(df)
    if columns_of_type(df, "categorical"):
        out["categorical"] = categorical_profile(df)
        out["associations"] = associations(df)
    if columns_of_type(df, "timestamp"):
        out["timestamps"] = timestamp_profile(df)
    return out


# --- distributions -------------------------------------------------------

def histogram(df: DataFrame, cols: Sequence[str], label: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram per (column, label), bins spanning each
    subset's own min..max; the maximum falls into the last bin.
    -> ``(column, label, bin, lower, upper, count)``; empty bins kept."""
    long = df.select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_s")) \
        .select("label", "_s.column", "_s.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    rng = long.groupBy("column", "label").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    x = long.join(rng, ["column", "label"])
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / width).cast("int") + 1, F.lit(bins)))
    counts = x.groupBy("column", "label", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select("column", "label", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / bins
    return spine.join(counts, ["column", "label", "bin"], "left").select(
        "column", "label", "bin", (F.col("lo") + (F.col("bin") - 1) * w).alias("lower"),
        (F.col("lo") + F.col("bin") * w).alias("upper"), F.coalesce("count", F.lit(0)).alias("count"))


def kde(df: DataFrame, cols: Sequence[str], label: str, grid: int = 200, cut: float = 0.0, method: str = "exact",
        prebins: int = 4096, reach: float = 7.0) -> DataFrame:
    """Gaussian kernel density per (column, label) on a ``grid``-point
    support from ``min - cut*h`` to ``max + cut*h`` (0: the data's own range, as a
    histogram overlay draws it), Scott's bandwidth ``h = std * n^(-1/5)``.

    A value meets only the grid points within ``reach`` bandwidths; what that leaves out of a density is less than
    ``exp(-reach^2 / 2) / (h * sqrt(2 pi))``, 2e-11 of a kernel's peak at 7.  ``exact`` sums the kernel over the distinct values,
    weighted by their counts (a partial aggregate first); ``binned`` first replaces the values by the means
    of ``prebins`` equal bins per group, which bounds the cost per group at
    ``prebins x grid`` and is an approximation."""
    if method not in ("exact", "binned"):
        raise ValueError(f"unknown method {method!r}")
    long = df.select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_s")) \
        .select("label", "_s.column", "_s.v").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    st = long.groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                                             F.min("v").alias("lo"), F.max("v").alias("hi"))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), -0.2)).filter(F.col("h") > 0)
    if method == "exact":
        pts = long.groupBy("column", "label", F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("w"))
    else:
        bw = (F.col("hi") - F.col("lo")) / prebins
        binned = long.join(st, ["column", "label"]).withColumn(
            "_k", F.least(F.floor((F.col("v") - F.col("lo")) / bw), F.lit(prebins - 1)))
        pts = binned.groupBy("column", "label", "_k").agg(F.count(F.lit(1)).alias("w"), F.avg("v").alias("x"))
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)
    st = st.select("column", "label", "n", "h", "lo", "hi", (F.col("lo") - cut * F.col("h")).alias("g0"), step.alias("gs"))
    near = pts.join(st.drop("lo", "hi"), ["column", "label"])
    at, far = (F.col("x") - F.col("g0")) / F.col("gs"), F.lit(reach) * F.col("h") / F.col("gs")
    first = F.greatest(F.lit(0), F.ceil(F.greatest(at - far, F.lit(-1.0)))).cast("int")
    last = F.least(F.lit(grid - 1), F.floor(F.least(at + far, F.lit(float(grid))))).cast("int")
    near = near.withColumn("first", first).withColumn("last", last).filter("first <= last").withColumn("point", F.explode(F.sequence("first", "last")))
    z = (F.col("g0") + F.col("point") * F.col("gs") - F.col("x")) / F.col("h")
    sums = near.groupBy("column", "label", "point").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("k"))
    spine = st.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    density = F.coalesce("k", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return spine.join(sums, ["column", "label", "point"], "left").select(
        "column", "label", "point", (F.col("g0") + F.col("point") * F.col("gs")).alias("x"), density.alias("density"))
