"""Many daily series at once: spines, decomposition, ACF/PACF, residual
diagnostics and Q-Q points (K1-K3, K8, K9).

A series table is ``(series, day, value)``.  Windows are partitioned by
``series`` and ordered by day, so a task holds one series (its length is the
number of days, not of transactions); many series run in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.normal import inverse_normal


def daily_series(df: DataFrame, series: str | None, ts: str, value_expr, gap_policy: str = "error",
                 agg=F.avg) -> DataFrame:
    """Aggregate to one value per (series, day) over a full calendar spine.

    ``gap_policy``: ``'error'`` raises when a series has an empty day (what
    decomposition/ARIMA would do), ``'zero'`` fills 0, ``'ffill'`` carries the
    last value, ``'keep'`` leaves null.  The spine spans each series' own
    first to last day."""
    key = F.col(series) if series else F.lit("all")
    v = value_expr if not isinstance(value_expr, str) else F.col(value_expr)
    g = df.groupBy(key.alias("series"), F.to_date(ts).alias("day")).agg(agg(v).alias("value"))
    spine = g.groupBy("series").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        "series", F.explode(F.sequence("lo", "hi")).alias("day"))
    s = spine.join(g, ["series", "day"], "left")
    if gap_policy == "error":
        gaps = s.filter(F.col("value").isNull()).limit(1).count()
        if gaps:
            raise ValueError("series has empty days; choose gap_policy 'zero', 'ffill' or 'keep'")
        return s
    if gap_policy == "zero":
        return s.withColumn("value", F.coalesce("value", F.lit(0.0)))
    if gap_policy == "ffill":
        w = Window.partitionBy("series").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
        return s.withColumn("value", F.last("value", ignorenulls=True).over(w))
    if gap_policy == "keep":
        return s
    raise ValueError(f"unknown gap_policy {gap_policy!r}")


def with_index(s: DataFrame) -> DataFrame:
    """0-based position ``t`` of each day within its series."""
    return s.withColumn("t", F.row_number().over(Window.partitionBy("series").orderBy("day")) - 1)


def decompose(s: DataFrame, period: int = 7) -> DataFrame:
    """Additive seasonal decomposition (K1): trend = centred moving average
    (2x MA for an even period), seasonal = mean detrended value per phase
    minus the mean of those, resid = value - trend - seasonal."""
    x = with_index(s)
    w = Window.partitionBy("series").orderBy("t")
    half = period // 2
    if period % 2:
        frame = w.rowsBetween(-half, half)
        trend = F.when(F.count("value").over(frame) == period, F.avg("value").over(frame))
    else:  # weights 0.5, 1, ..., 1, 0.5 over period + 1 points
        frame = w.rowsBetween(-half, half)
        total = F.sum("value").over(frame) - 0.5 * F.first("value").over(frame) - 0.5 * F.last("value").over(frame)
        trend = F.when(F.count("value").over(frame) == period + 1, total / period)
    x = x.withColumn("trend", trend).withColumn("phase", F.col("t") % period)
    x = x.withColumn("_phase_mean", F.avg(F.col("value") - F.col("trend")).over(Window.partitionBy("series", "phase")))
    # The mean of the ``period`` phase means, taken once per series.
    ph = x.select("series", "phase", "_phase_mean").distinct()
    centre = ph.groupBy("series").agg(F.avg("_phase_mean").alias("_centre"))
    x = x.join(centre, "series")
    x = x.withColumn("seasonal", F.col("_phase_mean") - F.col("_centre"))
    return x.select("series", "day", "t", "value", "trend", "seasonal",
                    (F.col("value") - F.col("trend") - F.col("seasonal")).alias("resid"))


def acf(s: DataFrame, nlags: int = 50, value: str = "value") -> DataFrame:
    """Sample autocorrelation per series, lags 0..nlags clipped to n-1 (K2):
    ``sum((x_t - m)(x_{t+k} - m)) / sum((x_t - m)^2)``, with the 95 % Bartlett
    band ``1.96 * sqrt((1 + 2 * sum_{j<k} r_j^2) / n)``.  A self-join on
    ``t + lag`` inside each series; lags are an exploded literal array.  A constant series has no
    autocorrelation (null)."""
    x = with_index(s.filter(F.col(value).isNotNull()).withColumnRenamed(value, "_x"))
    stats = x.groupBy("series").agg(F.when(F.min("_x") < F.max("_x"), F.avg("_x")).otherwise(F.min("_x")).alias("_m"), F.count(F.lit(1)).alias("n"))
    c = x.join(stats, "series").withColumn("_d", F.col("_x") - F.col("_m"))
    left = c.select("series", "t", "_d", "n", F.explode(F.sequence(F.lit(0), F.lit(nlags))).alias("lag")) \
            .filter(F.col("lag") < F.col("n"))
    right = c.select("series", F.col("t").alias("_t2"), F.col("_d").alias("_d2"))
    j = left.join(right, (left.series == right.series) & (right._t2 == left.t + left.lag)).drop(right.series)
    num = j.groupBy("series", "lag").agg(F.sum(F.col("_d") * F.col("_d2")).alias("_num"), F.first("n").alias("n"))
    den = c.groupBy("series").agg(F.sum(F.col("_d") * F.col("_d")).alias("_den"))
    r = num.join(den, "series").withColumn("acf", F.col("_num") / F.nullif("_den", F.lit(0.0)))
    w = Window.partitionBy("series").orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    sq = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") ** 2)).over(w), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(1.96 * F.sqrt((1 + 2 * sq) / F.col("n")))
    return r.select("series", "lag", "acf", band.alias("band"), "n")


def pacf(s: DataFrame, nlags: int = 50) -> DataFrame:
    """Partial autocorrelation per series (K3), Yule-Walker on the
    unadjusted ACF ('ywm').  Lags are clipped below n/2 as the library does.

    Durbin-Levinson as a fold over the lags: the state is the coefficients of the last order, the
    innovation variance and the values so far, at most ``nlags`` numbers each.  Null for a
    constant series, and beyond an order that leaves no variance."""
    a = acf(s, nlags).groupBy("series").agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("r"),
                                            F.first("n").alias("n"))
    last = F.least(F.lit(nlags), F.floor(F.col("n") / 2) - 1).cast("int")

    def step(state, k):
        phi = state["phi"]
        past = F.reverse(F.slice(F.col("r"), F.lit(2), k - 1))
        seen = F.aggregate(F.zip_with(phi, past, lambda p, x: p * x), F.lit(0.0), lambda t, x: t + x)
        new = (F.get(F.col("r"), k) - seen) / F.nullif(state["v"], F.lit(0.0))
        one = F.array(new)  # bound once by the transform below

        def grown(x):
            return F.struct(F.concat(F.zip_with(phi, F.reverse(phi), lambda p, q: p - x * q), F.array(x)).alias("phi"),
                            (state["v"] * (1 - x * x)).alias("v"), F.concat(state["out"], F.array(x)).alias("out"))

        return F.get(F.transform(one, grown), F.lit(0))

    start = F.struct(F.array().cast("array<double>").alias("phi"), F.get("r", F.lit(0)).alias("v"), F.array(F.get("r", F.lit(0))).alias("out"))
    orders = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    got = a.select("series", "n", F.aggregate(orders, start, step, lambda x: x["out"]).alias("out"))
    return got.select("series", F.posexplode("out").alias("lag", "pacf"), (F.lit(1.96) / F.sqrt("n")).alias("band"))


def residual_diagnostics(resid: DataFrame, value: str = "resid", lb_lags=(1, 10)) -> DataFrame:
    """Per series (K8): Ljung-Box Q at the given lags, Jarque-Bera, the
    two-sided variance ratio H (last third over first third), skewness and
    (non-excess) kurtosis of the residuals (population moments).  What a
    constant series, or one without variance at its start, would divide by zero is null."""
    x = resid.filter(F.col(value).isNotNull()).select("series", "day", F.col(value).alias("r"))
    mom = x.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.when(F.min("r") < F.max("r"), F.avg("r")).otherwise(F.min("r")).alias("m"))
    y = x.join(mom, "series").withColumn("d", F.col("r") - F.col("m"))
    m = y.groupBy("series").agg(F.first("n").alias("n"), F.avg(F.col("d") ** 2).alias("m2"),
                                F.avg(F.col("d") ** 3).alias("m3"), F.avg(F.col("d") ** 4).alias("m4"))
    m = m.select("series", "n", (F.col("m3") / F.nullif(F.pow("m2", F.lit(1.5)), F.lit(0.0))).alias("skew"),
                 (F.col("m4") / F.nullif(F.col("m2") ** 2, F.lit(0.0))).alias("kurtosis"))
    m = m.withColumn("jarque_bera", F.col("n") / 6 * (F.col("skew") ** 2 + (F.col("kurtosis") - 3) ** 2 / 4))
    # Heteroskedasticity: sum of squares of the last h over the first h values.
    t = with_index(x.withColumnRenamed("r", "value")).join(mom.select("series", "n"), "series")
    h = F.round(F.col("n") / 3)
    hs = t.groupBy("series").agg(
        F.sum(F.when(F.col("t") >= F.col("n") - h, F.col("value") ** 2)).alias("_last"),
        F.sum(F.when(F.col("t") < h, F.col("value") ** 2)).alias("_first"))
    hs = hs.select("series", (F.col("_last") / F.nullif("_first", F.lit(0.0))).alias("het_h"))
    a = acf(x.withColumnRenamed("r", "value"), max(lb_lags))
    lb = a.filter(F.col("lag") > 0).select(
        "series", "lag", (F.col("n") * (F.col("n") + 2) * F.col("acf") ** 2 / (F.col("n") - F.col("lag"))).alias("q"))
    qcols = [F.sum(F.when(F.col("lag") <= L, F.col("q"))).alias(f"ljung_box_{L}") for L in lb_lags]
    lbq = lb.groupBy("series").agg(*qcols)
    return m.join(hs, "series").join(lbq, "series")


def qq_points(resid: DataFrame, value: str = "resid") -> DataFrame:
    """Normal Q-Q points per series (K9): sorted residual against the N(0,1)
    quantile of ``i / (n + 1)``; ranks from a per-series window, quantiles from rational
    approximations as column expressions."""
    x = resid.filter(F.col(value).isNotNull())
    w = Window.partitionBy("series").orderBy(value, "day")
    y = x.select("series", "day", F.col(value).alias("sample"), F.row_number().over(w).alias("i"),
                 F.count(F.lit(1)).over(Window.partitionBy("series")).alias("n"))
    y = y.withColumn("p", F.col("i") / (F.col("n") + 1).cast("double"))
    return y.select("series", "day", "i", "sample", inverse_normal("p").alias("theoretical"))
