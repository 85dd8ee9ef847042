"""Grouped and time-bucketed aggregation.

All of these compile to one partial (map-side) + final hash aggregate per
``groupBy``; nothing is collected.  Time buckets get a calendar spine so that
empty buckets appear with the values pandas' ``resample`` gives them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.timecols import ensure_timestamp

# Aggregate names accepted in agg dicts, and their value for an empty group.
# ``None`` means the empty group yields null (pandas NaN).
_NAMED: dict[str, tuple[Callable[[Column], Column], object]] = {
    "sum": (F.sum, 0),
    "mean": (F.avg, None),
    "avg": (F.avg, None),
    "min": (F.min, None),
    "max": (F.max, None),
    "count": (F.count, 0),
    "nunique": (F.count_distinct, 0),
    "std": (F.stddev_samp, None),
    "stddev": (F.stddev_samp, None),
    "var": (F.var_samp, None),
    "median": (lambda c: F.percentile(c, 0.5), None),
    "first": (lambda c: F.first(c, ignorenulls=True), None),
}


def _resolve(func) -> tuple[str, Callable[[Column], Column], object]:
    """Aggregate given as a name, a ``pyspark.sql.functions`` callable, any
    callable ``Column -> Column`` (including a grouped-agg ``pandas_udf``), or a
    pair ``(name, callable)``, which also names lambdas apart."""
    if isinstance(func, tuple):
        return func[0], func[1], None
    if isinstance(func, str):
        if func not in _NAMED:
            raise ValueError(f"unknown aggregate {func!r}")
        f, empty = _NAMED[func]
        return func, f, empty
    name = getattr(func, "__name__", None) or type(func).__name__
    empty = 0 if name in ("sum", "count", "count_distinct", "countDistinct") else None
    return name, func, empty


def agg_exprs(agg_dict: Mapping[str, object]) -> list[tuple[str, Column, object]]:
    """``{column: func | [funcs]}`` -> ``[(alias, expr, empty_value)]``.

    Aliases follow ``{column}_{function name}`` (``F.avg`` -> ``amount_avg``).
    """
    out = []
    for col, funcs in agg_dict.items():
        funcs = funcs if isinstance(funcs, list) else [funcs]
        for func in funcs:
            name, f, empty = _resolve(func)
            target = F.lit(1) if col == "*" else F.col(col)
            out.append((f"{col}_{name}", f(target).alias(f"{col}_{name}"), empty))
    return out


def aggregate(df: DataFrame, group_by: Sequence, agg_dict: Mapping[str, object]) -> DataFrame:
    """Dict-driven grouped aggregate (E1).  ``group_by`` entries may be names
    or Column expressions (``F.to_date('ts').alias('date')``)."""
    exprs = [e for _, e, _ in agg_exprs(agg_dict)]
    return df.groupBy(*group_by).agg(*exprs)


# --- time buckets -----------------------------------------------------------

_UNITS = {"H": ("hour", "1 hour"), "D": ("day", "1 day"), "W": ("week", "7 days")}


def bucket_start(ts: Column, freq: str) -> Column:
    """Bucket label of ``ts`` as TIMESTAMP_NTZ.

    Hourly and daily buckets are labelled by their start.  Weekly buckets run
    Monday 00:00 to Sunday 23:59:59 and are labelled by the Sunday, the way
    pandas labels ``'W'`` (= ``'W-SUN'``) bins.
    """
    unit, _ = _UNITS[freq]
    start = F.date_trunc(unit, ts).cast("timestamp_ntz")
    if freq == "W":
        return F.timestamp_add("DAY", F.lit(6), start)
    return start


def resample(df: DataFrame, ts_col: str, freq: str, agg_dict: Mapping[str, object],
             out_col: str | None = None, fill_gaps: bool = True) -> DataFrame:
    """Time-bucket aggregate with empty buckets kept.

    One hash aggregate by bucket; the gaps are filled from its result (one row
    per bucket), each bucket spreading over the empty ones up to the next, so the
    table is read once.  Empty buckets get 0 for sum/count/nunique and null
    otherwise.  A timestamp given as text is parsed first, and refused if a value
    does not parse.
    """
    df = ensure_timestamp(df, ts_col)
    out_col = out_col or ts_col
    specs = agg_exprs(agg_dict)
    b = df.select(bucket_start(F.col(ts_col), freq).alias("_bucket"),
                  *[F.col(c) for c in agg_dict if c != "*"])
    grouped = b.filter(F.col("_bucket").isNotNull()).groupBy("_bucket").agg(*[e for _, e, _ in specs])
    if not fill_gaps:
        return grouped.withColumnRenamed("_bucket", out_col)
    step = F.expr(f"INTERVAL {_UNITS[freq][1]}")
    following = F.lead("_bucket").over(Window.orderBy("_bucket"))
    spread = grouped.withColumn("_next", F.coalesce(following, F.col("_bucket") + step)).select(
        "*", F.explode(F.sequence(F.col("_bucket"), F.col("_next") - step, step)).alias("_at"))
    own = F.col("_at") == F.col("_bucket")
    return spread.select(F.col("_at").alias(out_col), *[
        F.when(own, F.col(alias)).otherwise(F.lit(empty)).alias(alias) for alias, _, empty in specs])


# --- period statistics over a labelled table (E5-E8, G8) -------------------

def daily_rate(df: DataFrame, ts_col: str, label: str, out: str = "rate") -> DataFrame:
    """Mean of a 0/1 label per calendar day with empty days kept as null (E5)."""
    r = resample(df, ts_col, "D", {label: "mean"}, out_col="day")
    return r.select(F.to_date("day").alias("day"), F.col(f"{label}_mean").alias(out))


def _stat(statistic: str, feature: str) -> Column:
    if statistic == "size":
        return F.count(F.lit(1))
    if statistic == "sum":
        return F.coalesce(F.sum(feature), F.lit(0).cast("double"))
    if statistic == "mean":
        return F.avg(feature)
    raise ValueError(f"unknown statistic {statistic!r}")


def period_statistics(df: DataFrame, statistics: Mapping[str, Mapping], label: str = "isFraud",
                      positive: int = 1) -> DataFrame:
    """Count/sum/mean of each feature per period over the positive rows.

    ``statistics`` follows the reference's parameter shape
    ``{feature: {'statistic': 'sum' | ['sum', ...], 'period': [...]}}``.
    Every (feature, statistic, period) triple becomes rows of one long table
    ``(feature, statistic, period, period_value, value)``.  The periods are
    unpivoted with ``stack`` so the whole table is a single aggregation, and
    null period values are dropped like pandas' ``groupby`` does (S3).
    """
    periods = sorted({p for spec in statistics.values() for p in spec["period"]})
    pos = df.filter(F.col(label) == positive)
    stack_args = ", ".join(f"'{p}', CAST(`{p}` AS STRING)" for p in periods)
    features = sorted(statistics)
    long = pos.select(*[F.col(f) for f in features if f in pos.columns],
                      F.expr(f"stack({len(periods)}, {stack_args}) AS (period, period_value)"))
    long = long.filter(F.col("period_value").isNotNull())
    aggs, keep = [], []
    for feature, spec in statistics.items():
        stats = spec["statistic"]
        stats = [stats] if isinstance(stats, str) else list(stats)
        for s in stats:
            alias = f"{feature}__{s}"
            aggs.append(_stat(s, feature).cast("double").alias(alias))
            keep.append((feature, s, set(spec["period"]), alias))
    g = long.groupBy("period", "period_value").agg(*aggs)
    # Unpivot the statistic columns back to rows in the same stage and keep
    # only the periods each feature asked for.
    stack2 = ", ".join(f"'{f}', '{s}', `{a}`" for f, s, _, a in keep)
    out = g.select("period", "period_value",
                   F.expr(f"stack({len(keep)}, {stack2}) AS (feature, statistic, value)"))
    wanted = None
    for f, s, pset, _ in keep:
        c = (F.col("feature") == f) & (F.col("statistic") == s) & F.col("period").isin(sorted(pset))
        wanted = c if wanted is None else (wanted | c)
    return out.filter(wanted).select("feature", "statistic", "period", "period_value", "value")


def fraud_pivot(df: DataFrame, period: str, statistic: str, feature: str,
                label: str = "isFraud", values=(0, 1)) -> DataFrame:
    """Two-key aggregate pivoted on the label, missing cells 0."""
    agg = _stat(statistic, feature)
    p = (df.filter(F.col(period).isNotNull())
         .groupBy(period).pivot(label, list(values)).agg(agg))
    return p.na.fill(0, subset=[str(v) for v in values]).select(
        period, *[F.col(str(v)).cast("double").alias(f"{label}_{v}") for v in values])
