"""Data-quality checks and the quality report.

The reference runs one Spark job per column and metric (about two per numeric
column for outliers alone).  Here each metric family is one aggregate over
all columns, and every result is a long table
``(section, column, metric, value)`` that can be written or compared as is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType

from ledgerflow.functions.columns import columns_of_type
from ledgerflow.operators.quantiles import quantiles


def _stack(df: DataFrame, pairs: Sequence[tuple[str, str]], key: str, value: str) -> DataFrame:
    """One-row wide -> long via ``stack`` (names are literals, values columns)."""
    args = ", ".join(f"'{k}', `{c}`" for k, c in pairs)
    return df.select(F.expr(f"stack({len(pairs)}, {args}) AS ({key}, {value})"))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column (E10) -> ``(column, missing)``; one scan."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    return _stack(wide, [(c, f"c{i}") for i, c in enumerate(cols)], "column", "missing")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows (E11) -> one row ``duplicates``.

    One shuffle on all columns; the partial aggregate merges copies map-side,
    so a row repeated a million times ships once per task.  Nulls compare
    equal to each other, like pandas' ``duplicated``."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of each row."""
    return df.dropDuplicates()


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or the given) column."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, value=0, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls with a constant."""
    return df.na.fill(value, subset=list(subset) if subset else None)


def data_types(df: DataFrame) -> DataFrame:
    """Column types (E23) -> ``(column, dtype)``; schema metadata only."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct non-null values per column (E16) -> ``(column, distinct)``.

    Exact counts merge one narrow row per value and column (``value_index.distinct_counts``), which
    holds for numbers, text, booleans, dates and timestamps; ``exact=False`` uses HyperLogLog++ sketches, one pass
    with no row shuffle, for very wide tables."""
    from ledgerflow.operators.value_index import distinct_counts as exact_counts

    cols = list(cols or df.columns)
    if exact and not any(isinstance(df.schema[c].dataType, (ArrayType, StructType, MapType, BinaryType)) for c in cols):
        return exact_counts(df, cols)
    f = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*[f(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    return _stack(wide, [(c, f"c{i}") for i, c in enumerate(cols)], "column", "distinct")


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (ddof 1), min, max per numeric column (E13, E21),
    typed doubles -> ``(column, count, mean, std, min, max)``; one scan."""
    cols = list(cols or columns_of_type(df, "numeric"))
    exprs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        exprs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                  F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*exprs)
    args = ", ".join(f"'{c}', `n{i}`, `m{i}`, `s{i}`, `lo{i}`, `hi{i}`" for i, c in enumerate(cols))
    return wide.select(F.expr(f"stack({len(cols)}, {args}) AS (column, count, mean, std, min, max)"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """pandas-style describe (E13): count, mean, std, min, 25%, 50%, 75%, max
    -> long ``(column, statistic, value)``."""
    cols = list(cols or columns_of_type(df, "numeric"))
    s = numeric_summary(df, cols)
    base = s.select("column", F.expr("stack(5, 'count', CAST(count AS DOUBLE), 'mean', mean, 'std', std, "
                                     "'min', min, 'max', max) AS (statistic, value)"))
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method).select(
        "column", F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"),
        "value")
    return base.unionByName(q)


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts over non-null values (E14) -> ``(value, count, share)``.

    The total is one number fetched by its own count job, so no step needs
    all groups in one task however many distinct values there are."""
    nn = df.filter(F.col(col).isNotNull())
    total = nn.count()
    c = nn.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return c.select("value", "count", (F.col("count") / F.lit(float(total) if total else None)).alias("share"))


def _value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` for several categorical columns in one
    aggregate; values are carried as strings, null kept as a value."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.select(F.explode(items).alias("_s")).select("_s.column", "_s.value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def top_values(df: DataFrame, cols: Sequence[str] | None = None, k: int = 5,
               dropna: bool = True) -> DataFrame:
    """Top-``k`` values per categorical column (E15) -> ``(column, rank, value, count)``.

    Ties are broken by value so the result is reproducible.  The
    ``row_number() <= k`` filter lets Spark insert a partial group limit
    before the shuffle, so each task ships at most ``k`` rows per column.
    """
    cols = list(cols or columns_of_type(df, "categorical"))
    vc = _value_counts_long(df, cols)
    if dropna:
        vc = vc.filter(F.col("value").isNotNull())
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return vc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "column", "rank", "value", "count")


def modes(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Most frequent value per categorical column (E17); null is a candidate
    and ties go to the smallest value (null first)."""
    return top_values(df, cols, k=1, dropna=False).select("column", F.col("value").alias("mode"), "count")


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact",
                 rel_err: float = 0.05, whisker: float = 1.5) -> DataFrame:
    """Rows outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` per numeric column.

    One quantile job for all columns, then one aggregate with a
    ``count_if`` per column.  The fences (two numbers per column) are
    collected to the driver: bounded by the column count.
    """
    cols = list(cols or columns_of_type(df, "numeric"))
    q = quantiles(df, cols, [0.25, 0.75], method=method, rel_err=rel_err).collect()
    qd = {(r["column"], round(r["prob"], 2)): r["value"] for r in q}
    exprs, out_cols = [], []
    for i, c in enumerate(cols):
        q1, q3 = qd.get((c, 0.25)), qd.get((c, 0.75))
        if q1 is None:
            continue
        lo, hi = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        x = F.col(c).cast("double")
        exprs.append(F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"o{i}"))
        out_cols.append((c, f"o{i}", q1, q3, lo, hi))
    if not exprs:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, q3 double, lower double, upper double, outliers long")
    wide = df.agg(*exprs)
    args = ", ".join(f"'{c}', CAST({q1!r} AS DOUBLE), CAST({q3!r} AS DOUBLE), CAST({lo!r} AS DOUBLE), "
                     f"CAST({hi!r} AS DOUBLE), `{o}`" for c, o, q1, q3, lo, hi in out_cols)
    return wide.select(F.expr(
        f"stack({len(out_cols)}, {args}) AS (column, q1, q3, lower, upper, outliers)"))


def quality_summary(df: DataFrame) -> DataFrame:
    """Missing values, duplicate rows and types (E24) as one long table
    ``(section, column, value)``; the type section carries the type name."""
    miss = null_counts(df).select(F.lit("missing_values").alias("section"), "column",
                                  F.col("missing").cast("string").alias("value"))
    dup = duplicate_count(df).select(F.lit("duplicate_rows").alias("section"), F.lit(None).cast("string").alias("column"),
                                     F.col("duplicates").cast("string").alias("value"))
    types = data_types(df).select(F.lit("data_types").alias("section"), "column", F.col("dtype").alias("value"))
    return miss.unionByName(dup).unionByName(types)


def quality_report(df: DataFrame, method: str = "exact", rel_err: float = 0.05,
                   exact_distinct: bool = True, include_types: bool = True) -> DataFrame:
    """Full report (E25): missing, duplicates, types, unique values, numeric
    summary, most frequent values, outliers, as one long table
    ``(section, column, metric, value double, text string)``; ``text`` holds
    the type name and the mode, ``value`` every number.

    The exact report is read from one value-frequency index (``operators/value_index.py``), which scans the
    table once; the duplicates read again the rows whose digest occurs twice.  ``method='approx'``
    takes the fences from sketches, ``exact_distinct=False`` the distinct counts.
    """
    from ledgerflow.operators.value_index import build

    num = columns_of_type(df, "numeric")
    cat = columns_of_type(df, "categorical")
    index = build(df)
    d = lambda c: F.col(c).cast("double")
    no_text = F.lit(None).cast("string").alias("text")
    parts = [
        index.null_counts().select(F.lit("missing_values").alias("section"), "column",
                                   F.lit("count").alias("metric"), d("missing").alias("value"), no_text),
        index.duplicates().select(F.lit("duplicates").alias("section"), F.lit("*").alias("column"),
                                  F.lit("count").alias("metric"), d("duplicates").alias("value"), no_text),
        (index.distinct_counts() if exact_distinct else distinct_counts(df, exact=False)).select(
            F.lit("unique_values").alias("section"), "column", F.lit("count").alias("metric"),
            d("distinct").alias("value"), no_text),
    ]
    if include_types:
        parts.append(data_types(df).select(F.lit("data_types").alias("section"), "column",
                                           F.lit("dtype").alias("metric"), F.lit(None).cast("double").alias("value"),
                                           F.col("dtype").alias("text")))
    if num:
        parts.append(index.moments(num).select(
            F.lit("numeric_summary").alias("section"), "column",
            F.expr("stack(5, 'count', CAST(count AS DOUBLE), 'mean', mean, 'stddev', std, "
                   "'min', min, 'max', max) AS (metric, value)"), no_text))
        fences = index.iqr_outliers(num) if method == "exact" else iqr_outliers(df, num, method=method, rel_err=rel_err)
        parts.append(fences.select(
            F.lit("outliers").alias("section"), "column", F.lit("count").alias("metric"),
            d("outliers").alias("value"), no_text))
    if cat:
        parts.append(index.modes(cat).select(F.lit("most_frequent").alias("section"), "column",
                                             F.lit("mode").alias("metric"), d("count").alias("value"),
                                             F.col("mode").alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- validation rules (X2) ---------------------------------------------------

def rule_failures(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows failing each rule -> ``(rule, failed)``; one scan for all rules.

    A rule is a boolean Column that holds for valid rows; null counts as a
    failure (the value could not be validated)."""
    names = list(rules)
    wide = df.agg(*[F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(f"r{i}")
                    for i, n in enumerate(names)])
    return _stack(wide, [(n, f"r{i}") for i, n in enumerate(names)], "rule", "failed")


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules`` (array of rule names, empty when valid)."""
    flags = [F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]
    return df.withColumn("failed_rules", F.filter(F.array(*flags), lambda x: x.isNotNull()))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (passing rows, failing rows with ``failed_rules``)."""
    tagged = apply_rules(df, rules)
    ok = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.filter(F.size("failed_rules") > 0)
    return ok, bad


def not_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once (X2, a rule over several rows).  A key with a null in it
    violates nothing.  Counts are merged before the exchange; the rows come back by a semi-join, whose
    hot keys adaptive execution splits."""
    keyed = df.filter(_present(keys))
    twice = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    return keyed.join(twice, list(keys), "left_semi")


def without_reference(df: DataFrame, keys: Sequence[str], other: DataFrame, other_keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not stand in the other table (X2); a key with a null in it refers to nothing and
    violates nothing."""
    known = other.select(*[F.col(f"`{b}`").alias(a) for a, b in zip(keys, other_keys)]).distinct()
    return df.filter(_present(keys)).join(known, list(keys), "left_anti")


def _present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"`{k}`").isNotNull()
    return out
