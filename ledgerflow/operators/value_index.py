"""Value-frequency index: one exchange from which a whole report is read.

``build`` turns a table into ``(c, v, s, n)`` rows, the count ``n`` of every distinct value
of every column ``c`` (numbers as ``v``, other values as ``s``; whole numbers that a
double may not hold carry both), written once as the one exchange leaves it.  A partial aggregate
merges a hot value before the exchange.  Missing and distinct values, zeros, negatives, moments, modes,
top values, quantiles and outliers then are aggregates over the index, which the raw table no longer takes part in.

Quantiles need no order of the index: sums of ``n`` over ranges of values say which range holds a
rank, and that range alone is cut again until one value is left.

Whole rows are counted the same way if asked for, as 64-bit digests under column ``ROW``: only digests that
occur more than once are written, and only their rows are read again and compared.  A digest travels in the
same two numbers as a value, 11 bits in a negative ``c`` and 53 in ``v``, which a double holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, LongType, NumericType

from ledgerflow.functions.money import cents
from ledgerflow.session import stored

ROW = -1
#: Bits of a digest that stand in ``c``; the other 53 stand in ``v``.
LOW_BITS = 11
#: Ranges into which a doubling of the value and, after that, a range is cut.
CUTS_PER_DOUBLING = 256
CUTS = 1 << 14


def row_digest(df: DataFrame) -> Column:
    """64 bits of a row.  Equal rows have equal digests; rows of equal digests are compared."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


@dataclass
class ValueIndex:
    """The index of ``df``: its table and the columns its numbers stand for."""

    df: DataFrame
    table: DataFrame
    columns: list[str]
    numeric: list[str]
    counts_rows: bool = True

    def _of(self, cols: Sequence[str]) -> DataFrame:
        return self.table.filter(F.col("c").isin([self.columns.index(c) for c in cols] or [ROW - 1]))

    def _named(self, df: DataFrame, *rest) -> DataFrame:
        """``c`` as the column's name."""
        names = F.array(*[F.lit(c) for c in self.columns])
        return df.select(F.element_at(names, F.col("c") + 1).alias("column"), *rest)

    def null_counts(self) -> DataFrame:
        """``(column, missing)``."""
        per = self.table.filter(F.col("c") != ROW).groupBy("c").agg(F.sum(F.when(_missing(), F.col("n")).otherwise(0)).alias("missing"))
        return self._every(per, self.columns, "missing")

    def distinct_counts(self, cols: Sequence[str] | None = None) -> DataFrame:
        """``(column, distinct)`` over present values."""
        cols = list(cols or self.columns)
        per = self._of(cols).groupBy("c").agg(F.count_if(~_missing()).alias("distinct"))
        return self._every(per, cols, "distinct")

    def _every(self, per: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
        """One row per column, 0 where the table has no rows."""
        every = self.df.sparkSession.createDataFrame([(self.columns.index(c), c) for c in cols], "c int, column string")
        return every.join(per, "c", "left").select("column", F.coalesce(F.col(value), F.lit(0)).cast("long").alias(value))

    def duplicates(self) -> DataFrame:
        """One row ``duplicates``, rows minus distinct rows.  Without a digest that occurs twice the rows are not read again."""
        if not self.counts_rows:
            raise ValueError("the index was built without whole rows")
        twice = self.table.filter((F.col("c") == ROW) & (F.col("n") > 1)).select(F.col("s").cast("long").alias("_digest"))
        twice = stored(twice, "digests")  # known to be small or not before the rows are moved
        if twice.isEmpty():
            return self.df.sparkSession.createDataFrame([(0,)], "duplicates long")
        rows = self.df.withColumn("_digest", row_digest(self.df)).join(twice, "_digest", "left_semi")
        g = rows.groupBy(*[F.col(f"`{c}`") for c in self.df.columns]).agg(F.count(F.lit(1)).alias("_n"))
        return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))

    def rows(self) -> DataFrame:
        """One row ``n``; every row counts once under the first column."""
        return self.table.filter(F.col("c") == 0).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))

    def moments(self, cols: Sequence[str] | None = None, money: Sequence[str] = ()) -> DataFrame:
        """``(column, count, distinct, zeros, negatives, mean, std, skewness, kurtosis, min, max)``
        per numeric column: std with ddof 1, skewness adjusted for the sample, excess kurtosis of the population; null where a
        denominator is 0.  Means of columns in ``money`` come from exact cents."""
        cols = list(cols or self.numeric)
        x = self._of(cols).filter(F.col("v").isNotNull())
        exact = F.col("c").isin([self.columns.index(c) for c in money] or [ROW - 1])
        mean = F.when(F.first(exact), F.sum(F.when(exact, cents(F.col("v")) * F.col("n"))).cast("double") / (F.sum("n") * 100).cast("double")) \
            .otherwise(F.sum(F.col("v") * F.col("n")) / F.sum("n"))
        first = x.groupBy("c").agg(
            F.sum("n").alias("count"), F.count(F.lit(1)).alias("distinct"), F.sum(F.when(F.col("v") == 0, F.col("n")).otherwise(0)).alias("zeros"),
            F.sum(F.when(F.col("v") < 0, F.col("n")).otherwise(0)).alias("negatives"), mean.alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))
        d = F.col("v") - F.col("mean")
        n = F.col("count").cast("double")
        second = x.join(F.broadcast(first.select("c", "mean")), "c").groupBy("c").agg(  # one row per column
            F.sum(d * d * F.col("n")).alias("s2"), F.sum(d * d * d * F.col("n")).alias("s3"), F.sum(d * d * d * d * F.col("n")).alias("s4"))
        spread = F.when((F.col("min") < F.col("max")) & (F.col("s2") > 0), F.col("s2"))  # a constant column has none
        m2 = spread / n
        out = first.join(second, "c").withColumns({
            "std": F.when(F.col("count") > 1, F.sqrt(F.coalesce(spread, F.col("s2") * 0) / (n - 1))),
            "skewness": F.when(F.col("count") > 2, F.col("s3") / n / F.pow(m2, 1.5) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))),
            "kurtosis": F.col("s4") / n / (m2 * m2) - 3})
        return self._named(out, "count", "distinct", "zeros", "negatives", "mean", "std", "skewness", "kurtosis", "min", "max")

    def top_values(self, cols: Sequence[str], k: int = 5, dropna: bool = True) -> DataFrame:
        """``(column, rank, value, count)``, ties by value; ``row_number() <= k`` limits each task to k rows a column."""
        x = self._of(cols).withColumn("value", F.coalesce("s", F.col("v").cast("string")))
        x = x.filter(F.col("value").isNotNull()) if dropna else x
        w = Window.partitionBy("c").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
        x = x.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        return self._named(x, "rank", "value", F.col("n").alias("count"))

    def modes(self, cols: Sequence[str]) -> DataFrame:
        """``(column, mode, count)``, null a candidate."""
        return self.top_values(cols, 1, dropna=False).select("column", F.col("value").alias("mode"), "count")

    def quantiles(self, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
        """Exact, linearly interpolated ``(column, prob, value)``; NaN is no value.

        The range that holds a rank is cut until its ends are equal, first by logarithm and then into
        equal widths.  A pass reads the index and moves sums by range; the driver gets one row per column, quantile and end."""
        x = self._of(cols).filter(F.col("v").isNotNull() & ~F.isnan("v")).select("c", "v", "n")
        size = F.signum("v") * F.log2(F.abs("v") + 1)
        first = _sums(x.groupBy("c", F.floor(size * CUTS_PER_DOUBLING).alias("b")), "c").withColumn("total", F.sum("m").over(Window.partitionBy("c")))
        first = first.withColumn("prob", F.explode(F.array(*[F.lit(float(q)) for q in probs]))).withColumn("pos", F.col("prob") * (F.col("total") - 1))
        first = first.withColumn("rank", F.explode(F.array(F.floor("pos"), F.ceil("pos")))).withColumn("start", F.lit(0))
        found, at, value = _holding(first).select("c", "prob", "pos", "rank", "lo", "hi", "start").distinct().collect(), {}, {}
        for f in found:
            at[f["c"], f["prob"]] = f["pos"]
        while found:
            ranges, open_ = {}, set()  # the number of a range still to be cut; the ranks in it
            for f in found:
                if f["lo"] == f["hi"]:
                    value[f["c"], f["rank"]] = f["lo"]
                else:
                    open_.add((f["c"], ranges.setdefault((f["c"], f["lo"], f["hi"]), len(ranges)), f["rank"], f["start"]))
            found = self._cut(x, ranges, open_) if open_ else []
        got = []
        for (c, q), pos in at.items():
            lo, hi, frac = value[c, math.floor(pos)], value[c, math.ceil(pos)], pos - math.floor(pos)
            got.append((self.columns[c], q, lo if frac == 0 or lo == hi else lo + (hi - lo) * frac))
        return self.df.sparkSession.createDataFrame(got, "column string, prob double, value double")

    def _cut(self, x: DataFrame, ranges: dict, ranks: set) -> list:
        """The narrower range of values that holds each rank of ``(c, r, rank, start)``, ``start`` being the ranks before range ``r``."""
        spark = self.df.sparkSession
        held = F.broadcast(spark.createDataFrame([(*k, r) for k, r in ranges.items()], "c int, lo double, hi double, r int"))
        y = x.join(held, "c").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        cut = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CUTS), F.lit(CUTS - 1))
        # The last value stands alone, so that every pass divides a range.
        sums = _sums(y.groupBy("c", "r", F.when(F.col("v") == F.col("hi"), F.lit(CUTS)).otherwise(cut).alias("b")), "c", "r")
        want = F.broadcast(spark.createDataFrame(sorted(ranks), "c int, r int, rank long, start long"))
        return _holding(sums.join(want, ["c", "r"])).select("c", "rank", "lo", "hi", "start").collect()

    def iqr_outliers(self, cols: Sequence[str] | None = None, whisker: float = 1.5) -> DataFrame:
        """``(column, q1, q3, lower, upper, outliers)``, values outside the quartiles' fences."""
        cols = list(cols or self.numeric)
        q = self.quantiles(cols, [0.25, 0.75]).groupBy("column").agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"), F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
        reach = (F.col("q3") - F.col("q1")) * whisker
        q = q.withColumn("lower", F.col("q1") - reach).withColumn("upper", F.col("q3") + reach)
        x = self._named(self._of(cols).filter(F.col("v").isNotNull() & ~F.isnan("v")), "v", "n").join(F.broadcast(q), "column")  # one row per column
        out = F.sum(F.when((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper")), F.col("n")).otherwise(0))
        return x.groupBy("column", "q1", "q3", "lower", "upper").agg(out.alias("outliers"))


def _missing() -> Column:
    return F.col("v").isNull() & F.col("s").isNull()


def _sums(ranges, *of: str) -> DataFrame:
    """Per range its rows ``m``, its least and largest value, and the rows ``upto`` its end."""
    upto = F.sum("m").over(Window.partitionBy(*of).orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    return ranges.agg(F.sum("n").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("upto", upto)


def _holding(ranges: DataFrame) -> DataFrame:
    """The ranges that hold their ``rank``; ``start`` becomes the ranks before them."""
    end = F.col("start") + F.col("upto")
    return ranges.filter((F.col("rank") < end) & (F.col("rank") >= end - F.col("m"))).withColumn("start", end - F.col("m"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, distinct)`` over present values.  One row ``(c, v, s)`` for a value, merged before
    the one exchange, instead of a row as wide as the table."""
    items = F.array(*[value_item(i, F.col(f"`{c}`"), df.schema[c].dataType) for i, c in enumerate(cols)])
    long = df.select(F.explode(items).alias("x")).select("x.*").filter(~_missing())
    per = long.groupBy("c", "v", "s").agg(F.lit(1)).groupBy("c").agg(F.count(F.lit(1)).alias("distinct"))
    every = df.sparkSession.createDataFrame(list(enumerate(cols)), "c int, column string")
    return every.join(per, "c", "left").select("column", F.coalesce("distinct", F.lit(0)).cast("long").alias("distinct"))


def value_item(c: int, col: Column, kind: DataType) -> Column:
    """A value as ``(c, v, s)``: numbers as ``v``, others and what a double may not tell apart as ``s``."""
    number = isinstance(kind, NumericType)
    text = not number or isinstance(kind, (LongType, DecimalType))
    return F.struct(F.lit(c).alias("c"), (col if number else F.lit(None)).cast("double").alias("v"), (col if text else F.lit(None)).cast("string").alias("s"))


def build(df: DataFrame, rows: bool = True) -> ValueIndex:
    """The index of every column of ``df`` and, if ``rows``, of its whole rows; reads ``df`` once."""
    items = [value_item(i, F.col(f"`{f.name}`"), f.dataType) for i, f in enumerate(df.schema.fields)]
    x = df
    if rows:  # a row's digest takes no text, so that it moves as narrow as a number
        x = df.withColumn("_digest", row_digest(df))
        low = F.col("_digest").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int")
        items.insert(0, F.struct((F.lit(ROW) - low).alias("c"), F.shiftright("_digest", LOW_BITS).cast("double").alias("v"), F.lit(None).cast("string").alias("s")))
    counts = x.select(F.explode(F.array(*items)).alias("x")).groupBy(F.col("x.c").alias("c"), F.col("x.v").alias("v"), F.col("x.s").alias("s")).agg(
        F.count(F.lit(1)).alias("n"))
    of_row = F.col("c") <= ROW
    digest = F.shiftleft(F.col("v").cast("long"), LOW_BITS).bitwiseOR((F.lit(ROW) - F.col("c")).cast("long"))
    table = counts.filter(~of_row | (F.col("n") > 1)).select(
        F.greatest("c", F.lit(ROW)).alias("c"), F.when(~of_row, F.col("v")).alias("v"), F.when(of_row, digest.cast("string")).otherwise(F.col("s")).alias("s"), "n")
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return ValueIndex(df, stored(table, "value-index"), df.columns, numeric, rows)
