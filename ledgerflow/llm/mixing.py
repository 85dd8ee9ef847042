"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue whose documents stand in a shuffled order (by a hash of
seed and id) and are served in epochs.  A document's virtual finish time is the
number of words its source has served when it ends, divided by the source's
target.  All documents of all sources are sorted by that time and taken until
the total budget is used up; at virtual time 1 every source has served its
target, so whatever is taken stays within about one document of each target.

Targets: the weights are dealt to the sources in code point order (null last),
repeating; the budget (``budget_share`` of all words) is shared by weight, no
target above ``max_epochs`` times its source's size, the excess reshared by
weight until none is above.  That fixed point is a water level: sources sorted
by cap over weight are capped as long as the level lies above theirs.

Distribution: only ``(id, source, size)`` is shuffled.  A source's running sum is
built from sums per (source, hash prefix), so a source with any share of the
rows is spread over all tasks; the global order is cut into equal ranges of
virtual time, which hold equal shares of the words because the queues are
served in proportion.  The number of prefixes and ranges follows the row count
(at most about ``ROWS_PER_RANGE`` rows each); it does not change the result.

Defined results: a null text has size 0; documents without words cost nothing
and are taken with the place they have in the order; a null id or source is a
value like any other; rows of one id are told apart by their texts, and rows equal in id, source and text
are interchangeable and share what they are given; a source without words has target 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, setup, shared_table

#: Dealt to the sources in order, repeating.
WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
ROWS_PER_RANGE = 20_000


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _digest(text: str) -> Column:
    return F.md5(F.col(text).cast("binary"))


def targets(sizes: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    The windows run over one row per source, the result of an aggregate."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array([F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(budget_share))
    # Level if this source and all above it are uncapped; the source is capped if the level exceeds its own.
    level = (budget - F.coalesce(F.sum("cap").over(by_level), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(by_level), F.lit(0.0)))
    per = per.withColumn("level", level).withColumn("capped", F.col("level") * F.col("w") >= F.col("cap"))
    water = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)  # the first uncapped one's
    return per.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(water * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken, text_md5)``, one row per
    row of ``docs``: how often the mix takes the document and the words that makes."""
    setup(docs.sparkSession)
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = shared_table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                    _words(text_col).alias("size"), key.alias("k"), _digest(text_col).alias("d")), "sizes")
    goals = shared_table(targets(rows, weights, budget_share, max_epochs), "targets")
    n = rows.count()
    digits = max(2, math.ceil(math.log(max(1, n / ROWS_PER_RANGE), 16)))

    # Words served by the source when the document ends, in its first epoch.
    rows = rows.withColumn("prefix", F.substring("k", 1, digits)).withColumn("s", F.struct(F.col("source").alias("v")))
    part = rows.groupBy("s", "prefix").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(F.col("s").alias("s2"), F.col("prefix").alias("prefix2"),
                       F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    queue = Window.partitionBy("s", "prefix").orderBy("k", F.col("doc_id").asc_nulls_last(), "size", "d")
    rows = rows.withColumn("run", F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0))).withColumn("nth", F.row_number().over(queue))
    rows = rows.join(part, (F.col("s") == F.col("s2")) & (F.col("prefix") == F.col("prefix2"))).withColumn("end", F.col("run") + F.col("before"))
    goal = goals.select(F.struct(F.col("source").alias("v")).alias("s3"), "source_size", "target")
    rows = rows.join(goal, F.col("s") == F.col("s3"))
    served = F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch")
    turns = rows.select("doc_id", "source", "s", "prefix", "nth", "size", "k", "d", "end", "source_size", "target", served)
    time = F.when(F.col("target") > 0, (F.col("epoch") * F.col("source_size") + F.col("end")) / F.col("target")).otherwise(0.0)
    turns = shared_table(turns.withColumn("finish", time), "turns")

    # The global order, in ranges of virtual time.
    ranges = max(256, math.ceil(max_epochs * n / ROWS_PER_RANGE))
    # Sources without words come first and cost nothing: they need no place, so they are spread.
    spread = -1 - F.pmod(F.xxhash64("k", "nth"), F.lit(ranges))
    turns = turns.withColumn("range", F.when(F.col("target") > 0, F.floor(F.col("finish") * ranges).cast("long")).otherwise(spread))
    totals = turns.groupBy("range").agg(F.sum("size").alias("words"))
    totals = totals.select(F.col("range").alias("range2"), F.coalesce(F.sum("words").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    place = Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "end", "k",
                                                F.col("doc_id").asc_nulls_last(), "nth").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("place", F.sum("size").over(place)).join(totals, F.col("range") == F.col("range2"))
    budget = goals.agg(F.sum("target").alias("budget"))
    turns = turns.crossJoin(F.broadcast(budget))  # one row
    taken = (F.col("earlier") + F.col("place") <= F.col("budget") + F.lit(1e-6)).cast("long")
    out = turns.groupBy("s", "prefix", "nth").agg(
        F.first("doc_id").alias("doc_id"), F.first("source").alias("source"), F.first("size").alias("size"), F.first("d").alias("d"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum(taken).alias("copies"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), F.col("d").alias("text_md5"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns
    untouched.  Rows equal in id, source and text count as one document that
    is given the copies of all of them."""
    got = mix(docs, id_col, text_col, source_col, **options)
    n = got.groupBy("doc_id", "source", "text_md5").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("m"))
    n = shared_table(n.select(F.struct(F.col("doc_id").alias("a"), F.col("source").alias("b"), F.col("text_md5").alias("c")).alias("__lf_key"),
                              F.struct("c", "m").alias("__lf_n")), "copies-of")
    key = F.struct(F.col(id_col).alias("a"), F.col(source_col).cast("string").alias("b"), _digest(text_col).alias("c"))
    # Texts are moved by the same plan at every size.
    rows = docs.withColumn("__lf_row", key).hint("merge").join(n, F.col("__lf_row") == F.col("__lf_key")).where("__lf_n.c > 0")
    single, repeated = rows.where("__lf_n.m = 1"), rows.where("__lf_n.m > 1").dropDuplicates(["__lf_row"])
    rows = single.union(repeated).withColumn("__lf_copy", F.explode(F.sequence(F.lit(1), F.col("__lf_n.c"))))
    return rows.select(docs.columns)
