"""Connected components of a link table, by alternating star contractions.

Each half round replaces the links of a node by links to the least node of its
neighbourhood (first over the larger neighbours, then over the smaller ones),
so that the table ends as one star per component after a number of rounds that
is logarithmic in the node count for all practical graphs.  Minima come from a
partially aggregated ``groupBy``; they are written before they are joined, so
that both inputs of the join are plain exchanges and a hub with a large share
of all links is split by adaptive execution.  Nothing is collected but one
checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import shared_table


def _checksum(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _star(e: DataFrame, large: bool) -> DataFrame:
    if large:
        out = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        out = e
    mins = shared_table(out.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
                        .select("c", F.least("c", "m").alias("m")), "star-min")
    j = out.join(mins, out["u"] == mins["c"])
    if large:  # every larger neighbour is linked to the least node around
        nxt = j.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours are linked to the least of them
        nxt = j.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                         F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
    return shared_table(nxt.where(F.col("u") != F.col("v")).distinct(), "star")


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link to another node;
    the component is its least node.  ``links`` may repeat links, in either
    direction, and may hold self links, which count for nothing.  An empty
    table gives an empty result."""
    e = shared_table(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                     .where(F.col("u") != F.col("v")).distinct(), "links")
    seen = _checksum(e)
    for _ in range(max_rounds if seen[0] else 0):
        e = _star(_star(e, True), False)
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
