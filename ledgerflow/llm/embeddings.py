"""Embedding near-dedup by collision counting over sorted projections.

Vectors are made unit vectors in double precision.  A *sort* arranges them
along one random direction, inside cells given by the signs of ``cell_bits``
other random directions; two vectors collide in a sort if they share the cell
and lie at most ``window`` apart (a window centred on either of them; windows
are cut into bins of that width and joined with the same and the next bin).
Collisions of a pair are counted over all sorts; pairs with at least
``MIN_COLLISIONS`` are verified by their cosine.

Calibration.  For a pair of cosine c the chance of a collision in one sort is
``(1 - acos(c)/pi)**cell_bits * P(|N(0, 2 - 2c)| <= window)``; the number of
sorts is the least one whose binomial tail reaches ``RECALL`` at the threshold
cosine itself, so closer pairs are found with a higher probability still.
``cell_bits`` is log2 of the number of distinct vectors less 3: cells keep about
eight unrelated vectors each at any size, which keeps the work near linear.

Equal vectors are collapsed first and counted by their number.  A cell with a
large share of the vectors is split by the sorted projection and by adaptive
execution's skew join.  Nothing is capped: every link at or above the threshold
that collides often enough is verified, and none below it is returned.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing; vectors of different lengths do not
link; rows without an id link with nothing and have a null component; rows of
equal id and different vectors count as one node; an empty table gives an empty
result; extra columns (labels too) are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_rows, setup, shared_table
from ledgerflow.llm.graph import components

COSINE = 0.95
RECALL = 0.999
MIN_COLLISIONS = 2
#: Window over the standard deviation of the projected distance at the threshold.
WINDOW_SIGMAS = 2.0


def collision_chance(cosine: float, cell_bits: int, window: float) -> float:
    """Chance that a pair of this cosine collides in one sort."""
    spread = math.sqrt(max(0.0, 2 - 2 * cosine))
    near = 1.0 if spread == 0 else math.erf(window / spread / math.sqrt(2))
    return (1 - math.acos(min(1.0, cosine)) / math.pi) ** cell_bits * near


def sorts_needed(chance: float, hits: int = MIN_COLLISIONS, recall: float = RECALL) -> int:
    """Least number of sorts in which a pair collides ``hits`` times with probability ``recall``."""
    m = hits
    while sum(math.comb(m, k) * chance**k * (1 - chance) ** (m - k) for k in range(hits)) > 1 - recall:
        m += 1
    return m


@functools.lru_cache(maxsize=4)
def directions(dim: int, sorts: int, cell_bits: int) -> np.ndarray:
    """Random directions, the same on every executor: per sort one to sort by and ``cell_bits`` for the cell."""
    return np.random.default_rng([20, dim, sorts, cell_bits]).standard_normal((dim, sorts * (cell_bits + 1)))


def unit(vector: list | None) -> np.ndarray | None:
    """The vector divided by its length; None if it cannot link."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    if top == 0:
        return None
    v = v / top
    return v / math.sqrt(float(v @ v))


def _keyed(rows):
    h = []
    for e in rows["e"]:
        h.append(None if unit(e) is None else xxhash.xxh3_128_digest((np.array(e, dtype=np.float64) + 0.0).tobytes()))
    return {"id": rows["id"], "h": h}


def _projected(vectors: DataFrame, sorts: int, bits: int) -> DataFrame:
    def run(rows):
        cells, along = [None] * len(rows["e"]), [None] * len(rows["e"])
        units = [unit(e) for e in rows["e"]]
        for dim in {len(u) for u in units}:
            at = [i for i, u in enumerate(units) if len(u) == dim]
            p = (np.stack([units[i] for i in at]) @ directions(dim, sorts, bits)).reshape(len(at), sorts, bits + 1)
            cell = (p[:, :, 1:] > 0) @ (1 << np.arange(bits, dtype=np.int64)) + (np.int64(dim) << np.int64(bits))
            for k, i in enumerate(at):
                cells[i], along[i] = cell[k], p[k, :, 0].copy()
        return {"id": rows["id"], "cells": cells, "along": along}

    got = map_rows(vectors.select("id", "e"), run, "id long, cells array<long>, along array<double>")
    return got


def _collisions(projected: DataFrame, window: float) -> DataFrame:
    """``(a, b)``, a < b, of pairs with at least ``MIN_COLLISIONS`` collisions."""
    rows = projected.select("id", F.posexplode(F.arrays_zip("cells", "along")).alias("sort", "x")).select(
        "id", "sort", F.col("x.cells").alias("cell"), F.col("x.along").alias("p"), F.floor(F.col("x.along") / window).alias("bin"))
    queries = rows.select("sort", "cell", "bin", F.col("id").alias("i"), F.col("p").alias("pi"))
    others = rows.select("sort", "cell", F.explode(F.array(F.col("bin"), F.col("bin") - 1)).alias("bin"), F.col("id").alias("j"),
                         F.col("p").alias("pj"), F.col("bin").alias("own"))
    near = ((F.col("own") == F.col("bin")) & (F.col("i") < F.col("j"))) | (
        (F.col("own") != F.col("bin")) & (F.col("pj") - F.col("pi") <= window))
    met = queries.join(others, ["sort", "cell", "bin"]).where(near)
    return met.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COLLISIONS).select("a", "b")


def _links(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    left = vectors.select(F.col("id").alias("a"), F.col("e").alias("ea"))
    right = vectors.select(F.col("id").alias("b"), F.col("e").alias("eb"))

    def run(rows):
        ok = np.zeros(len(rows["a"]), dtype=bool)
        lengths = np.array([len(e) for e in rows["ea"]])
        for dim in set(lengths.tolist()):  # a batch may hold pairs of several lengths
            at = np.flatnonzero(lengths == dim)
            x, y = (np.stack([unit(rows[c][i]) for i in at]) for c in ("ea", "eb"))
            ok[at] = np.einsum("ij,ij->i", x, y) >= cosine
        return {c: [v for v, k in zip(rows[c], ok) if k] for c in ("a", "b")}

    both = pairs.join(left, "a").join(right, "b").where(F.size("ea") == F.size("eb"))
    return map_rows(both.select("a", "b", "ea", "eb").where("a <> b"), run, "a long, b long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``."""
    setup(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("e"))
    keyed = shared_table(map_rows(rows, _with_vector(_keyed), f"id long, h binary, e {rows.schema['e'].dataType.simpleString()}"), "vectors")
    distinct = shared_table(keyed.where("h is not null and id is not null").groupBy("h").agg(
        F.min(F.struct("id", "e")).alias("r"), F.count(F.lit(1)).alias("n")).select("h", "n", "r.id", "r.e"), "distinct-vectors")
    size = distinct.count()
    window = WINDOW_SIGMAS * math.sqrt(2 - 2 * cosine)
    bits = max(1, round(math.log2(max(2, size))) - 3)
    sorts = sorts_needed(collision_chance(cosine, bits, window))
    parts = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    projected = shared_table(_projected(distinct.repartition(parts), sorts, bits), "projections")
    pairs = shared_table(_collisions(projected, window), "collisions")
    links = shared_table(_links(pairs, distinct, cosine), "vector-links")

    # Links between rows: those of other distinct vectors, weighted by their rows, and those among equal vectors.
    ends = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    weight = distinct.select(F.col("id").alias("b"), "n")
    degree = ends.join(weight, "b").groupBy("a").agg(F.sum("n").alias("d"))
    comps = components(links)
    info = distinct.join(degree, distinct["id"] == degree["a"], "left").join(comps, distinct["id"] == comps["node"], "left")
    info = shared_table(info.select("h", (F.coalesce("d", F.lit(0)) + F.col("n") - 1).alias("links"),
                                    F.coalesce("component", "id").alias("component")), "vector-classes")
    out = keyed.select("id", F.when(F.col("id").isNotNull(), F.col("h")).alias("h")).join(info, "h", "left")
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                     F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _with_vector(fn):
    return lambda rows: fn(rows) | {"e": rows["e"]}
