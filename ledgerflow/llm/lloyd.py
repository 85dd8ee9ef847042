"""Centroid clustering by dimension-sharded Lloyd rounds, in exact integers.

Vectors become integers (floor of ``scale`` times the component) and are written once as a table
with one array column per *block* of dimensions.  A round:

1. a task of block ``b`` reads that column alone and computes, for its rows, the exact
   squared distances to the block's slice of every centroid;
2. the partial distances of a vector meet by its row number and are added
   (one row per block and vector, so a sum never gathers more than the blocks);
   the least total, and the smaller number among ties, is the assignment;
3. every block joins the assignments to its column and sums its own components
   per centroid, first inside the task, then over all tasks; the floor of the mean
   replaces its slice of every centroid that has vectors.

What the driver holds is the centroids: ``k`` times the dimension, a bound set by the
parameters.  Assignments of a round are written to the shared folder before the blocks
read them.  The sums over blocks are keyed by row number, which no hot value can skew.

Defined results: vectors of another length than ``dim``, null ones and those with a
null or non-finite component are left out; components beyond +-2**27 after scaling
count as that bound, so that distances fit 64 bits; initial centroids are ordered by
their hash, then by their components (rows of one id), a null id hashing as the empty
string; fewer vectors than ``k`` start as many centroids; an empty table gives
an empty result; extra columns (labels too) are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_rows, setup, shared_table

DIM = 64
K = 40
ROUNDS = 5
SCALE = 256
SEED = "2:"
BLOCKS = 4
LIMIT = 1 << 27


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, dim: int | None = None) -> DataFrame:
    """``vectors`` without null vectors and those holding null or non-finite components (or of
    another length than ``dim``), with ``v``, the components as integers ``floor(scale * x)``."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    # A comparison with NaN is false for none of Spark's orderings, so both ends are tested.
    fine = F.forall(x, lambda c: F.coalesce((c > F.lit(float("-inf"))) & (c < F.lit(float("inf"))), F.lit(False)))
    ok = vectors.where(F.col(vector_col).isNotNull() & fine & ((F.size(vector_col) == dim) if dim else (F.size(vector_col) > 0)))
    low, high = F.lit(float(-LIMIT)), F.lit(float(LIMIT))
    whole = F.transform(x, lambda c: F.greatest(low, F.least(high, F.floor(c * F.lit(float(scale))).cast("double"))).cast("int"))
    return ok.select(F.col(id_col).alias("id"), whole.alias("v"), *[F.col(c) for c in ok.columns if c == "label"])


def block_edges(dim: int, blocks: int) -> list[int]:
    return [dim * b // blocks for b in range(blocks + 1)]


def partial_distances(rows: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Squared distances of all ``rows`` to all ``slices``, in 64-bit integers."""
    out = np.empty((len(rows), len(slices)), dtype=np.int64)
    for at in range(0, len(rows), 512):
        d = rows[at:at + 512, None, :] - slices[None, :, :]
        out[at:at + 512] = np.einsum("ijk,ijk->ij", d, d)
    return out


def _matrix(values: list) -> np.ndarray:
    return np.array(values, dtype=np.int64)


def assignments(table: DataFrame, centroids: np.ndarray, edges: list[int]) -> DataFrame:
    """``(row, cluster, distance)`` of every row of the blocked table."""
    parts = None
    for b in range(len(edges) - 1):
        mine = centroids[:, edges[b]:edges[b + 1]]

        def run(rows, mine=mine):
            return {"row": rows["row"], "d": list(partial_distances(_matrix(rows["x"]), mine)) if rows["x"] else []}

        got = map_rows(table.select("row", F.col(f"b{b}").alias("x")), run, "row long, d array<long>")
        parts = got if parts is None else parts.union(got)
    total = parts.groupBy("row").agg(F.collect_list("d").alias("ds")).select("row", F.aggregate(
        F.slice("ds", 2, len(edges)), F.get("ds", F.lit(0)), lambda a, d: F.zip_with(a, d, lambda x, y: x + y)).alias("d"))
    least = F.array_min(F.transform("d", lambda x, i: F.struct(x.alias("distance"), i.alias("cluster"))))
    return total.select("row", least.alias("m")).select("row", "m.cluster", "m.distance")


def _moved(table: DataFrame, assigned: DataFrame, centroids: np.ndarray, edges: list[int]) -> np.ndarray:
    """The centroids after every block has averaged its own slice."""
    sums = None
    for b in range(len(edges) - 1):
        width = edges[b + 1] - edges[b]
        mine = table.select("row", F.col(f"b{b}").alias("x")).join(assigned.select("row", "cluster"), "row")
        s = mine.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(width)]).alias("s"))
        s = s.select(F.lit(b).alias("block"), "cluster", "n", "s")
        sums = s if sums is None else sums.union(s)
    out = centroids.copy()
    for r in sums.collect():  # centroids x blocks rows
        out[r["cluster"], edges[r["block"]]:edges[r["block"] + 1]] = [x // r["n"] for x in r["s"]]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, k: int = K,
                    rounds: int = ROUNDS, scale: int = SCALE, blocks: int = BLOCKS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of every vector that counts, and the final centroids."""
    setup(vectors.sparkSession)
    edges = block_edges(dim, blocks)
    whole = integer_vectors(vectors, scale, id_col, vector_col, dim)
    cuts = [F.slice("v", edges[b] + 1, edges[b + 1] - edges[b]).alias(f"b{b}") for b in range(blocks)]
    table = shared_table(whole.select(F.monotonically_increasing_id().alias("row"), "id", *cuts), "vector-blocks")
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = table.select(F.concat(*[f"b{b}" for b in range(blocks)]).alias("v"), key.alias("key")).orderBy("key", "v").limit(k)
    centroids = _matrix([r["v"] for r in first.collect()]).reshape(-1, dim)
    for _ in range(rounds if len(centroids) else 0):
        assigned = shared_table(assignments(table, centroids, edges), "assignments")
        centroids = _moved(table, assigned, centroids, edges)
    if not len(centroids):
        return table.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    last = shared_table(assignments(table, centroids, edges), "assignments")
    return table.select("row", "id").join(last, "row").select("id", "cluster", "distance"), centroids


def exact_sum(c: str) -> Column:
    """A sum that cannot overflow on the way; null if it does not fit 64 bits."""
    return F.sum(F.col(c).cast("decimal(38,0)")).try_cast("long")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_report(vectors: DataFrame, **kw) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector."""
    got, centroids = cluster_vectors(vectors, **kw)
    spark = vectors.sparkSession
    got = shared_table(got, "clusters")
    by = got.groupBy("cluster").agg(exact_sum("distance").alias("cluster_inertia"))
    total = got.agg(exact_sum("distance").alias("inertia"))
    digests = spark.createDataFrame([(i, centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # One row per centroid: k rows at most.
    facts = by.join(digests, "cluster").crossJoin(total)
    return got.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
