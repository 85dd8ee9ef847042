"""Anomaly detectors (M2-M5): z-score, isolation forest, k-means distance.

Each returns the input rows with ``anomaly_score`` (0/1) and the detector's
own columns, so the scatter tables of the reference (M5) are plain selects.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerflow.functions.columns import any_abs_exceeds
from ledgerflow.operators.features import column_moments, present
from ledgerflow.operators.quantiles import quantiles
from ledgerflow.session import cpu_partitions, stored


# --- M2: z-score -------------------------------------------------------------

def zscore_flags(df: DataFrame, cols: Sequence[str], threshold: float = 3.0,
                 null_policy: str = "propagate") -> DataFrame:
    """Flag rows with ``|z| > threshold`` in any column (M2, ddof 0).

    ``null_policy='propagate'`` reproduces the reference: a column holding any
    null or NaN has no z-scores at all, so it never flags.  ``'omit'`` scores the
    present values of such a column.  Constant columns and those holding an infinite value have no
    z-scores either."""
    mom = column_moments(df, cols, fill=False)
    zs = []
    for c in cols:
        m, s, n_missing = mom[c]
        if (null_policy == "propagate" and n_missing) or not s or not math.isfinite(m) or not math.isfinite(s):
            continue
        zs.append((present(c) - F.lit(m)) / F.lit(s))
    flag = any_abs_exceeds(zs, threshold) if zs else F.lit(False)
    return df.withColumn("anomaly_score", flag.cast("int"))


# --- M3: isolation forest ----------------------------------------------------

def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _c_vec(sizes: np.ndarray) -> np.ndarray:
    s = np.asarray(sizes, dtype=float)
    out = np.where(s > 2, 2.0 * (np.log(np.maximum(s - 1, 1)) + 0.5772156649) - 2.0 * (s - 1) / np.maximum(s, 1), 0.0)
    return np.where(s == 2, 1.0, out)


def _build_tree(x: np.ndarray, rng: np.random.Generator, limit: int):
    """One isolation tree as flat arrays (feature, threshold, left, right, size)."""
    feat, thr, left, right, size = [], [], [], [], []

    def grow(idx: np.ndarray, depth: int) -> int:
        node = len(feat)
        feat.append(-1); thr.append(0.0); left.append(-1); right.append(-1); size.append(len(idx))
        if depth >= limit or len(idx) <= 1:
            return node
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if len(usable) == 0:
            return node
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        mask = sub[:, f] < t
        feat[node], thr[node] = f, t
        left[node] = grow(idx[mask], depth + 1)
        right[node] = grow(idx[~mask], depth + 1)
        return node

    grow(np.arange(len(x)), 0)
    return feat, thr, left, right, size


def _path_lengths(x: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, size = (np.asarray(a) for a in tree)
    node = np.zeros(len(x), dtype=np.int64)
    depth = np.zeros(len(x))
    active = feat[node] >= 0
    while active.any():
        i = np.flatnonzero(active)
        f = feat[node[i]]
        go_left = x[i, f] < thr[node[i]]
        node[i] = np.where(go_left, left[node[i]], right[node[i]])
        depth[i] += 1
        active = feat[node] >= 0
    return depth + _c_vec(size)[node]


def isolation_forest(df: DataFrame, cols: Sequence[str], key: str, n_trees: int = 100,
                     sample_size: int = 256, contamination: float = 0.035, seed: int = 42) -> DataFrame:
    """Isolation forest (Liu, Ting and Zhou, 2008) scored on every row (M3).

    Sampling: every tree draws a row with probability ``p`` (1.5 x sample_size / n,
    at most 1).  One hash of the key places a row on the unit interval, which is
    cut into stretches of length ``p``, one per tree, so on a large table one hash
    per row draws for all trees; a small table, where the stretches do not fit,
    takes as many hashes as there are unit intervals.  Then the ``sample_size``
    smallest hashes per tree are kept; only about 1.5 x trees x sample_size rows
    are shuffled whatever the table size, and a retried task draws the same rows.
    A tree that gets no row is an error.  Trees are built in parallel, one
    ``applyInPandas`` group each; the forest (at most trees x (2 x sample_size - 1)
    nodes) is collected and broadcast.  Scoring appends a column to the Arrow
    batches of the table: no row is moved or joined.  Rows whose score exceeds the
    exact ``1 - contamination`` quantile are flagged; the scored table is written once, and the quantile
    and the result are read from it.  An empty table gives an empty result.
    """
    cols = list(cols)
    n = df.count()
    rounds, per_round, p = tree_draws(n, n_trees, sample_size)
    x = df.select(F.col(key), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    u = [(F.xxhash64(F.col(key), F.lit(j), F.lit(seed)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) for j in range(rounds)]
    nth = [F.floor(v / F.lit(p)).cast("int") for v in u]
    draws = F.filter(F.array(*[F.when(i < per_round, i + j * per_round) for j, i in enumerate(nth)]),
                     lambda t: t.isNotNull() & (t < n_trees))
    picked = x.select("*", F.explode(draws).alias("tree")).withColumn(
        "_h", F.xxhash64(F.col(key), F.col("tree"), F.lit(seed + 1)))
    limit = int(math.ceil(math.log2(max(sample_size, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", key]).head(sample_size)
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, t])
        feat, thr, left, right, size = _build_tree(pdf[cols].to_numpy(dtype=float), rng, limit)
        return pd.DataFrame({"tree": [t], "psi": [len(pdf)], "feat": [feat], "thr": [thr],
                             "left": [left], "right": [right], "size": [size]})

    forest_schema = ("tree int, psi int, feat array<int>, thr array<double>, left array<int>, "
                     "right array<int>, size array<int>")
    spark = df.sparkSession
    forest = (picked.repartition(cpu_partitions(spark, n_trees), "tree")
              .groupBy("tree").applyInPandas(build, forest_schema).collect())
    if n and len(forest) < n_trees:
        raise RuntimeError(f"{n_trees - len(forest)} of {n_trees} trees drew no row")
    trees = [(list(r["feat"]), list(r["thr"]), list(r["left"]), list(r["right"]), list(r["size"])) for r in forest]
    psi = max((r["psi"] for r in forest), default=sample_size)
    bc = df.sparkSession.sparkContext.broadcast(trees)
    cpsi = _c(psi)
    at = [df.columns.index(c) for c in cols]
    out_schema = StructType([*df.schema.fields, StructField("iso_score", DoubleType())])
    arrow = to_arrow_schema(out_schema)

    def score(batches):
        for batch in batches:
            xs = np.column_stack([pc.fill_null(pc.cast(batch.column(i), pa.float64()), 0.0).to_numpy(zero_copy_only=False) for i in at])
            h = np.mean([_path_lengths(xs, t) for t in bc.value], axis=0) if len(xs) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.power(2.0, -h / cpsi))], schema=arrow)

    scored = stored(df.mapInArrow(score, out_schema), "forest-scores")
    cut = quantiles(scored, ["iso_score"], [1.0 - contamination]).first()
    return scored.withColumn("anomaly_score", (F.col("iso_score") > F.lit(cut["value"] if cut else 1.0)).cast("int"))


def tree_draws(n: int, n_trees: int, sample_size: int) -> tuple[int, int, float]:
    """Hashes per row, trees drawn by each of them, and the chance ``p`` of a row for a tree."""
    p = min(1.0, 1.5 * sample_size / max(n, 1))
    per_round = min(n_trees, max(1, int(1.0 / p)))
    return -(-n_trees // per_round), per_round, p


# --- M4: k-means distance ----------------------------------------------------

def _distances(cols: Sequence[str], centres: Sequence[Sequence[float]]):
    d = []
    for ctr in centres:
        d.append(F.sqrt(sum((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, ctr))))
    return d


def kmeans_distance(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]] | None = None,
                    k: int = 3, seed: int = 42, quantile: float = 0.95) -> DataFrame:
    """Cluster, distance to the nearest centre, flag above its 95th
    percentile (M4).  ``centres`` given -> deterministic assignment (used by
    the SQL check); otherwise MLlib k-means (k-means|| init, distributed
    Lloyd iterations) fits them.  Distances are JVM expressions against the
    k literal centres; the threshold is an exact quantile.  An empty table gives an empty result."""
    cols = list(cols)
    if df.isEmpty():
        return df.withColumns({"distance_from_centroid": F.lit(0.0), "cluster": F.lit(0), "anomaly_score": F.lit(0)})
    if centres is None:
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.feature import VectorAssembler

        vec = VectorAssembler(inputCols=cols, outputCol="_f").transform(df.select(*cols))
        model = KMeans(k=k, seed=seed, featuresCol="_f").fit(vec)
        centres = [list(map(float, c)) for c in model.clusterCenters()]
    d = _distances(cols, centres)
    dist = F.least(*d) if len(d) > 1 else d[0]
    cluster = F.lit(None).cast("int")
    for i in reversed(range(len(d))):
        cluster = F.when(d[i] == dist, F.lit(i)).otherwise(cluster)
    out = df.withColumn("distance_from_centroid", dist).withColumn("cluster", cluster)
    cut = quantiles(out, ["distance_from_centroid"], [quantile]).first()
    cut = cut["value"] if cut else None  # no row has all its values
    return out.withColumn("anomaly_score", (F.col("distance_from_centroid") > F.lit(cut)).cast("int"))
