"""Feature ranking and standardisation (L1, L2, M1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.columns import columns_of_type


def feature_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns except ``exclude`` (the label is never a feature)."""
    return [c for c in columns_of_type(df, "numeric") if c not in set(exclude)]


def feature_importance(df: DataFrame, label: str, features: Sequence[str] | None = None,
                       num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> DataFrame:
    """Random-forest importances (L1) -> ``(feature, importance)``.

    MLlib trains the trees distributed (one pass per tree level over the
    data); nulls are filled with 0 first, as the reference does before its
    model.  The importance vector itself is one number per feature."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    features = list(features or feature_columns(df, [label]))
    data = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features],
                     F.col(label).cast("double").alias("_label")).filter(F.col("_label").isNotNull())
    vec = VectorAssembler(inputCols=features, outputCol="_features").transform(data)
    model = RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=num_trees,
                                   maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed).fit(vec)
    imp = model.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_features(importances: DataFrame, k: int = 20) -> list[str]:
    """Names of the ``k`` most important features (L2); ties by name."""
    return [r["feature"] for r in importances.orderBy(F.col("importance").desc(), "feature").limit(k).collect()]


def column_moments(df: DataFrame, cols: Sequence[str], fill: bool) -> dict[str, tuple[float, float, int]]:
    """Mean, population std and number of missing values (null and NaN) per column in one
    aggregate (a few numbers per column come back to the driver).  The std of a
    constant column is exactly 0.  ``fill`` counts missing values as 0."""
    exprs = []
    for i, c in enumerate(cols):
        x = present(c)
        y = F.coalesce(x, F.lit(0.0)) if fill else x
        exprs += [F.avg(y).alias(f"m{i}"), F.when(F.min(y) < F.max(y), F.stddev_pop(y)).when(F.count(y) > 0, 0.0).alias(f"s{i}"),
                  F.count_if(x.isNull()).alias(f"n{i}")]
    row = df.agg(*exprs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"], row[f"n{i}"]) for i, c in enumerate(cols)}


def present(c: str) -> Column:
    """A column as double, NaN as null."""
    return F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), suffix: str = "") -> DataFrame:
    """``(x - mean) / std`` with ddof 0 after filling nulls with 0 (M1);
    a zero std divides by 1, as the reference's scaler does."""
    mom = column_moments(df, cols, fill=True)
    out = [F.col(k) for k in keep]
    for c in cols:
        m, s, _ = mom[c]
        s = s if s else 1.0
        x = F.coalesce(present(c), F.lit(0.0))
        out.append(((x - F.lit(m)) / F.lit(s)).alias(c + suffix))
    return df.select(*out)
