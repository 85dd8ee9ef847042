"""Registered queries: feature ranking, standardisation, anomaly detectors
(L1, L2, M1-M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.columns import pca_projection
from ledgerflow.functions.money import cents
from ledgerflow.operators.anomaly import isolation_forest, kmeans_distance, zscore_flags
from ledgerflow.operators.features import feature_columns, feature_importance, standardize, top_features
from ledgerflow.operators.joins import merge
from ledgerflow.operators.windows import window_features
from ledgerflow.plans.agg_queries import _CARD_TS, card
from ledgerflow.plans.quality_queries import _PCA, PCA_NUM
from ledgerflow.plans.registry import register, rounded
from ledgerflow.session import stored
from ledgerflow.sources.fixtures import load

CARD_FEATURES = ["TransactionAmt", "TransactionDT", "card1", "id_01", "id_02"]
PCA_FEATURES = [c for c in PCA_NUM if c not in ("time", "class")]


def merged(spark, sf_dir):
    """Card transactions left-joined to identity, with time columns."""
    return merge(card(spark, sf_dir), load(spark, sf_dir, "tx_identity"), "TransactionID", "left")


def fraud_features(spark, sf_dir):
    """Merged card data plus the window features (the reference's model input)."""
    m = merged(spark, sf_dir).withColumn("_cents", cents(F.col("TransactionAmt")))
    return window_features(m.drop("month"), ["sample_datetime", "TransactionID"], cents_col="_cents").drop("_cents")


_MERGED = """card AS (SELECT *, TIMESTAMP '2024-01-01' + TransactionDT * INTERVAL 1 SECOND AS sample_datetime
        FROM tx_card),
m AS (SELECT * FROM card LEFT JOIN tx_identity USING (TransactionID))"""


def _std_sql(cols):
    return ", ".join(f"(coalesce(CAST({c} AS DOUBLE), 0) - avg(coalesce(CAST({c} AS DOUBLE), 0)) OVER ()) / "
                     f"coalesce(nullif(stddev_pop(coalesce(CAST({c} AS DOUBLE), 0)) OVER (), 0), 1) AS {c}"
                     for c in cols)


@register("m1_standardize", views=("tx_card", "tx_identity"), sql=f"""
WITH {_MERGED}
SELECT TransactionID, {", ".join(f"round({c}, 6) AS {c}" for c in CARD_FEATURES)}
FROM (SELECT TransactionID, {_std_sql(CARD_FEATURES)} FROM m)""")
def m1_standardize(spark, sf_dir):
    """M1: features with nulls as 0, centred and scaled by the population std."""
    return rounded(standardize(merged(spark, sf_dir), CARD_FEATURES, keep=["TransactionID"]))


def _z_sql(cols=None):
    conds = []
    for c in cols or CARD_FEATURES:
        x = f"CAST({c} AS DOUBLE)"
        conds.append(f"(CASE WHEN count(*) FILTER (WHERE {c} IS NULL) OVER () > 0 THEN false "
                     f"ELSE coalesce(abs(({x} - avg({x}) OVER ()) / nullif(stddev_pop({x}) OVER (), 0)) > 3, false) END)")
    return " OR ".join(conds)


@register("m2_zscore_flags", views=("tx_card", "tx_identity"), sql=f"""
WITH {_MERGED}
SELECT TransactionID, TransactionAmt, CAST(sample_datetime AS DATE) AS day,
       CAST({_z_sql()} AS INTEGER) AS anomaly_score FROM m""")
def m2_zscore_flags(spark, sf_dir):
    """M2/M5: |z| > 3 in any feature; columns with missing values never flag."""
    z = zscore_flags(merged(spark, sf_dir), CARD_FEATURES, 3.0)
    return z.select("TransactionID", "TransactionAmt", "day", "anomaly_score")


#: All numeric columns of the model input but label and key (fixed: the SQL names them); L2 keeps 20, so all of them.
FRAUD_FEATURES = ["TransactionDT", "TransactionAmt", "card1", "hour", "week", "day_of_week", "id_01", "id_02", "month", "next_transaction_amt",
                  "prev_transaction_amt", "rolling_avg_3", "rolling_max", "rolling_min", "row_number", "cumulative_sum", "rank"]
_FEATURES = f"""{_CARD_TS},
w AS (SELECT * EXCLUDE (month), month, CAST(round(TransactionAmt * 100) AS BIGINT) AS c FROM cardp),
feat AS (SELECT w.* EXCLUDE (c), id_01, id_02,
  row_number() OVER (PARTITION BY month ORDER BY sample_datetime, TransactionID) AS row_number,
  CASE WHEN TransactionAmt IS NOT NULL THEN rank() OVER (PARTITION BY month ORDER BY TransactionAmt DESC NULLS LAST) END AS rank,
  lead(TransactionAmt) OVER o AS next_transaction_amt, lag(TransactionAmt) OVER o AS prev_transaction_amt,
  CASE WHEN TransactionAmt IS NOT NULL THEN CAST(sum(c) OVER (PARTITION BY month ORDER BY sample_datetime,
    TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0 END AS cumulative_sum,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN avg(TransactionAmt) OVER r END AS rolling_avg_3,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN max(TransactionAmt) OVER r END AS rolling_max,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN min(TransactionAmt) OVER r END AS rolling_min
  FROM w LEFT JOIN tx_identity USING (TransactionID)
  WINDOW o AS (ORDER BY sample_datetime, TransactionID), r AS (ORDER BY sample_datetime, TransactionID ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@register("m1_standardize_features", views=("tx_card", "tx_identity"), sql=f"""
WITH {_FEATURES}
SELECT TransactionID, {", ".join(f"round({c}, 5) AS {c}" for c in FRAUD_FEATURES)}
FROM (SELECT TransactionID, {_std_sql(FRAUD_FEATURES)} FROM feat)""")
def m1_standardize_features(spark, sf_dir):
    """M1: every feature of the model input, nulls as 0, centred and scaled by the population std."""
    f = stored(fraud_features(spark, sf_dir), "fraud-features")
    return rounded(standardize(f, FRAUD_FEATURES, keep=["TransactionID"]), digits=5)


@register("m2_zscore_flags_features", views=("tx_card", "tx_identity"), sql=f"""
WITH {_FEATURES}
SELECT TransactionID, TransactionAmt, CAST(sample_datetime AS DATE) AS day,
       CAST({_z_sql(FRAUD_FEATURES)} AS INTEGER) AS anomaly_score FROM feat""")
def m2_zscore_flags_features(spark, sf_dir):
    """M2/M5: |z| > 3 in any feature of the model input; columns with missing values never flag."""
    f = stored(fraud_features(spark, sf_dir), "fraud-features")
    return zscore_flags(f, FRAUD_FEATURES, 3.0).select("TransactionID", "TransactionAmt", "day", "anomaly_score")


def _pca_std(spark, sf_dir):
    return standardize(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_FEATURES, keep=["time"])


def _kmeans_sql():
    dist = []
    for i in range(3):
        dist.append("sqrt(" + " + ".join(f"pow(s.{c} - c{i}.{c}, 2)" for c in PCA_FEATURES) + ")")
    return f"""WITH {_PCA},
s AS (SELECT time, {_std_sql(PCA_FEATURES)} FROM pca),
c0 AS (SELECT * FROM s WHERE time = (SELECT min(time) FROM s)),
c1 AS (SELECT * FROM s WHERE time = (SELECT min(time) FROM s WHERE time > (SELECT min(time) FROM s))),
c2 AS (SELECT * FROM s WHERE time = (SELECT min(time) FROM s WHERE time > (SELECT min(time) FROM s
          WHERE time > (SELECT min(time) FROM s)))),
d AS (SELECT s.time, {dist[0]} AS d0, {dist[1]} AS d1, {dist[2]} AS d2 FROM s, c0, c1, c2),
e AS (SELECT time, least(d0, d1, d2) AS dist,
             CASE WHEN d0 = least(d0, d1, d2) THEN 0 WHEN d1 = least(d0, d1, d2) THEN 1 ELSE 2 END AS cluster FROM d)
SELECT time, CAST(cluster AS INTEGER) AS cluster, round(dist, 6) AS distance_from_centroid,
       CAST(dist > (SELECT quantile_cont(dist, 0.95) FROM e) AS INTEGER) AS anomaly_score FROM e"""


@register("m4_kmeans_fixed", views=("tx_pca",), sql=_kmeans_sql())
def m4_kmeans_fixed(spark, sf_dir):
    """M4 with fixed centres (the three earliest transactions, standardised):
    nearest centre, distance, flag above the exact 95th percentile."""
    s = _pca_std(spark, sf_dir)
    first = s.orderBy("time").limit(3).collect()
    centres = [[r[c] for c in PCA_FEATURES] for r in first]
    out = kmeans_distance(s, PCA_FEATURES, centres)
    return rounded(out.select("time", "cluster", "distance_from_centroid", "anomaly_score"),
                   ["distance_from_centroid"])


@register("m4_kmeans_fitted")
def m4_kmeans_fitted(spark, sf_dir):
    """M4: MLlib k-means (k=3) on the standardised PCA features; flags the
    farthest 5 % from their centre."""
    s = standardize(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_FEATURES, keep=["time", "amount"], suffix="_z")
    out = kmeans_distance(s, [f"{c}_z" for c in PCA_FEATURES], None, k=3, seed=42)
    return out.select("time", "amount", "cluster", "distance_from_centroid", "anomaly_score")


def _top_fraud_features(spark, sf_dir):
    """The model input, written once, and its 20 most important features (L2)."""
    f = stored(fraud_features(spark, sf_dir), "fraud-features")
    return f, top_features(feature_importance(f, "isFraud", feature_columns(f, ["isFraud", "TransactionID"])), 20)


def _forest(df, cols):
    s = standardize(df, cols, keep=["TransactionID", "day", "TransactionAmt"], suffix="_z")
    out = isolation_forest(s, [f"{c}_z" for c in cols], "TransactionID", contamination=0.035)
    return out.select("TransactionID", "TransactionAmt", "day", "iso_score", "anomaly_score")


@register("m3_isolation_forest")
def m3_isolation_forest(spark, sf_dir):
    """M3/M5: isolation forest (100 trees x 256 rows) on the standardised
    features selected by L2, 3.5 % contamination."""
    return _forest(*_top_fraud_features(spark, sf_dir))


@register("m3_isolation_forest_card")
def m3_isolation_forest_card(spark, sf_dir):
    """M3/M5: the same on five fixed card columns."""
    return _forest(merged(spark, sf_dir), CARD_FEATURES)


@register("l1_feature_importance")
def l1_feature_importance(spark, sf_dir):
    """L1: random-forest importances of every numeric feature for the label
    (label itself excluded), window features included."""
    f = stored(fraud_features(spark, sf_dir), "fraud-features")  # the model reads its input several times
    return feature_importance(f, "isFraud", feature_columns(f, ["isFraud", "TransactionID"]))


@register("l2_top_features")
def l2_top_features(spark, sf_dir):
    """L2: the frame reduced to its 20 most important features (it has fewer, so all of them in
    order of importance) plus the timestamp and the label."""
    f, top = _top_fraud_features(spark, sf_dir)
    return f.select(*top, "sample_datetime", "isFraud")
