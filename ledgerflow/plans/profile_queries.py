"""Registered queries: sampling, partitioning, profile and distribution
tables (H1-H7, P1-P7, J1, J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.columns import pca_projection
from ledgerflow.functions.money import sql_mean
from ledgerflow.operators import profile as P
from ledgerflow.operators.sampling import (SPAN, partition_sizes, range_partition, range_report, sample_sizes,
                                           simple_sample, stratified_sample, top_k)
from ledgerflow.plans.agg_queries import _CARD_TS, _MOBILE_TS, card, mobile
from ledgerflow.plans.quality_queries import NULLS_COLS, PCA_NUM, _PCA
from ledgerflow.plans.registry import register, rounded
from ledgerflow.sources.fixtures import load

# The reference profiles these columns of the mobile data (fixed values).
PROFILE_COLUMNS = ["type", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
                   "isFraud", "isFlaggedFraud", "sample_datetime", "transaction_type"]
PROFILE_NUMERIC = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
                   "isFraud", "isFlaggedFraud"]
PROFILE_CATEGORICAL = ["type", "transaction_type"]
HIST_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "card1"]  # every numeric column but the label


def _union(selects):
    return "\nUNION ALL ".join(selects)


@register("h6_stratified_sizes", views=("tx_card",), sql="""
SELECT isFraud, CAST(round(count(*) * 0.2) AS BIGINT) AS n_sampled FROM tx_card GROUP BY isFraud""")
def h6_stratified_sizes(spark, sf_dir):
    """An exact 20 % stratified sample by label keeps round(0.2 n) per label."""
    s = stratified_sample(load(spark, sf_dir, "tx_card"), 0.2, "isFraud", "TransactionID", seed=42)
    return sample_sizes(s, "isFraud")


_HASHED = "(SELECT *, CAST('0x' || substr(md5(TransactionID || ':42'), 1, 15) AS BIGINT) AS h FROM tx_card)"


@register("h6_stratified_sample", views=("tx_card",), sql=f"""
SELECT * EXCLUDE (h, r, n) FROM (SELECT *, row_number() OVER (PARTITION BY isFraud ORDER BY h, TransactionID) AS r,
       count(*) OVER (PARTITION BY isFraud) AS n FROM {_HASHED}) WHERE r <= round(n * 0.2)""")
def h6_stratified_sample(spark, sf_dir):
    """H6: the stratified sample rows (seeded hash order inside each label)."""
    return stratified_sample(load(spark, sf_dir, "tx_card"), 0.2, "isFraud", "TransactionID", seed=42)


@register("h5_simple_sample", views=("tx_card",), sql=f"SELECT * EXCLUDE (h) FROM {_HASHED} WHERE h < {int(0.2 * SPAN)}")
def h5_simple_sample(spark, sf_dir):
    """H5: reproducible 20 % Bernoulli sample by seeded hash."""
    return simple_sample(load(spark, sf_dir, "tx_card"), 0.2, "TransactionID", seed=42)


@register("h7_range_partition")
def h7_range_partition(spark, sf_dir):
    """H1/H7/H8: range partitions on the timestamp (two, as in the
    reference), sorted inside; rows per partition."""
    return partition_sizes(range_partition(card(spark, sf_dir, parts=False), "sample_datetime", 2))


@register("h7_range_order", views=("tx_card",), sql=f"""
SELECT CAST(2 AS BIGINT) AS partitions, count(*) AS rows, CAST(0 AS BIGINT) AS unsorted, CAST(0 AS BIGINT) AS overlapping FROM tx_card""")
def h7_range_order(spark, sf_dir):
    """H1/H7: the two range partitions by timestamp are in order across and within."""
    return range_report(range_partition(card(spark, sf_dir, parts=False), "sample_datetime", 2), "sample_datetime")


@register("h2_top20_amount", views=("tx_card",), sql="""
SELECT TransactionID, TransactionAmt FROM tx_card ORDER BY TransactionAmt DESC, TransactionID LIMIT 20""")
def h2_top20_amount(spark, sf_dir):
    """H2/H3: top 20 transactions by amount (TakeOrderedAndProject)."""
    return top_k(load(spark, sf_dir, "tx_card").select("TransactionID", "TransactionAmt"), "TransactionAmt", 20,
                 tie="TransactionID")


@register("p1_overview", views=("tx_nulls",), sql="SELECT * FROM (" + _union([
    "SELECT 'rows' AS metric, count(*) AS value FROM tx_nulls",
    f"SELECT 'columns', CAST({len(NULLS_COLS)} AS BIGINT)",
    "SELECT 'missing_cells', CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in NULLS_COLS)
    + " AS BIGINT) FROM tx_nulls",
    "SELECT 'duplicate_rows', CAST((SELECT count(*) FROM tx_nulls) - (SELECT count(*) FROM "
    "(SELECT DISTINCT * FROM tx_nulls)) AS BIGINT)"]) + ")")
def p1_overview(spark, sf_dir):
    """Rows, columns, missing cells, duplicate rows."""
    return P.overview(load(spark, sf_dir, "tx_nulls"))


def _p2_sql():
    parts = []
    for c in PROFILE_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        qs = ", ".join(f"quantile_cont({x}, {q}) AS p{int(round(q * 100)):02d}" for q in P.PROFILE_QUANTILES)
        parts.append(f"""SELECT '{c}' AS \"column\", count({x}) AS n, count(DISTINCT {x}) AS distinct,
            count(*) FILTER (WHERE {x} = 0) AS zeros, count(*) FILTER (WHERE {x} < 0) AS negatives,
            {sql_mean(x)} AS mean, stddev_samp({x}) AS std, kurtosis_pop({x}) AS kurtosis, min({x}) AS min,
            max({x}) AS max, skewness({x}) AS skewness, stddev_samp({x}) / avg({x}) AS cv, {qs} FROM mobile""")
    cols = ["n", '"distinct"', "zeros", "negatives", "mean"] + [f"round({c}, 6) AS {c}" for c in ["std", "kurtosis", "min", "max", "skewness", "cv",
                                          "p05", "p25", "p50", "p75", "p95"]]
    return (f"WITH {_MOBILE_TS}\nSELECT \"column\", {', '.join(cols)}, round(p75 - p25, 6) AS iqr FROM ("
            + _union(parts) + ")")


@register("p2_numeric_profile", views=("tx_mobile",), sql=_p2_sql())
def p2_numeric_profile(spark, sf_dir):
    """Moments, zeros, negatives, distinct values, exact quantiles, IQR."""
    out = P.numeric_profile(mobile(spark, sf_dir).select(*PROFILE_COLUMNS), PROFILE_NUMERIC,
                            money=PROFILE_NUMERIC)
    return rounded(out, ["std", "kurtosis", "min", "max", "skewness", "cv", "p05", "p25", "p50", "p75",
                         "p95", "iqr"])


@register("p3_categorical_profile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS},
vc AS ({_union([f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM mobile GROUP BY 2"
               for c in PROFILE_CATEGORICAL])}),
rk AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC NULLS FIRST) AS rank
       FROM vc WHERE value IS NOT NULL),
top AS (SELECT "column", string_agg(value || ':' || CAST(count AS VARCHAR), ', ' ORDER BY rank) AS top
        FROM rk WHERE rank <= 5 GROUP BY 1),
st AS ({_union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct, CAST(min(length({c})) AS INTEGER) AS min_length, "
               f"avg(length({c})) AS mean_length, CAST(max(length({c})) AS INTEGER) AS max_length FROM mobile"
               for c in PROFILE_CATEGORICAL])})
SELECT st."column", "distinct", min_length, round(mean_length, 6) AS mean_length, max_length, top
FROM st LEFT JOIN top USING ("column")""")
def p3_categorical_profile(spark, sf_dir):
    """Distinct values, string lengths, top-5 values per categorical column."""
    return rounded(P.categorical_profile(mobile(spark, sf_dir), PROFILE_CATEGORICAL), ["mean_length"])


@register("p4_timestamp_profile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS}
SELECT 'sample_datetime' AS "column", min(sample_datetime) AS min, max(sample_datetime) AS max,
       date_diff('second', min(sample_datetime), max(sample_datetime)) AS range_seconds FROM mobile""")
def p4_timestamp_profile(spark, sf_dir):
    """First and last timestamp and the span in seconds."""
    return P.timestamp_profile(mobile(spark, sf_dir), ["sample_datetime"])


_CORR = [(a, b) for i, a in enumerate(PCA_NUM) for b in PCA_NUM[i + 1:]]


@register("p5_correlations", views=("tx_pca",), sql=f"""WITH {_PCA}
SELECT column_a, column_b, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS pearson FROM (
SELECT unnest([{", ".join(f"'{a}'" for a, _ in _CORR)}]) AS column_a, unnest([{", ".join(f"'{b}'" for _, b in _CORR)}]) AS column_b,
       unnest([{", ".join(f"corr({a}, {b})" for a, b in _CORR)}]) AS r FROM pca)""")
def p5_correlations(spark, sf_dir):
    """P5: Pearson correlation of every pair of the 31 columns in one aggregate."""
    return rounded(P.correlations(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_NUM))


def _spearman_sql():
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in PCA_NUM)
    return f"""WITH {_PCA}, ranked AS (SELECT {ranks} FROM pca)
SELECT column_a, column_b, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS spearman FROM (
SELECT unnest([{", ".join(f"'{a}'" for a, _ in _CORR)}]) AS column_a, unnest([{", ".join(f"'{b}'" for _, b in _CORR)}]) AS column_b,
       unnest([{", ".join(f"corr({a}, {b})" for a, b in _CORR)}]) AS r FROM ranked)"""


@register("p5_rank_correlations", views=("tx_pca",), sql=_spearman_sql())
def p5_rank_correlations(spark, sf_dir):
    """P5: Spearman correlation of every pair of the 31 columns."""
    return rounded(P.rank_correlations(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_NUM))


# Every categorical column of the mobile data that is not an identifier, and the flags.
ASSOCIATED = PROFILE_CATEGORICAL + ["isFraud", "isFlaggedFraud"]


def _cramers_sql():
    parts = []
    for i, a in enumerate(ASSOCIATED):
        for b in ASSOCIATED[i + 1:]:
            parts.append(f"""SELECT '{a}' AS column_a, '{b}' AS column_b, (SELECT CASE WHEN least(count(DISTINCT x), count(DISTINCT y)) > 1
    THEN round(sqrt(greatest(sum(n * n / (nx * ny)) - 1, 0) / (least(count(DISTINCT x), count(DISTINCT y)) - 1)), 6) END FROM (
    SELECT x, y, n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM (
      SELECT {a} AS x, {b} AS y, CAST(count(*) AS DOUBLE) AS n FROM mobile WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2))) AS cramers_v""")
    return f"WITH {_MOBILE_TS}\n" + _union(parts)


@register("p5_associations", views=("tx_mobile",), sql=_cramers_sql())
def p5_associations(spark, sf_dir):
    """P5: Cramer's V of every pair of categorical columns and flags."""
    return rounded(P.associations(mobile(spark, sf_dir), ASSOCIATED))


def _profile(spark, sf_dir, mode):
    """The sections of the profile as ``(section, entry)``, an entry being a row as JSON."""
    sections = P.profile(load(spark, sf_dir, "tx_nulls"), mode, stratum="ProductCD", key="TransactionID")
    out = None
    for name, t in sections.items():
        part = t.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("entry"))
        out = part if out is None else out.unionByName(part)
    return out


@register("p7_profile_full")
def p7_profile_full(spark, sf_dir):
    """Every profile section of the card table with missing values."""
    return _profile(spark, sf_dir, "full")


@register("p7_profile_sample")
def p7_profile_sample(spark, sf_dir):
    """The profile of a seeded simple sample."""
    return _profile(spark, sf_dir, "sample")


@register("p7_profile_stratified")
def p7_profile_stratified(spark, sf_dir):
    """The profile of an exact stratified sample."""
    return _profile(spark, sf_dir, "stratified")


@register("p6_missing_patterns", views=("tx_nulls",), sql="""
SELECT concat_ws(',', """ + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in NULLS_COLS) + """) AS pattern,
       count(*) AS rows FROM tx_nulls GROUP BY 1""")
def p6_missing_patterns(spark, sf_dir):
    """Which columns are missing together, and how often."""
    return P.missing_patterns(load(spark, sf_dir, "tx_nulls"))


def _hist_sql():
    long = _union([f"SELECT isFraud AS label, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM tx_card "
                   f"WHERE {c} IS NOT NULL" for c in HIST_COLS])
    return f"""WITH l AS ({long}),
r AS (SELECT "column", label, min(v) AS lo, max(v) AS hi FROM l GROUP BY 1, 2),
c AS (SELECT "column", label, CASE WHEN hi = lo THEN 1 ELSE
        least(CAST(floor((v - lo) / ((hi - lo) / 20)) AS INTEGER) + 1, 20) END AS bin, count(*) AS n
      FROM l JOIN r USING ("column", label) GROUP BY 1, 2, 3),
s AS (SELECT "column", label, lo, hi, unnest(range(1, 21)) AS bin FROM r)
SELECT s."column", s.label, CAST(s.bin AS INTEGER) AS bin, round(lo + (s.bin - 1) * ((hi - lo) / 20), 6) AS lower,
       round(lo + s.bin * ((hi - lo) / 20), 6) AS upper, coalesce(n, 0) AS count
FROM s LEFT JOIN c ON s."column" = c."column" AND s.label = c.label AND s.bin = c.bin"""


@register("j1_histogram", views=("tx_card",), sql=_hist_sql())
def j1_histogram(spark, sf_dir):
    """20-bin histograms per feature and label, each over its own range."""
    return rounded(P.histogram(load(spark, sf_dir, "tx_card"), HIST_COLS, "isFraud", 20), ["lower", "upper"])


def _kde_sql():
    long = _union([f"SELECT isFraud AS label, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM tx_card "
                   f"WHERE {c} IS NOT NULL" for c in HIST_COLS])
    return f"""WITH l AS ({long}),
r AS (SELECT "column", label, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM l GROUP BY 1, 2),
g AS (SELECT *, unnest(range(0, 200)) AS point FROM r WHERE h > 0),
d AS (SELECT "column", label, v, count(*) AS w FROM l GROUP BY ALL)
SELECT "column", label, CAST(point AS INTEGER) AS point, round(any_value(lo + point * ((hi - lo) / 199)), 6) AS x,
       round(sum(w * exp(-0.5 * pow((lo + point * ((hi - lo) / 199) - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM g JOIN d USING ("column", label) GROUP BY "column", label, point"""


@register("j2_kde", views=("tx_card",), sql=_kde_sql())
def j2_kde(spark, sf_dir):
    """Exact Gaussian KDE curves (Scott bandwidth, 200 points over the data's
    range) of every numeric column per label."""
    return rounded(P.kde(load(spark, sf_dir, "tx_card"), HIST_COLS, "isFraud"), ["x", "density"])
