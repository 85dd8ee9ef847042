"""Registered queries: data quality, projections, time columns, joins,
validation rules (B, C, D, E10-E25, X1, X2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.columns import (PCA_COLUMNS, narrow_plan, narrow_schema, pca_projection,
                                          transaction_type)
from ledgerflow.functions.timecols import add_sample_datetime, add_time_parts, future_days
from ledgerflow.operators import quality as Q
from ledgerflow.operators.joins import convert_currency, merge
from ledgerflow.operators.quantiles import quantiles
from ledgerflow.plans.agg_queries import _CARD_TS, _MOBILE_TS, card, mobile
from ledgerflow.plans.registry import register, rounded
from ledgerflow.sources.fixtures import MOBILE_EPOCH, load

NULLS_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1", "ProductCD"]
MOBILE_CAT = ["type", "nameOrig", "nameDest", "transaction_type"]
MOBILE_ALL = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
              "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud", "sample_datetime",
              "transaction_type"]
PCA_NUM = PCA_COLUMNS
_PCA_SEL = ", ".join(['CAST("Time" AS INTEGER) AS time'] + [f"V{i} AS v{i}" for i in range(1, 29)]
                     + ["Amount AS amount", "Class AS class"])
_PCA = f"pca AS (SELECT {_PCA_SEL} FROM tx_pca)"

# Validation rules over the mobile transactions.
RULES_SQL = {
    "amount_positive": "amount > 0",
    "amount_at_most_100k": "amount <= 100000",
    "origin_balance_covers": "newbalanceOrig >= 0",
    "known_type": "type IN ('A', 'N', 'R')",
}


def _union(selects):
    return "\nUNION ALL ".join(selects)


@register("e10_null_counts", views=("tx_nulls",), sql="SELECT * FROM (" + _union(
    [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM tx_nulls"
     for c in NULLS_COLS]) + ")")
def e10_null_counts(spark, sf_dir):
    """Missing values per column, one scan."""
    return Q.null_counts(load(spark, sf_dir, "tx_nulls"))


@register("e11_duplicate_count", views=("tx_dups",), sql="""
SELECT CAST((SELECT count(*) FROM tx_dups) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx_dups)) AS BIGINT)
       AS duplicates""")
def e11_duplicate_count(spark, sf_dir):
    """Rows minus distinct rows."""
    return Q.duplicate_count(load(spark, sf_dir, "tx_dups"))


@register("e12_drop_duplicates", views=("tx_dups",), sql="SELECT DISTINCT * FROM tx_dups")
def e12_drop_duplicates(spark, sf_dir):
    """One copy of each row."""
    return Q.drop_duplicates(load(spark, sf_dir, "tx_dups"))


@register("b14_drop_missing", views=("tx_nulls",), sql="SELECT * FROM tx_nulls WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in NULLS_COLS))
def b14_drop_missing(spark, sf_dir):
    """Drop rows holding any null."""
    return Q.drop_missing(load(spark, sf_dir, "tx_nulls"))


@register("b13_fill_missing", views=("tx_nulls",), sql="""
SELECT TransactionID, TransactionDT, coalesce(TransactionAmt, 0) AS TransactionAmt,
       coalesce(isFraud, 0) AS isFraud, card1, ProductCD FROM tx_nulls""")
def b13_fill_missing(spark, sf_dir):
    """Numeric nulls replaced by 0."""
    return Q.fill_missing(load(spark, sf_dir, "tx_nulls"), 0)


_DESCRIBE_COLS = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1"]  # every numeric column


@register("e13_describe", views=("tx_card",), sql="SELECT \"column\", statistic, round(value, 6) AS value FROM (" + _union(
    [f"""SELECT '{c}' AS \"column\", unnest(['count', 'mean', 'std', 'min', 'max', '25%', '50%', '75%']) AS statistic,
         unnest([CAST(count({c}) AS DOUBLE), avg({c}), stddev_samp({c}), CAST(min({c}) AS DOUBLE),
                 CAST(max({c}) AS DOUBLE), quantile_cont(CAST({c} AS DOUBLE), 0.25),
                 quantile_cont(CAST({c} AS DOUBLE), 0.5), quantile_cont(CAST({c} AS DOUBLE), 0.75)]) AS value
         FROM tx_card""" for c in _DESCRIBE_COLS]) + ")")
def e13_describe(spark, sf_dir):
    """Count, mean, std, min, quartiles, max per column (exact quartiles)."""
    return rounded(Q.describe(load(spark, sf_dir, "tx_card"), _DESCRIBE_COLS))


@register("e14_fraud_shares", views=("tx_nulls",), sql="""
SELECT isFraud AS value, count(*) AS count,
       count(*) / CAST((SELECT count(isFraud) FROM tx_nulls) AS DOUBLE) AS share
FROM tx_nulls WHERE isFraud IS NOT NULL GROUP BY isFraud""")
def e14_fraud_shares(spark, sf_dir):
    """Normalised value counts of the label (nulls excluded)."""
    return Q.value_shares(load(spark, sf_dir, "tx_nulls"), "isFraud")


_MOBILE_VC = f"""WITH {_MOBILE_TS},
vc AS ({_union([f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM mobile GROUP BY 2"
                for c in MOBILE_CAT])})"""


@register("e15_top_values", views=("tx_mobile",), sql=_MOBILE_VC + """
SELECT \"column\", CAST(rank AS INTEGER) AS rank, value, count FROM (
  SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value ASC NULLS FIRST) AS rank
  FROM vc WHERE value IS NOT NULL) WHERE rank <= 5""")
def e15_top_values(spark, sf_dir):
    """Five most frequent values of each categorical column."""
    return Q.top_values(mobile(spark, sf_dir), MOBILE_CAT, k=5)


@register("e17_modes", views=("tx_mobile",), sql=_MOBILE_VC + """
SELECT \"column\", value AS mode, count FROM (
  SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value ASC NULLS FIRST) AS rank
  FROM vc) WHERE rank = 1""")
def e17_modes(spark, sf_dir):
    """Most frequent value per categorical column, one shuffle."""
    return Q.modes(mobile(spark, sf_dir), MOBILE_CAT)


@register("e16_distinct_counts", views=("tx_mobile",), sql=f"WITH {_MOBILE_TS}\n" + _union(
    [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct FROM mobile" for c in MOBILE_ALL]))
def e16_distinct_counts(spark, sf_dir):
    """Exact distinct values of every column in one aggregate."""
    return Q.distinct_counts(mobile(spark, sf_dir), MOBILE_ALL)


@register("e18_quartiles", views=("tx_pca",), sql=f"WITH {_PCA}\nSELECT \"column\", prob, round(value, 6) AS value FROM ("
          + _union([f"SELECT '{c}' AS \"column\", unnest([0.25, 0.75]) AS prob, "
                    f"unnest([quantile_cont(CAST({c} AS DOUBLE), 0.25), quantile_cont(CAST({c} AS DOUBLE), 0.75)]) AS value "
                    f"FROM pca" for c in PCA_NUM]) + ")")
def e18_quartiles(spark, sf_dir):
    """Exact first and third quartiles of all 31 columns in one job."""
    return rounded(quantiles(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_NUM, [0.25, 0.75]))


@register("e19_quantile95", views=("tx_mobile",), sql="""
SELECT 'amount' AS \"column\", 0.95 AS prob, round(quantile_cont(amount, 0.95), 6) AS value FROM tx_mobile
UNION ALL SELECT 'oldbalanceOrg', 0.95, round(quantile_cont(oldbalanceOrg, 0.95), 6) FROM tx_mobile""")
def e19_quantile95(spark, sf_dir):
    """Exact interpolated 95th percentile over the whole table."""
    return rounded(quantiles(load(spark, sf_dir, "tx_mobile"), ["amount", "oldbalanceOrg"], [0.95]))


def _iqr_sql(cols, src):
    return _union([f"""SELECT '{c}' AS \"column\", q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper,
        (SELECT count(*) FROM {src} WHERE CAST({c} AS DOUBLE) < q1 - 1.5 * (q3 - q1)
                                       OR CAST({c} AS DOUBLE) > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
            FROM {src})""" for c in cols])


@register("e20_iqr_outliers", views=("tx_pca",), sql=f"WITH {_PCA}\nSELECT \"column\", round(q1, 6) AS q1, "
          "round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper, outliers FROM ("
          + _iqr_sql(PCA_NUM, "pca") + ")")
def e20_iqr_outliers(spark, sf_dir):
    """IQR fence outliers for every numeric column (exact quartiles)."""
    return rounded(Q.iqr_outliers(pca_projection(load(spark, sf_dir, "tx_pca")), PCA_NUM))


def _types_sql(view_cols):
    """Rows ``(column, dtype)`` as text: the types are those of the Spark view."""
    return ", ".join(f"('{c}', '{t}')" for c, t in view_cols)


NULLS_TYPES = (("TransactionID", "bigint"), ("TransactionDT", "bigint"), ("TransactionAmt", "double"),
               ("isFraud", "int"), ("card1", "bigint"), ("ProductCD", "string"))


@register("e24_quality_summary", views=("tx_nulls",), sql="SELECT * FROM (" + _union(
    [f"SELECT 'missing_values' AS section, '{c}' AS \"column\", "
     f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS VARCHAR) AS value FROM tx_nulls" for c in NULLS_COLS]
    + ["""SELECT 'duplicate_rows', NULL, CAST((SELECT count(*) FROM tx_nulls)
          - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx_nulls)) AS VARCHAR)""",
       f"SELECT 'data_types', * FROM (VALUES {_types_sql(NULLS_TYPES)}) AS t(c, v)"]) + ")")
def e24_quality_summary(spark, sf_dir):
    """Missing values, duplicate rows and types of the quality summary."""
    return Q.quality_summary(load(spark, sf_dir, "tx_nulls"))


def _report_sql():
    parts = [f"SELECT 'missing_values' AS section, '{c}' AS \"column\", 'count' AS metric, "
             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value, NULL AS text FROM pca" for c in PCA_NUM]
    parts.append("SELECT 'duplicates', '*', 'count', CAST((SELECT count(*) FROM pca) - "
                 "(SELECT count(*) FROM (SELECT DISTINCT * FROM pca)) AS DOUBLE), NULL")
    parts += [f"SELECT 'unique_values', '{c}', 'count', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM pca"
              for c in PCA_NUM]
    for c in PCA_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT 'numeric_summary', '{c}', unnest(['count', 'mean', 'stddev', 'min', 'max']), "
                     f"unnest([CAST(count({x}) AS DOUBLE), avg({x}), stddev_samp({x}), min({x}), max({x})]), NULL "
                     f"FROM pca")
    parts.append("SELECT 'outliers', \"column\", 'count', CAST(outliers AS DOUBLE), NULL FROM ("
                 + _iqr_sql(PCA_NUM, "pca") + ")")
    return (f"WITH {_PCA}\nSELECT section, \"column\", metric, round(value, 6) AS value, CAST(text AS VARCHAR) AS text "
            f"FROM (" + _union(parts) + ")")


@register("e25_quality_report", views=("tx_pca",), sql=_report_sql())
def e25_quality_report(spark, sf_dir):
    """The full quality report of the PCA card table (types listed
    separately in ``e23_data_types``)."""
    return rounded(Q.quality_report(pca_projection(load(spark, sf_dir, "tx_pca")), include_types=False))


def _mobile_report_sql(num, cat, types):
    cols = num + cat
    parts = [f"SELECT 'missing_values' AS section, '{c}' AS \"column\", 'count' AS metric, "
             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM t" for c in cols]
    parts.append("SELECT 'duplicates', '*', 'count', CAST((SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS DOUBLE), NULL")
    parts += [f"SELECT 'unique_values', '{c}', 'count', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM t" for c in cols]
    parts += [f"SELECT 'numeric_summary', '{c}', unnest(['count', 'mean', 'stddev', 'min', 'max']), unnest([CAST(count(x) AS DOUBLE), "
              f"round(avg(x), 3), round(stddev_samp(x), 3), min(x), max(x)]), NULL FROM (SELECT CAST({c} AS DOUBLE) AS x FROM t)" for c in num]
    parts.append("SELECT 'outliers', \"column\", 'count', CAST(outliers AS DOUBLE), NULL FROM (" + _iqr_sql(num, "t") + ")")
    parts += [f"SELECT 'most_frequent', '{c}', 'mode', CAST(n AS DOUBLE), v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM t "
              f"GROUP BY 1 ORDER BY n DESC, v ASC NULLS FIRST LIMIT 1)" for c in cat]
    parts.append("SELECT 'data_types', c, 'dtype', NULL, v FROM (VALUES " + _types_sql(types) + ") AS x(c, v)")
    return f"WITH t AS (SELECT {', '.join(cols)} FROM tx_mobile)\n" + _union(parts)


MOBILE_REPORT_NUM = ["step", "amount", "oldbalanceOrg", "newbalanceOrig", "isFraud"]
MOBILE_REPORT_CAT = ["type", "nameOrig"]
MOBILE_REPORT_TYPES = (("step", "int"), ("amount", "double"), ("oldbalanceOrg", "double"), ("newbalanceOrig", "double"),
                       ("isFraud", "int"), ("type", "string"), ("nameOrig", "string"))


@register("e25_quality_report_mobile", views=("tx_mobile",),
          sql=_mobile_report_sql(MOBILE_REPORT_NUM, MOBILE_REPORT_CAT, MOBILE_REPORT_TYPES))
def e25_quality_report_mobile(spark, sf_dir):
    """The quality report of seven of the eleven columns of the mobile
    transactions (the whole table: ``e25_quality_report_mobile_full``)."""
    return _mobile_report(load(spark, sf_dir, "tx_mobile").select(*MOBILE_REPORT_NUM, *MOBILE_REPORT_CAT))


MOBILE_ALL_NUM = MOBILE_REPORT_NUM + ["oldbalanceDest", "newbalanceDest", "isFlaggedFraud"]
MOBILE_ALL_CAT = MOBILE_REPORT_CAT + ["nameDest"]
MOBILE_ALL_TYPES = MOBILE_REPORT_TYPES + (("oldbalanceDest", "double"), ("newbalanceDest", "double"), ("isFlaggedFraud", "int"),
                                          ("nameDest", "string"))


@register("e25_quality_report_mobile_full", views=("tx_mobile",),
          sql=_mobile_report_sql(MOBILE_ALL_NUM, MOBILE_ALL_CAT, MOBILE_ALL_TYPES))
def e25_quality_report_mobile_full(spark, sf_dir):
    """The quality report of every column of the mobile transactions with
    types, modes and outliers; duplicates are taken over whole rows."""
    return _mobile_report(load(spark, sf_dir, "tx_mobile"))


def _mobile_report(df):
    rep = Q.quality_report(df)
    summary = (F.col("section") == "numeric_summary") & F.col("metric").isin("mean", "stddev")
    return rep.withColumn("value", F.when(summary, F.round("value", 3)).otherwise(F.col("value")))


@register("e23_data_types", views=("tx_card", "tx_identity"), sql="""
WITH m AS (SELECT * FROM tx_card LEFT JOIN tx_identity USING (TransactionID))
SELECT c AS "column", t AS dtype, n AS present FROM (SELECT
  unnest(['TransactionID', 'TransactionDT', 'TransactionAmt', 'isFraud', 'card1', 'ProductCD', 'id_01', 'id_02']) AS c,
  unnest(['bigint', 'bigint', 'double', 'int', 'bigint', 'string', 'bigint', 'int']) AS t,
  unnest([count(TransactionID), count(TransactionDT), count(TransactionAmt), count(isFraud), count(card1), count(ProductCD), count(id_01), count(id_02)]) AS n
  FROM m)""")
def e23_data_types(spark, sf_dir):
    """Type and number of present values of every column of the merged card table."""
    m = merge(load(spark, sf_dir, "tx_card"), load(spark, sf_dir, "tx_identity"), "TransactionID")
    present = Q.null_counts(m).crossJoin(m.agg(F.count(F.lit(1)).alias("n"))).select("column", (F.col("n") - F.col("missing")).alias("present"))
    return Q.data_types(m).join(present, "column")


_RULE_FAIL = ", ".join(f"count(*) FILTER (WHERE NOT coalesce({e}, false)) AS {n}" for n, e in RULES_SQL.items())


@register("x2_rule_failures", views=("tx_mobile",), sql="SELECT * FROM (" + _union(
    [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({e}, false)) AS failed FROM tx_mobile"
     for n, e in RULES_SQL.items()]) + ")")
def x2_rule_failures(spark, sf_dir):
    """Failing rows per validation rule, one scan for all rules."""
    rules = {n: F.expr(e) for n, e in RULES_SQL.items()}
    return Q.rule_failures(load(spark, sf_dir, "tx_mobile"), rules)


@register("x2_quarantine", views=("tx_mobile",), sql="""
SELECT * FROM (SELECT step, nameOrig, nameDest, amount, newbalanceOrig, concat_ws(',', """
          + ", ".join(f"CASE WHEN NOT coalesce({e}, false) THEN '{n}' END" for n, e in RULES_SQL.items())
          + """) AS failed_rules FROM tx_mobile) WHERE failed_rules <> ''""")
def x2_quarantine(spark, sf_dir):
    """Rows failing at least one rule, with the rules they fail."""
    rules = {n: F.expr(e) for n, e in RULES_SQL.items()}
    _, bad = Q.quarantine(load(spark, sf_dir, "tx_mobile"), rules)
    return bad.select("step", "nameOrig", "nameDest", "amount", "newbalanceOrig",
                      F.array_join("failed_rules", ",").alias("failed_rules"))


@register("b1_pca_projection", views=("tx_pca",), sql=f"WITH {_PCA}\nSELECT * FROM pca")
def b1_pca_projection(spark, sf_dir):
    """Fixed 31-column projection, lower-case names, time as int."""
    return pca_projection(load(spark, sf_dir, "tx_pca"))


@register("b9_transaction_type", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS}
SELECT step, nameOrig, nameDest, sample_datetime, transaction_type FROM mobile""")
def b9_transaction_type(spark, sf_dir):
    """Elapsed hours to timestamp and the CC/CM/MC/MM class."""
    m = add_sample_datetime(load(spark, sf_dir, "tx_mobile"), "step", "HOUR", MOBILE_EPOCH)
    return m.select("step", "nameOrig", "nameDest", "sample_datetime",
                    transaction_type().alias("transaction_type"))


_NARROW_INT = ["TransactionID", "TransactionDT", "isFraud", "card1"]


def _narrow_sql():
    parts = []
    for c in _NARROW_INT:
        parts.append(f"""SELECT '{c}' AS \"column\", CASE
            WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint'
            WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
            WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' END AS dtype FROM tx_card""")
    parts.append("""SELECT 'TransactionAmt', CASE WHEN max(abs(TransactionAmt - CAST(CAST(TransactionAmt AS FLOAT)
            AS DOUBLE))) <= 0.0005 THEN 'float' END FROM tx_card""")
    return "SELECT * FROM (" + _union(parts) + ") WHERE dtype IS NOT NULL"


@register("b16_narrow_frame", views=("tx_card", "tx_identity"), sql="""
SELECT TransactionID, TransactionDT, CAST(TransactionAmt AS FLOAT) AS TransactionAmt, isFraud, card1, ProductCD, id_01, id_02
FROM tx_card LEFT JOIN tx_identity USING (TransactionID)""")
def b16_narrow_frame(spark, sf_dir):
    """The merged frame after narrowing its numeric types."""
    m = merge(load(spark, sf_dir, "tx_card"), load(spark, sf_dir, "tx_identity"), "TransactionID")
    return narrow_schema(m)


@register("b16_narrow_plan", views=("tx_card",), sql=_narrow_sql())
def b16_narrow_plan(spark, sf_dir):
    """Smallest type per numeric column, chosen in one aggregate pass."""
    plan = narrow_plan(load(spark, sf_dir, "tx_card"))
    return spark.createDataFrame(sorted(plan.items()), "column string, dtype string")


@register("c3_time_parts", views=("tx_card",), sql=f"""
WITH {_CARD_TS}
SELECT TransactionID, sample_datetime, month, day, hour, week, day_of_week FROM cardp""")
def c3_time_parts(spark, sf_dir):
    """Seconds to timestamp, then month, date, hour, ISO week, weekday."""
    return card(spark, sf_dir).select("TransactionID", "sample_datetime", "month", "day", "hour", "week",
                                      "day_of_week")


@register("c10_future_days", views=("tx_orders",), sql="""
SELECT CAST(unnest(generate_series(max(sample_datetime) + INTERVAL 1 DAY,
                                   max(sample_datetime) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS day
FROM tx_orders""")
def c10_future_days(spark, sf_dir):
    """The 30 days after the last observed day."""
    o = load(spark, sf_dir, "tx_orders")
    return o.agg(F.max("sample_datetime").alias("last")).select(F.explode(future_days(F.col("last"), 30)).alias("day"))


@register("d1_merge_identity", views=("tx_card", "tx_identity"), sql="""
SELECT * FROM tx_card LEFT JOIN tx_identity USING (TransactionID)""")
def d1_merge_identity(spark, sf_dir):
    """Transactions left-joined to identity rows on TransactionID."""
    return merge(load(spark, sf_dir, "tx_card"), load(spark, sf_dir, "tx_identity"), "TransactionID", "left")


@register("x1_currency_conversion", views=("tx_card", "fx_rates"), sql="""
SELECT TransactionID, ProductCD, currency, TransactionAmt * rate AS amount_converted
FROM tx_card LEFT JOIN fx_rates ON ProductCD = event_type""")
def x1_currency_conversion(spark, sf_dir):
    """Amount times the rate of its currency; the checked-size rate
    table is broadcast."""
    c = load(spark, sf_dir, "tx_card").withColumnRenamed("ProductCD", "event_type")
    out = convert_currency(c, load(spark, sf_dir, "fx_rates"), "event_type", "TransactionAmt")
    return out.select("TransactionID", F.col("event_type").alias("ProductCD"), "currency", "amount_converted")
