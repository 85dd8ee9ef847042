"""Registered queries: grouped and time-bucketed aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.columns import pca_projection, transaction_type
from ledgerflow.functions.money import cents_avg, cents_mean, cents_sum, sql_mean, sql_sum
from ledgerflow.functions.timecols import add_sample_datetime, add_time_parts
from ledgerflow.operators.aggregate import (aggregate, daily_rate, fraud_pivot,
                                            period_statistics, resample)
from ledgerflow.plans.registry import register, rounded
from ledgerflow.sources.fixtures import CARD_EPOCH, MOBILE_EPOCH, load

# The reference's aggregation parameters (fixed values).
HOURLY_FUNCS = {"amount": [cents_mean, cents_sum], "type": "nunique"}
DAILY_FUNCS = {"transaction_type": "nunique"}
WEEKLY_FUNCS = {"isFraud": "sum", "isFlaggedFraud": "sum"}
SECOND_FUNCS = {"amount": [F.min, F.max, cents_avg], "class": [F.sum, F.count]}
DATE_HOUR_FUNCS = {
    "v10": [F.stddev, F.min, F.max, F.avg],
    "v11": [F.stddev, F.min, F.max, F.avg],
    "amount": [F.min, F.max, cents_avg],
    "class": [F.sum, F.count],
}
PERIOD_STATISTICS = {
    "TransactionAmt": {"statistic": "sum", "period": ["day", "hour", "week"], "rolling_statistics": 7},
    "TransactionID": {"statistic": "size", "period": ["day", "week", "day_of_week"], "rolling_statistics": 0},
}


def mobile(spark, sf_dir):
    """Mobile transactions with ``sample_datetime`` and ``transaction_type``."""
    m = load(spark, sf_dir, "tx_mobile")
    m = add_sample_datetime(m, "step", "HOUR", MOBILE_EPOCH)
    return m.withColumn("transaction_type", transaction_type())


def card(spark, sf_dir, parts=True):
    c = add_sample_datetime(load(spark, sf_dir, "tx_card"), "TransactionDT", "SECOND", CARD_EPOCH)
    return add_time_parts(c) if parts else c


def pca(spark, sf_dir):
    p = pca_projection(load(spark, sf_dir, "tx_pca"))
    return add_sample_datetime(p, "time", "SECOND", CARD_EPOCH)


_MOBILE_TS = """mobile AS (SELECT *, TIMESTAMP '1995-01-01' + step * INTERVAL 1 HOUR AS sample_datetime,
        CASE WHEN contains(nameOrig, 'C') AND contains(nameDest, 'C') THEN 'CC'
             WHEN contains(nameOrig, 'C') AND contains(nameDest, 'M') THEN 'CM'
             WHEN contains(nameOrig, 'M') AND contains(nameDest, 'C') THEN 'MC'
             WHEN contains(nameOrig, 'M') AND contains(nameDest, 'M') THEN 'MM' END AS transaction_type
        FROM tx_mobile)"""
_CARD_TS = """card AS (SELECT *, TIMESTAMP '2024-01-01' + TransactionDT * INTERVAL 1 SECOND AS sample_datetime
        FROM tx_card),
    cardp AS (SELECT *, CAST(month(sample_datetime) AS INTEGER) AS month,
        CAST(sample_datetime AS DATE) AS day, CAST(hour(sample_datetime) AS INTEGER) AS hour,
        CAST(weekofyear(sample_datetime) AS INTEGER) AS week,
        CAST(isodow(sample_datetime) - 1 AS INTEGER) AS day_of_week FROM card)"""
_PCA_TS = """pca AS (SELECT CAST("Time" AS INTEGER) AS time, V10 AS v10, V11 AS v11, Amount AS amount,
        Class AS class, TIMESTAMP '2024-01-01' + CAST("Time" AS INTEGER) * INTERVAL 1 SECOND AS sample_datetime
        FROM tx_pca)"""


@register("e4a_hourly_mobile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS},
g AS (SELECT date_trunc('hour', sample_datetime) AS b, {sql_mean('amount')} AS m, {sql_sum('amount')} AS s,
             count(DISTINCT type) AS u FROM mobile GROUP BY 1),
sp AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 HOUR)) AS b FROM g)
SELECT sp.b AS sample_datetime, m AS amount_mean, coalesce(s, 0) AS amount_sum,
       coalesce(u, 0) AS type_nunique
FROM sp LEFT JOIN g USING (b)""")
def e4a_hourly_mobile(spark, sf_dir):
    """Hourly mean and sum of amount, distinct types, empty hours kept."""
    return resample(mobile(spark, sf_dir), "sample_datetime", "H", HOURLY_FUNCS)


@register("e4a_hourly_card_purchases", views=("tx_card",), sql=f"""
WITH {_CARD_TS},
g AS (SELECT date_trunc('hour', sample_datetime) AS b, {sql_mean('TransactionAmt')} AS m,
             {sql_sum('TransactionAmt')} AS s,
             count(DISTINCT card1) AS u FROM card WHERE ProductCD = 'purchase' GROUP BY 1),
sp AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 HOUR)) AS b FROM g)
SELECT sp.b AS sample_datetime, m AS TransactionAmt_mean,
       coalesce(s, 0) AS TransactionAmt_sum, coalesce(u, 0) AS card1_nunique
FROM sp LEFT JOIN g USING (b)""")
def e4a_hourly_card_purchases(spark, sf_dir):
    """E4a on one product type of the card data, so some hours are empty."""
    c = card(spark, sf_dir, parts=False).filter(F.col("ProductCD") == "purchase")
    return resample(c, "sample_datetime", "H",
                    {"TransactionAmt": [cents_mean, cents_sum], "card1": "nunique"})


@register("e4b_daily_mobile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS},
g AS (SELECT date_trunc('day', sample_datetime) AS b, count(DISTINCT transaction_type) AS u
      FROM mobile GROUP BY 1),
sp AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 DAY)) AS b FROM g)
SELECT sp.b AS sample_datetime, coalesce(u, 0) AS transaction_type_nunique
FROM sp LEFT JOIN g USING (b)""")
def e4b_daily_mobile(spark, sf_dir):
    """Daily distinct transaction types."""
    return resample(mobile(spark, sf_dir), "sample_datetime", "D", DAILY_FUNCS)


@register("e4c_weekly_mobile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS},
g AS (SELECT date_trunc('week', sample_datetime) + INTERVAL 6 DAY AS b,
             sum(isFraud) AS f, sum(isFlaggedFraud) AS ff FROM mobile GROUP BY 1),
sp AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 7 DAY)) AS b FROM g)
SELECT sp.b AS sample_datetime, CAST(coalesce(f, 0) AS BIGINT) AS isFraud_sum,
       CAST(coalesce(ff, 0) AS BIGINT) AS isFlaggedFraud_sum
FROM sp LEFT JOIN g USING (b)""")
def e4c_weekly_mobile(spark, sf_dir):
    """Weekly fraud sums, weeks labelled by their Sunday."""
    return resample(mobile(spark, sf_dir), "sample_datetime", "W", WEEKLY_FUNCS)


@register("e4_weekly_orders", views=("tx_orders",), sql=f"""
WITH g AS (SELECT date_trunc('week', sample_datetime) + INTERVAL 6 DAY AS b, count(*) AS n,
                  {sql_mean('TransactionAmt')} AS m FROM tx_orders GROUP BY 1),
sp AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 7 DAY)) AS b FROM g)
SELECT sp.b AS sample_datetime, coalesce(n, 0) AS TransactionID_count, m AS TransactionAmt_mean
FROM sp LEFT JOIN g USING (b)""")
def e4_weekly_orders(spark, sf_dir):
    """Weekly count and mean over the order calendar."""
    o = load(spark, sf_dir, "tx_orders")
    return resample(o, "sample_datetime", "W", {"TransactionID": "count", "TransactionAmt": cents_mean})


@register("e1_agg_by_second", views=("tx_pca",), sql=f"""
WITH {_PCA_TS}
SELECT sample_datetime, min(amount) AS amount_min, max(amount) AS amount_max,
       {sql_mean('amount')} AS amount_avg, CAST(sum(class) AS BIGINT) AS class_sum,
       count(class) AS class_count
FROM pca GROUP BY sample_datetime""")
def e1_agg_by_second(spark, sf_dir):
    """Dict-driven aggregate keyed by the exact second."""
    return aggregate(pca(spark, sf_dir), ["sample_datetime"], SECOND_FUNCS)


@register("e2_agg_by_instant_mobile", views=("tx_mobile",), sql=f"""
WITH {_MOBILE_TS}
SELECT sample_datetime, min(amount) AS amount_min, max(amount) AS amount_max, {sql_mean('amount')} AS amount_avg,
       CAST(sum(isFraud) AS BIGINT) AS isFraud_sum, count(isFraud) AS isFraud_count
FROM mobile GROUP BY sample_datetime""")
def e2_agg_by_instant_mobile(spark, sf_dir):
    """The aggregate keyed by the exact instant, with many rows to most of them."""
    funcs = {"amount": [F.min, F.max, cents_avg], "isFraud": [F.sum, F.count]}
    return aggregate(mobile(spark, sf_dir), ["sample_datetime"], funcs)


@register("e3_agg_date_hour", views=("tx_pca",), sql=f"""
WITH {_PCA_TS}
SELECT CAST(sample_datetime AS DATE) AS date, CAST(hour(sample_datetime) AS INTEGER) AS hour,
       round(stddev_samp(v10), 6) AS v10_stddev, round(min(v10), 6) AS v10_min,
       round(max(v10), 6) AS v10_max, round(avg(v10), 6) AS v10_avg,
       round(stddev_samp(v11), 6) AS v11_stddev, round(min(v11), 6) AS v11_min,
       round(max(v11), 6) AS v11_max, round(avg(v11), 6) AS v11_avg,
       min(amount) AS amount_min, max(amount) AS amount_max,
       {sql_mean('amount')} AS amount_avg, CAST(sum(class) AS BIGINT) AS class_sum,
       count(class) AS class_count
FROM pca GROUP BY 1, 2""")
def e3_agg_date_hour(spark, sf_dir):
    """Aggregate keyed by computed (date, hour) expressions."""
    keys = [F.to_date("sample_datetime").alias("date"), F.hour("sample_datetime").alias("hour")]
    return rounded(aggregate(pca(spark, sf_dir), keys, DATE_HOUR_FUNCS),
                   [f"{c}_{f}" for c in ("v10", "v11") for f in ("stddev", "min", "max", "avg")])


@register("e3_agg_date_hour_card", views=("tx_card",), sql=f"""
WITH {_CARD_TS}
SELECT CAST(sample_datetime AS DATE) AS date, CAST(hour(sample_datetime) AS INTEGER) AS hour,
       round(stddev_samp(TransactionAmt), 6) AS TransactionAmt_stddev,
       min(TransactionAmt) AS TransactionAmt_min,
       max(TransactionAmt) AS TransactionAmt_max,
       {sql_mean('TransactionAmt')} AS TransactionAmt_avg,
       CAST(sum(isFraud) AS BIGINT) AS isFraud_sum, count(isFraud) AS isFraud_count
FROM card GROUP BY 1, 2""")
def e3_agg_date_hour_card(spark, sf_dir):
    """E3 on the card data: 24 hours x 30 days of groups."""
    keys = [F.to_date("sample_datetime").alias("date"), F.hour("sample_datetime").alias("hour")]
    funcs = {"TransactionAmt": [F.stddev, F.min, F.max, cents_avg], "isFraud": [F.sum, F.count]}
    return rounded(aggregate(card(spark, sf_dir, parts=False), keys, funcs), ["TransactionAmt_stddev"])


@register("e5_daily_fraud_rate", views=("tx_orders",), sql="""
WITH g AS (SELECT CAST(sample_datetime AS DATE) AS day, avg(isFraud) AS r FROM tx_orders GROUP BY 1),
sp AS (SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
                                          INTERVAL 1 DAY)) AS DATE) AS day FROM g)
SELECT sp.day, round(r, 6) AS rate FROM sp LEFT JOIN g USING (day)""")
def e5_daily_fraud_rate(spark, sf_dir):
    """E5: daily mean of the label with empty days kept as null."""
    return rounded(daily_rate(load(spark, sf_dir, "tx_orders"), "sample_datetime", "isFraud"))


@register("e6_period_statistics", views=("tx_card",), sql=f"""
WITH {_CARD_TS},
f AS (SELECT * FROM cardp WHERE isFraud = 1),
s AS (
  SELECT 'TransactionAmt' AS feature, 'sum' AS statistic, 'day' AS period, CAST(day AS VARCHAR) AS period_value,
         coalesce(sum(TransactionAmt), 0) AS value FROM f GROUP BY day
  UNION ALL SELECT 'TransactionAmt', 'sum', 'hour', CAST(hour AS VARCHAR), coalesce(sum(TransactionAmt), 0)
         FROM f GROUP BY hour
  UNION ALL SELECT 'TransactionAmt', 'sum', 'week', CAST(week AS VARCHAR), coalesce(sum(TransactionAmt), 0)
         FROM f GROUP BY week
  UNION ALL SELECT 'TransactionID', 'size', 'day', CAST(day AS VARCHAR), count(*) FROM f GROUP BY day
  UNION ALL SELECT 'TransactionID', 'size', 'week', CAST(week AS VARCHAR), count(*) FROM f GROUP BY week
  UNION ALL SELECT 'TransactionID', 'size', 'day_of_week', CAST(day_of_week AS VARCHAR), count(*)
         FROM f GROUP BY day_of_week)
SELECT feature, statistic, period, period_value, round(CAST(value AS DOUBLE), 6) AS value FROM s""")
def e6_period_statistics(spark, sf_dir):
    """Statistic of each feature per period over the fraud rows."""
    return rounded(period_statistics(card(spark, sf_dir), PERIOD_STATISTICS))


@register("e8_fraud_pivot_day_size", views=("tx_card",), sql=f"""
WITH {_CARD_TS}
SELECT day, CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) AS isFraud_0,
       CAST(count(*) FILTER (WHERE isFraud = 1) AS DOUBLE) AS isFraud_1
FROM cardp GROUP BY day""")
def e8_fraud_pivot_day_size(spark, sf_dir):
    """Rows per day split by label into two columns."""
    return fraud_pivot(card(spark, sf_dir), "day", "size", "TransactionID")


@register("e8_fraud_pivot_hour_sum", views=("tx_card",), sql=f"""
WITH {_CARD_TS}
SELECT hour, round(coalesce(sum(TransactionAmt) FILTER (WHERE isFraud = 0), 0), 6) AS isFraud_0,
       round(coalesce(sum(TransactionAmt) FILTER (WHERE isFraud = 1), 0), 6) AS isFraud_1
FROM cardp GROUP BY hour""")
def e8_fraud_pivot_hour_sum(spark, sf_dir):
    """Amount per hour split by label."""
    return rounded(fraud_pivot(card(spark, sf_dir), "hour", "sum", "TransactionAmt"))
