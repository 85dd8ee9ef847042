"""Registered queries: window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.money import cents, cents_mean, sql_mean
from ledgerflow.operators.aggregate import aggregate
from ledgerflow.operators.windows import rolling_period_stats, window_features
from ledgerflow.plans.agg_queries import _CARD_TS, card
from ledgerflow.plans.registry import register, rounded

ORDER = ["sample_datetime", "TransactionID"]
FEATURES = ["TransactionID", "month", "row_number", "rank", "next_transaction_amt", "prev_transaction_amt",
            "cumulative_sum", "rolling_avg_3", "rolling_max", "rolling_min"]


@register("g_window_features", views=("tx_card",), sql=f"""
WITH {_CARD_TS},
w AS (SELECT *, CAST(round(TransactionAmt * 100) AS BIGINT) AS c FROM cardp)
SELECT TransactionID, month,
  CAST(row_number() OVER (PARTITION BY month ORDER BY sample_datetime, TransactionID) AS INTEGER) AS row_number,
  CASE WHEN TransactionAmt IS NOT NULL THEN
    CAST(rank() OVER (PARTITION BY month ORDER BY TransactionAmt DESC NULLS LAST) AS INTEGER) END AS rank,
  lead(TransactionAmt) OVER (ORDER BY sample_datetime, TransactionID) AS next_transaction_amt,
  lag(TransactionAmt) OVER (ORDER BY sample_datetime, TransactionID) AS prev_transaction_amt,
  CASE WHEN TransactionAmt IS NOT NULL THEN CAST(sum(c) OVER (PARTITION BY month ORDER BY sample_datetime,
    TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100.0 END AS cumulative_sum,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN round(avg(TransactionAmt) OVER r, 6) END AS rolling_avg_3,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN max(TransactionAmt) OVER r END AS rolling_max,
  CASE WHEN count(TransactionAmt) OVER r = 3 THEN min(TransactionAmt) OVER r END AS rolling_min
FROM w
WINDOW r AS (ORDER BY sample_datetime, TransactionID ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def g_window_features(spark, sf_dir):
    """Row number and rank per month, lead, lag, running sum per
    month, rolling-3 mean/max/min over the whole table, all distributed."""
    c = card(spark, sf_dir, parts=False).withColumn("_cents", cents(F.col("TransactionAmt")))
    f = window_features(c.select(*ORDER, "TransactionAmt", "_cents"), ORDER, amount="TransactionAmt", cents_col="_cents")
    return rounded(f.select(*FEATURES), ["rolling_avg_3"])


def _fraud_rate(spark, sf_dir, period):
    fr = card(spark, sf_dir).filter(F.col("isFraud") == 1)
    return aggregate(fr.filter(F.col(period).isNotNull()), [period], {"TransactionAmt": cents_mean})


def _g8_sql(period):
    return f"""
WITH {_CARD_TS},
s AS (SELECT {period}, {sql_mean('TransactionAmt')} AS TransactionAmt_mean FROM cardp
      WHERE isFraud = 1 AND {period} IS NOT NULL GROUP BY {period})
SELECT {period}, TransactionAmt_mean,
  CASE WHEN count(TransactionAmt_mean) OVER r = 7 THEN round(avg(TransactionAmt_mean) OVER r, 6) END AS rolling_mean,
  CASE WHEN count(TransactionAmt_mean) OVER r = 7 THEN round(stddev_samp(TransactionAmt_mean) OVER r, 6) END
    AS rolling_std
FROM s WINDOW r AS (ORDER BY {period} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


@register("g8_rolling_day", views=("tx_card",), sql=_g8_sql("day"))
def g8_rolling_day(spark, sf_dir):
    """Fraud-row mean amount per day with its 7-day rolling mean/std."""
    s = _fraud_rate(spark, sf_dir, "day")
    return rounded(rolling_period_stats(s, "day", "TransactionAmt_mean", 7), ["rolling_mean", "rolling_std"])


@register("g8_rolling_hour", views=("tx_card",), sql=_g8_sql("hour"))
def g8_rolling_hour(spark, sf_dir):
    """G8 over the hour-of-day series."""
    s = _fraud_rate(spark, sf_dir, "hour")
    return rounded(rolling_period_stats(s, "hour", "TransactionAmt_mean", 7), ["rolling_mean", "rolling_std"])


def _e7_sql(period):
    return f"""
WITH {_CARD_TS},
s AS (SELECT {period}, avg(isFraud) AS fraud_rate FROM cardp WHERE {period} IS NOT NULL GROUP BY {period})
SELECT {period}, round(fraud_rate, 6) AS fraud_rate,
  CASE WHEN count(fraud_rate) OVER r = 7 THEN round(avg(fraud_rate) OVER r, 6) END AS rolling_mean,
  CASE WHEN count(fraud_rate) OVER r = 7 THEN round(stddev_samp(fraud_rate) OVER r, 6) END AS rolling_std
FROM s WINDOW r AS (ORDER BY {period} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) ORDER BY {period}"""


def _e7(spark, sf_dir, period):
    """Fraud rate per period over all rows with its rolling statistics, in period order (H4)."""
    rate = card(spark, sf_dir).filter(F.col(period).isNotNull()).groupBy(period).agg(F.avg("isFraud").alias("fraud_rate"))
    return rounded(rolling_period_stats(rate, period, "fraud_rate", 7).orderBy(period),
                   ["fraud_rate", "rolling_mean", "rolling_std"])


@register("e7_rate_day", views=("tx_card",), sql=_e7_sql("day"))
def e7_rate_day(spark, sf_dir):
    """E7/G8 ``size`` branch: daily fraud rate over all rows, rolling mean and std of 7 days."""
    return _e7(spark, sf_dir, "day")


@register("e7_rate_hour", views=("tx_card",), sql=_e7_sql("hour"))
def e7_rate_hour(spark, sf_dir):
    """E7/G8 ``size`` branch by hour of day."""
    return _e7(spark, sf_dir, "hour")


@register("e7_rate_week", views=("tx_card",), sql=_e7_sql("week"))
def e7_rate_week(spark, sf_dir):
    """E7/G8 ``size`` branch by ISO week."""
    return _e7(spark, sf_dir, "week")


@register("e7_rate_weekday", views=("tx_card",), sql=_e7_sql("day_of_week"))
def e7_rate_weekday(spark, sf_dir):
    """E7/G8 ``size`` branch by day of week."""
    return _e7(spark, sf_dir, "day_of_week")


E8_PERIODS = ("day", "hour", "week", "day_of_week")


def _e8_sql():
    parts = []
    for p in E8_PERIODS:
        for stat, agg in (("size", "count(*)"), ("sum", "CAST(coalesce(sum(c), 0) AS DOUBLE) / 100.0"), ("mean", "avg(TransactionAmt)")):
            parts.append(f"""SELECT '{p}' AS period, CAST({p} AS VARCHAR) AS period_value, '{stat}' AS statistic,
  round(coalesce(max(v) FILTER (isFraud = 0), 0), 6) AS isFraud_0, round(coalesce(max(v) FILTER (isFraud = 1), 0), 6) AS isFraud_1
FROM (SELECT {p}, isFraud, CAST({agg} AS DOUBLE) AS v FROM w WHERE {p} IS NOT NULL GROUP BY {p}, isFraud) GROUP BY {p}""")
    return f"WITH {_CARD_TS}, w AS (SELECT *, CAST(round(TransactionAmt * 100) AS BIGINT) AS c FROM cardp) " + " UNION ALL ".join(parts)


@register("e8_all_periods", views=("tx_card",), sql=_e8_sql())
def e8_all_periods(spark, sf_dir):
    """Fraud against non-fraud for every period and statistic (size, sum,
    mean) of the amount, from one aggregate over the unpivoted periods."""
    w = card(spark, sf_dir).withColumn("_c", cents(F.col("TransactionAmt")))
    long = w.select("isFraud", "TransactionAmt", "_c", F.explode(F.array(*[F.struct(
        F.lit(p).alias("period"), F.col(p).cast("string").alias("period_value")) for p in E8_PERIODS])).alias("x")).select(
        "isFraud", "TransactionAmt", "_c", "x.*").where("period_value is not null")
    g = long.groupBy("period", "period_value", "isFraud").agg(
        F.count(F.lit(1)).cast("double").alias("size"), (F.coalesce(F.sum("_c"), F.lit(0)).cast("double") / 100.0).alias("sum"),
        F.avg("TransactionAmt").alias("mean"))
    g = g.select("period", "period_value", "isFraud", F.expr("stack(3, 'size', size, 'sum', sum, 'mean', mean) AS (statistic, v)"))
    cells = [F.coalesce(F.max(F.when(F.col("isFraud") == y, F.col("v"))), F.lit(0.0)).alias(f"isFraud_{y}") for y in (0, 1)]
    out = g.groupBy("period", "period_value", "statistic").agg(*cells).orderBy("period", "period_value", "statistic")
    return rounded(out, ["isFraud_0", "isFraud_1"])
