"""Registered queries: daily series, decomposition, ACF/PACF, diagnostics
(E5, K1-K3, K8, K9, D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.normal import inverse_normal_sql
from ledgerflow.operators.joins import aligned_difference
from ledgerflow.operators.series import (acf, daily_series, decompose, pacf, qq_points,
                                         residual_diagnostics)
from ledgerflow.plans.agg_queries import _CARD_TS, card
from ledgerflow.plans.registry import register, rounded
from ledgerflow.sources.fixtures import load

NLAGS = 50


def card_rate(spark, sf_dir):
    """Daily fraud rate of the card data (one series, no empty days)."""
    return daily_series(card(spark, sf_dir, parts=False), None, "sample_datetime", "isFraud", "error")


def order_counts(spark, sf_dir):
    """Daily order count per priority (five series); empty days count 0."""
    o = load(spark, sf_dir, "tx_orders")
    return daily_series(o, "priority", "sample_datetime", "TransactionID", "zero",
                        agg=lambda c: F.count(c).cast("double"))


_CARD_RATE = f"""{_CARD_TS},
base AS (SELECT 'all' AS series, CAST(sample_datetime AS DATE) AS day, avg(isFraud) AS value FROM card GROUP BY 2)"""

_ORDER_COUNTS = """g AS (SELECT priority AS series, CAST(sample_datetime AS DATE) AS day,
                      CAST(count(TransactionID) AS DOUBLE) AS value FROM tx_orders GROUP BY 1, 2),
sp AS (SELECT series, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
                                                  INTERVAL 1 DAY)) AS DATE) AS day FROM g GROUP BY series),
base AS (SELECT sp.series, sp.day, coalesce(g.value, 0.0) AS value FROM sp LEFT JOIN g USING (series, day))"""


def _decompose_sql(base_ctes):
    return f"""WITH {base_ctes},
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS INTEGER) AS t FROM base),
tr AS (SELECT *, CASE WHEN count(value) OVER w = 7 THEN avg(value) OVER w END AS trend, t % 7 AS phase FROM x
       WINDOW w AS (PARTITION BY series ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
pm AS (SELECT series, phase, avg(value - trend) AS pmean FROM tr GROUP BY 1, 2),
c AS (SELECT series, avg(pmean) AS centre FROM pm GROUP BY 1)
SELECT tr.series, day, t, round(value, 6) AS value, round(trend, 6) AS trend,
       round(pmean - centre, 6) AS seasonal, round(value - trend - (pmean - centre), 6) AS resid
FROM tr JOIN pm USING (series, phase) JOIN c USING (series)"""


@register("k1_decompose_card", views=("tx_card",), sql=_decompose_sql(_CARD_RATE[0:]))
def k1_decompose_card(spark, sf_dir):
    """K1/E5: additive weekly decomposition of the daily fraud rate."""
    return rounded(decompose(card_rate(spark, sf_dir), 7))


@register("k1_decompose_orders", views=("tx_orders",), sql=_decompose_sql(_ORDER_COUNTS))
def k1_decompose_orders(spark, sf_dir):
    """K1 on five daily series at once (gaps filled with 0)."""
    return rounded(decompose(order_counts(spark, sf_dir), 7))


def _acf_sql(base_ctes):
    return f"""WITH {base_ctes},
x AS (SELECT series, CAST(row_number() OVER (PARTITION BY series ORDER BY day) - 1 AS INTEGER) AS t,
             value - avg(value) OVER (PARTITION BY series) AS d, count(*) OVER (PARTITION BY series) AS n
      FROM base WHERE value IS NOT NULL),
l AS (SELECT x.*, unnest(range(0, {NLAGS} + 1)) AS lag FROM x),
r AS (SELECT l.series, CAST(l.lag AS INTEGER) AS lag, sum(l.d * x2.d) / (SELECT sum(d * d) FROM x x3
             WHERE x3.series = l.series) AS acf, any_value(l.n) AS n
      FROM l JOIN x x2 ON x2.series = l.series AND x2.t = l.t + l.lag WHERE l.lag < l.n GROUP BY 1, 2)
SELECT series, lag, round(acf, 6) AS acf,
       round(CASE WHEN lag = 0 THEN 0.0 ELSE 1.96 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END)
         OVER (PARTITION BY series ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6)
         AS band, n
FROM r"""


@register("k2_acf_card", views=("tx_card",), sql=_acf_sql(_CARD_RATE))
def k2_acf_card(spark, sf_dir):
    """K2: ACF of the daily fraud rate with Bartlett band (lags < n)."""
    return rounded(acf(card_rate(spark, sf_dir), NLAGS))


@register("k2_acf_orders", views=("tx_orders",), sql=_acf_sql(_ORDER_COUNTS))
def k2_acf_orders(spark, sf_dir):
    """K2 on five series of 2,400 days, lags 0-50."""
    return rounded(acf(order_counts(spark, sf_dir), NLAGS))


def _pacf_sql(base_ctes):
    acf_ctes = _acf_sql(base_ctes)
    return acf_ctes[:acf_ctes.index("SELECT series, lag, round(acf, 6)")].rstrip() + f""",
q AS (SELECT series, list(acf ORDER BY lag) AS r, any_value(n) AS n, least({NLAGS}, any_value(n) // 2 - 1) AS last FROM r GROUP BY series)
SELECT * FROM (
WITH RECURSIVE f AS (SELECT series, r, n, last, 0 AS k, CAST([] AS DOUBLE[]) AS phi, r[1] AS v, r[1] AS pacf FROM q
      UNION ALL
      SELECT series, r, n, last, k + 1, list_concat([phi[j] - x * phi[k + 1 - j] FOR j IN range(1, k + 1)], [x]), v * (1 - x * x), x
      FROM (SELECT *, (r[k + 2] - coalesce(list_sum([phi[j] * r[k + 2 - j] FOR j IN range(1, k + 1)]), 0)) / v AS x FROM f WHERE k < last))
SELECT series, CAST(k AS INTEGER) AS lag, round(pacf, 6) AS pacf, round(1.96 / sqrt(n), 6) AS band FROM f)"""


@register("k3_pacf_orders", views=("tx_orders",), sql=_pacf_sql(_ORDER_COUNTS))
def k3_pacf_orders(spark, sf_dir):
    """K3: PACF (Yule-Walker, Durbin-Levinson per series) to lag 50."""
    return rounded(pacf(order_counts(spark, sf_dir), NLAGS))


@register("k3_pacf_card", views=("tx_card",), sql=_pacf_sql(_CARD_RATE))
def k3_pacf_card(spark, sf_dir):
    """K3: PACF of the daily fraud rate, lags below half its length."""
    return rounded(pacf(card_rate(spark, sf_dir), NLAGS))


def _diag_sql(base_ctes):
    return _decompose_sql(base_ctes).replace("SELECT tr.series, day, t,", "SELECT tr.series, day, t, value - trend - (pmean - centre) AS r_raw,", 1).join(
        ["WITH dec AS (", f""") ,
rr AS (SELECT series, day, r_raw AS r FROM dec WHERE r_raw IS NOT NULL),
mom AS (SELECT series, count(*) AS n, avg(r) AS m FROM rr GROUP BY 1),
y AS (SELECT rr.series, rr.day, r, r - m AS d, n,
             CAST(row_number() OVER (PARTITION BY rr.series ORDER BY day) - 1 AS INTEGER) AS t FROM rr JOIN mom USING (series)),
mm AS (SELECT series, any_value(n) AS n, avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4 FROM y GROUP BY 1),
sk AS (SELECT series, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurtosis FROM mm),
hs AS (SELECT series, sum(CASE WHEN t >= n - round(n / 3) THEN r * r END)
                    / sum(CASE WHEN t < round(n / 3) THEN r * r END) AS het_h FROM y GROUP BY 1),
l AS (SELECT y.*, unnest(range(1, 11)) AS lag FROM y),
ac AS (SELECT l.series, l.lag, sum(l.d * y2.d) / (SELECT sum(d * d) FROM y y3 WHERE y3.series = l.series) AS acf,
              any_value(l.n) AS n
       FROM l JOIN y y2 ON y2.series = l.series AND y2.t = l.t + l.lag WHERE l.lag < l.n GROUP BY 1, 2),
lb AS (SELECT series, sum(CASE WHEN lag <= 1 THEN n * (n + 2) * acf * acf / (n - lag) END) AS ljung_box_1,
              sum(CASE WHEN lag <= 10 THEN n * (n + 2) * acf * acf / (n - lag) END) AS ljung_box_10 FROM ac GROUP BY 1)
SELECT series, n, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis,
       round(n / 6 * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4), 6) AS jarque_bera,
       round(het_h, 6) AS het_h, round(ljung_box_1, 6) AS ljung_box_1, round(ljung_box_10, 6) AS ljung_box_10
FROM sk JOIN hs USING (series) JOIN lb USING (series)"""])


@register("k8_residual_diagnostics", views=("tx_orders",), sql=_diag_sql(_ORDER_COUNTS))
def k8_residual_diagnostics(spark, sf_dir):
    """K8: Ljung-Box (lags 1, 10), Jarque-Bera, H, skew and kurtosis of the
    decomposition residuals of each series."""
    dec = decompose(order_counts(spark, sf_dir), 7)
    return rounded(residual_diagnostics(dec, "resid", (1, 10)), ["skew", "kurtosis", "jarque_bera", "het_h",
                                                                 "ljung_box_1", "ljung_box_10"])


def _qq_sql(base_ctes):
    dec = _decompose_sql(base_ctes)
    return f"""WITH dec AS ({dec}),
o AS (SELECT series, day, resid AS sample, row_number() OVER (PARTITION BY series ORDER BY resid, day) AS i,
             count(*) OVER (PARTITION BY series) AS n FROM dec WHERE resid IS NOT NULL),
p AS (SELECT *, CAST(i AS DOUBLE) / CAST(n + 1 AS DOUBLE) AS p FROM o)
SELECT series, day, CAST(i AS INTEGER) AS i, sample, round({inverse_normal_sql("p")}, 6) AS theoretical FROM p"""


@register("k9_qq_points", views=("tx_orders",), sql=_qq_sql(_ORDER_COUNTS))
def k9_qq_points(spark, sf_dir):
    """K9: normal Q-Q points of the decomposition residuals per series (residuals to six digits,
    whose ties go by day)."""
    dec = rounded(decompose(order_counts(spark, sf_dir), 7), ["resid"])
    return rounded(qq_points(dec, "resid"), ["theoretical"])


@register("d2_observed_minus_trend", views=("tx_orders",), sql=_decompose_sql(_ORDER_COUNTS).replace(
    "SELECT tr.series, day, t, round(value, 6) AS value, round(trend, 6) AS trend,\n"
    "       round(pmean - centre, 6) AS seasonal, round(value - trend - (pmean - centre), 6) AS resid",
    "SELECT tr.series, day, round(value - trend, 6) AS difference"))
def d2_observed_minus_trend(spark, sf_dir):
    """Index-aligned subtraction (full outer join on series and day) of
    the trend from the observed series."""
    counts = order_counts(spark, sf_dir)
    return rounded(aligned_difference(counts, decompose(counts, 7), ["series", "day"], "value", "trend"))
