"""Registered queries: report table and streaming run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerflow.functions.columns import fmt2
from ledgerflow.operators import quality as Q
from ledgerflow.operators import sketches as S
from ledgerflow.plans.registry import register, rounded
from ledgerflow.session import ensure_checkpoint_dir
from ledgerflow.sources.files import CORRUPT, read_csv_quarantine, write_table
from ledgerflow.sources.fixtures import load
from ledgerflow.sources.tables import read_table
from ledgerflow.streaming.realtime import (baseline, flag_stream, hourly_stream, read_parquet_stream, run_appends,
                                            run_running_flags, run_upserts, running_flags, time_slices)


@register("a8_report_table", views=("tx_nulls",), sql="""
SELECT * FROM (
  SELECT 'transaction_amount' AS section, unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS metric,
         unnest([printf('%.2f', CAST(count(TransactionAmt) AS DOUBLE)), printf('%.2f', avg(TransactionAmt)),
                 printf('%.2f', stddev_samp(TransactionAmt)), printf('%.2f', min(TransactionAmt)),
                 printf('%.2f', quantile_cont(TransactionAmt, 0.25)), printf('%.2f', quantile_cont(TransactionAmt, 0.5)),
                 printf('%.2f', quantile_cont(TransactionAmt, 0.75)), printf('%.2f', max(TransactionAmt))]) AS value
  FROM tx_nulls
  UNION ALL
  SELECT 'fraud_distribution', CAST(isFraud AS VARCHAR),
         printf('%.2f', count(*) / CAST((SELECT count(isFraud) FROM tx_nulls) AS DOUBLE))
  FROM tx_nulls WHERE isFraud IS NOT NULL GROUP BY isFraud)""")
def a8_report_table(spark, sf_dir):
    """The final report's numbers (amount summary, label shares) as a
    table of two-decimal strings."""
    t = load(spark, sf_dir, "tx_nulls")
    d = Q.describe(t, ["TransactionAmt"]).select(F.lit("transaction_amount").alias("section"),
                                                 F.col("statistic").alias("metric"), fmt2("value").alias("value"))
    s = Q.value_shares(t, "isFraud").select(F.lit("fraud_distribution").alias("section"),
                                           F.col("value").cast("string").alias("metric"), fmt2("share").alias("value"))
    return d.unionByName(s)


@register("a9_quality_json")
def a9_quality_json(spark, sf_dir):
    """The quality report as JSON lines (one object per entry)."""
    rep = Q.quality_report(load(spark, sf_dir, "tx_nulls"))
    return rep.select(F.to_json(F.struct(*rep.columns)).alias("json"))


def _event_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return read_parquet_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema)


@register("x3_stream_hourly", sql="""
SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS sample_datetime, round(avg(value), 6) AS value_mean,
       round(sum(value), 6) AS value_sum, count(DISTINCT event_type) AS event_type_nunique
FROM events GROUP BY 1""")
def x3_stream_hourly(spark, sf_dir):
    """The hourly aggregate of the card events computed by a Structured
    Streaming query (watermark of a day, event-time windows) run to completion."""
    out = hourly_stream(_event_stream(spark, sf_dir), "ts", "value", "event_type", delay="1 day")
    return rounded(run_upserts(out, ["sample_datetime"]))


@register("x3_stream_flags", sql="""
WITH b AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY event_type)
SELECT event_id, CASE WHEN abs((value - m) / s) > 2 THEN 1 ELSE 0 END AS anomaly_score
FROM events JOIN b USING (event_type)""")
def x3_stream_flags(spark, sf_dir):
    """Events flagged on a stream by their distance from the type's mean
    (more than two standard deviations), against a batch baseline."""
    base = baseline(read_table(spark, sf_dir, "events"), "event_type", "value")
    flags = flag_stream(_event_stream(spark, sf_dir), base, "event_type", "value", threshold=2.0)
    return run_appends(flags.select("event_id", "anomaly_score"))


@register("x3_running_flags", sql="""
SELECT event_type, event_id, count(value) OVER w AS seen,
       CASE WHEN count(value) OVER w >= 30 AND abs(value - avg(value) OVER w) > 2 * stddev_pop(value) OVER w THEN 1 ELSE 0 END AS anomaly_score
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def x3_running_flags(spark, sf_dir):
    """Events flagged against the running mean and deviation of all earlier events of their type,
    kept as stream state over six micro-batches in time order."""
    events = read_table(spark, sf_dir, "events")
    source = read_parquet_stream(spark, time_slices(events, "ts", 6), events.schema)
    scored, _ = run_running_flags(running_flags(source, "ts", "event_id", "event_type", "value", threshold=2.0))
    return scored.select("event_type", "event_id", "seen", "anomaly_score")


def _shared(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("a3_csv_quarantine", sql="""
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value, event_type,
       CASE WHEN event_id % 97 = 0 THEN event_id || ',n/a,' || event_type END AS corrupt FROM events""")
def a3_csv_quarantine(spark, sf_dir):
    """The events written as CSV, every 97th with an amount that is no number, read back with a
    schema; the lines that do not fit it are kept as they are."""
    path = _shared(spark, "events-csv")
    amount = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    write_table(read_table(spark, sf_dir, "events").select("event_id", amount.alias("value"), "event_type"), path, "csv")
    good, bad = read_csv_quarantine(spark, path, "event_id long, value double, event_type string")
    return good.withColumn("corrupt", F.lit(None).cast("string")).unionByName(bad.withColumnRenamed(CORRUPT, "corrupt"))


@register("x2_set_rules", sql="""
SELECT 'line_number_unique' AS rule, l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL
SELECT 'big_order_exists', l_orderkey, l_linenumber, count(*) FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 100000) GROUP BY 2, 3""")
def x2_set_rules(spark, sf_dir):
    """Rules over more than one row: lines whose number is not unique in their order, and lines
    whose order is not among those above 100,000."""
    lines = read_table(spark, sf_dir, "lineitem")
    big = read_table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 100_000)
    failing = {"line_number_unique": Q.not_unique(lines, ["l_orderkey", "l_linenumber"]),
               "big_order_exists": Q.without_reference(lines, ["l_orderkey"], big, ["o_orderkey"])}
    out = None
    for name, rows in failing.items():
        part = rows.groupBy(F.lit(name).alias("rule"), "l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-24"
_EVENT_DAYS = f"events WHERE CAST(ts AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"


def _event_sketches(spark, sf_dir):
    path = _shared(spark, "event-sketches")
    S.store_sketches(S.daily_sketches(read_table(spark, sf_dir, "events"), "ts", ["value", "user_id", "event_type"]), path)
    return S.stored_sketches(spark, path)


@register("e18_sketch_quantiles", sql=f"""
SELECT 'value' AS "column", count(value) AS n, unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS prob, true AS within FROM {_EVENT_DAYS}""")
def e18_sketch_quantiles(spark, sf_dir):
    """Quantiles of twenty days from stored daily sketches; ``within`` says whether the exact rank of each is within
    the sketch's error."""
    est = S.range_quantiles(_event_sketches(spark, sf_dir), FIRST_DAY, LAST_DAY, [0.05, 0.25, 0.5, 0.75, 0.95]).filter("column = 'value'")
    raw = read_table(spark, sf_dir, "events").filter(F.to_date("ts").between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")))
    ranked = raw.select(F.col("value").alias("v")).filter("v is not null").crossJoin(F.broadcast(est))  # five rows
    e = F.lit(S.RANK_ERROR)
    within = (F.count_if(F.col("v") < F.col("value")) / F.col("n") <= F.col("prob") + e) & (
        F.count_if(F.col("v") <= F.col("value")) / F.col("n") >= F.col("prob") - e)
    return ranked.groupBy("column", "n", "prob", "value").agg(within.alias("within")).drop("value")


@register("e16_sketch_distinct", sql=f"""
SELECT unnest(['value', 'user_id', 'event_type']) AS "column", count(*) AS n, true AS within FROM {_EVENT_DAYS}""")
def e16_sketch_distinct(spark, sf_dir):
    """Distinct values of twenty days from stored daily sketches, against the exact counts."""
    est = S.range_distinct(_event_sketches(spark, sf_dir), FIRST_DAY, LAST_DAY)
    raw = read_table(spark, sf_dir, "events").filter(F.to_date("ts").between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")))
    exact = Q.distinct_counts(raw, ["value", "user_id", "event_type"]).withColumnRenamed("distinct", "exact")
    within = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * F.lit(S.DISTINCT_ERROR) + 0.5
    return est.join(exact, "column").select("column", "n", within.alias("within"))
