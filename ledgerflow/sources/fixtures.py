"""Transaction views derived from the driver tables.

The reference reads three external transaction datasets.  Each view below
stands in for one of them and is built lazily from the parquet tables, so its
size grows with the scale factor.  Every view has a Spark builder and the same
definition in SQL text (used only by the DuckDB oracle); the two are kept side
by side so they cannot drift apart.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.tables import read_table

# Fixed anchors: elapsed-time columns count from these instants.
CARD_EPOCH = dt.datetime(2024, 1, 1)
MOBILE_EPOCH = dt.datetime(1995, 1, 1)
CARD_EPOCH_UNIX = 1704067200  # seconds from 1970-01-01 to CARD_EPOCH (UTC)

# Currency lookup keyed by event type.
FX_RATES = [
    ("click", "EUR", 1.08),
    ("error", "CHF", 1.12),
    ("purchase", "USD", 1.0),
    ("signup", "GBP", 1.27),
    ("view", "JPY", 0.0067),
]


def _ntz(ts: dt.datetime) -> Column:
    # From text, so the literal does not depend on the session time zone.
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def tx_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions (stand-in for the card-fraud transaction file)."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("TransactionID"),
        F.timestamp_diff("SECOND", _ntz(CARD_EPOCH), F.col("ts")).alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        (F.col("event_type") == "error").cast("int").alias("isFraud"),
        F.col("user_id").alias("card1"),
        F.col("event_type").alias("ProductCD"),
    )


def tx_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity side of the card data; only every fourth transaction has one."""
    e = read_table(spark, sf_dir, "events")
    return e.filter(F.col("event_id") % 4 == 0).select(
        F.col("event_id").alias("TransactionID"),
        F.col("user_id").alias("id_01"),
        F.get_json_object("props", "$.k").cast("int").alias("id_02"),
    )


def tx_mobile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile-money transactions (hour steps, name classes C/M)."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    amount = F.col("l_extendedprice")
    return j.select(
        F.timestamp_diff("HOUR", _ntz(MOBILE_EPOCH), F.col("l_shipdate")).cast("int").alias("step"),
        F.col("l_returnflag").alias("type"),
        amount.alias("amount"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("M"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("nameOrig"),
        F.col("o_totalprice").alias("oldbalanceOrg"),
        (F.col("o_totalprice") - amount).alias("newbalanceOrig"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("M"), F.col("l_suppkey").cast("string")))
        .otherwise(F.concat(F.lit("C"), F.col("l_partkey").cast("string"))).alias("nameDest"),
        F.col("o_totalprice").alias("oldbalanceDest"),
        (F.col("o_totalprice") + amount).alias("newbalanceDest"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).cast("int").alias("isFraud"),
        (amount > 100000).cast("int").alias("isFlaggedFraud"),
    )


def tx_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions with PCA features v1..v28 (header Time, V1.., Amount, Class)."""
    e = read_table(spark, sf_dir, "embeddings")
    v = [F.col("embedding")[i].cast("double").alias(f"V{i + 1}") for i in range(28)]
    return e.select(
        F.col("vec_id").alias("Time"),
        *v,
        (F.floor(F.abs(F.col("embedding")[0].cast("double")) * 10000) / 100).alias("Amount"),
        (F.col("label") == 0).cast("int").alias("Class"),
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-grained transactions whose calendar has empty days."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("TransactionID"),
        F.col("o_orderdate").alias("sample_datetime"),
        F.col("o_totalprice").alias("TransactionAmt"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("isFraud"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def tx_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions with planted missing values."""
    t = tx_card(spark, sf_dir)
    return t.select(
        "TransactionID", "TransactionDT",
        F.when(F.col("TransactionID") % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("TransactionAmt")).alias("TransactionAmt"),
        F.when(F.col("TransactionID") % 101 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("isFraud")).alias("isFraud"),
        "card1", "ProductCD",
    )


def tx_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card transactions with every fiftieth row repeated once."""
    t = tx_card(spark, sf_dir)
    return t.unionAll(t.filter(F.col("TransactionID") % 50 == 0))


def fx_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FX_RATES, "event_type string, currency string, rate double")


BUILDERS = {
    "tx_card": tx_card,
    "tx_identity": tx_identity,
    "tx_mobile": tx_mobile,
    "tx_pca": tx_pca,
    "tx_orders": tx_orders,
    "tx_nulls": tx_nulls,
    "tx_dups": tx_dups,
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "fx_rates":
        return fx_rates(spark)
    return BUILDERS[name](spark, sf_dir)


# --- the same views as SQL text, for the DuckDB oracle only ---------------

_PCA_COLS = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS V{i + 1}" for i in range(28))
_FX_VALUES = ", ".join(f"('{a}', '{b}', CAST({c} AS DOUBLE))" for a, b, c in FX_RATES)

VIEW_SQL = {
    "tx_card": f"""
        SELECT event_id AS TransactionID,
               CAST(floor(epoch(ts)) AS BIGINT) - {CARD_EPOCH_UNIX} AS TransactionDT,
               value AS TransactionAmt,
               CAST(event_type = 'error' AS INTEGER) AS isFraud,
               user_id AS card1,
               event_type AS ProductCD
        FROM events""",
    "tx_identity": """
        SELECT event_id AS TransactionID, user_id AS id_01,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS id_02
        FROM events WHERE event_id % 4 = 0""",
    "tx_mobile": """
        SELECT CAST(date_diff('hour', TIMESTAMP '1995-01-01', l_shipdate) AS INTEGER) AS step,
               l_returnflag AS type,
               l_extendedprice AS amount,
               CASE WHEN o_orderstatus = 'P' THEN 'M' || CAST(o_custkey AS VARCHAR)
                    ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS nameOrig,
               o_totalprice AS oldbalanceOrg,
               o_totalprice - l_extendedprice AS newbalanceOrig,
               CASE WHEN l_linestatus = 'O' THEN 'M' || CAST(l_suppkey AS VARCHAR)
                    ELSE 'C' || CAST(l_partkey AS VARCHAR) END AS nameDest,
               o_totalprice AS oldbalanceDest,
               o_totalprice + l_extendedprice AS newbalanceDest,
               CAST(l_returnflag = 'R' AND l_quantity > 45 AS INTEGER) AS isFraud,
               CAST(l_extendedprice > 100000 AS INTEGER) AS isFlaggedFraud
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "tx_pca": f"""
        SELECT vec_id AS "Time", {_PCA_COLS},
               floor(abs(CAST(embedding[1] AS DOUBLE)) * 10000) / 100 AS Amount,
               CAST(label = 0 AS INTEGER) AS Class
        FROM embeddings""",
    "tx_orders": """
        SELECT o_orderkey AS TransactionID, o_orderdate AS sample_datetime,
               o_totalprice AS TransactionAmt,
               CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS isFraud,
               o_orderstatus AS status, o_orderpriority AS priority
        FROM orders""",
    "tx_nulls": """
        SELECT TransactionID, TransactionDT,
               CASE WHEN TransactionID % 97 = 0 THEN NULL ELSE TransactionAmt END AS TransactionAmt,
               CASE WHEN TransactionID % 101 = 0 THEN NULL ELSE isFraud END AS isFraud,
               card1, ProductCD
        FROM tx_card""",
    "tx_dups": """
        SELECT * FROM tx_card
        UNION ALL SELECT * FROM tx_card WHERE TransactionID % 50 = 0""",
    "fx_rates": f"""
        SELECT * FROM (VALUES {_FX_VALUES}) AS t(event_type, currency, rate)""",
}

VIEW_DEPS = {"tx_nulls": ["tx_card"], "tx_dups": ["tx_card"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` (and what they depend on)."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in VIEW_DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
