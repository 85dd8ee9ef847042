"""Hand-made edge frames (the S-rules of the survey), with hand-computed values."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.columns import column_batches, narrow_plan, transaction_type
from ledgerflow.functions.timecols import ensure_timestamp
from ledgerflow.operators import quality as Q
from ledgerflow.operators.aggregate import period_statistics, resample
from ledgerflow.operators.profile import numeric_profile
from ledgerflow.operators.quantiles import approx_quantiles, exact_quantiles
from ledgerflow.operators.windows import window_features, window_features_plain


def test_weekly_label_and_empty_bucket(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0), 1.0), (dt.datetime(2024, 1, 7, 23, 59, 59), 2.0),
            (dt.datetime(2024, 1, 8, 0, 0, 0), 4.0), (dt.datetime(2024, 1, 22, 0, 0, 0), 8.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, amount double")
    out = resample(df, "ts", "W", {"amount": ["sum", "mean"]}).orderBy("ts").collect()
    assert [r["ts"] for r in out] == [dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 14),
                                      dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 28)]
    assert [r["amount_sum"] for r in out] == [3.0, 4.0, 0.0, 8.0]
    assert out[2]["amount_mean"] is None


def _series(spark, values):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, sample_datetime timestamp_ntz, TransactionAmt double")


@pytest.mark.parametrize("impl", ["plain", "distributed"])
def test_rolling_cumsum_rank(spark, impl):
    df = _series(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0])
    f = window_features_plain if impl == "plain" else window_features
    out = f(df, ["sample_datetime", "id"]).orderBy("id").collect()
    assert [r["rolling_avg_3"] for r in out] == [None] * 5 + [5.0]
    assert [r["cumulative_sum"] for r in out] == [1.0, 3.0, None, 7.0, 12.0, 18.0]
    assert [r["rank"] for r in out] == [5, 4, None, 3, 2, 1]
    assert [r["prev_transaction_amt"] for r in out] == [None, 1.0, 2.0, None, 4.0, 5.0]
    assert [r["next_transaction_amt"] for r in out] == [2.0, None, 4.0, 5.0, 6.0, None]
    assert [r["row_number"] for r in out] == [1, 2, 3, 4, 5, 6]


def test_distributed_window_equals_plain_with_hot_bucket(spark):
    rng = np.random.default_rng(3)
    n = 3000
    # a third of the rows share one timestamp (a hot bucket), the rest spread
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        ts = base if i % 3 == 0 else base + dt.timedelta(minutes=int(rng.integers(0, 90 * 24 * 60)))
        amt = None if i % 97 == 0 else float(rng.integers(1, 500))
        rows.append((i, ts, amt))
    df = spark.createDataFrame(rows, "id long, sample_datetime timestamp_ntz, TransactionAmt double")
    cols = ["id", "month", "row_number", "rank", "next_transaction_amt", "prev_transaction_amt",
            "cumulative_sum", "rolling_avg_3", "rolling_max", "rolling_min"]
    a = window_features(df, ["sample_datetime", "id"], partitions=7).select(*cols).orderBy("id").collect()
    b = window_features_plain(df, ["sample_datetime", "id"]).select(*cols).orderBy("id").collect()
    for x, y in zip(a, b):
        for c in cols:
            u, v = x[c], y[c]
            if isinstance(u, float) and isinstance(v, float):
                assert math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9), (c, x, y)
            else:
                assert u == v, (c, x, y)


def test_quantile_skew_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = exact_quantiles(df, ["x"], [0.95]).first()["value"]
    assert abs(q - 8.95) < 1e-12
    p = numeric_profile(df, ["x"]).first()
    assert abs(p["skewness"] - 1.763633) < 1e-6
    std_pop = df.agg(F.stddev_pop("x")).first()[0]
    assert abs(std_pop - 3.535534) < 1e-6


def test_exact_quantiles_match_numpy_with_ties(spark):
    rng = np.random.default_rng(0)
    vals = np.concatenate([np.full(400, 5.0), rng.normal(0, 10, 800), rng.integers(0, 20, 300).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], probs, buckets=5).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)
    approx = {r["prob"]: r["value"] for r in approx_quantiles(df, ["x"], [0.5], 0.01).collect()}
    assert abs(approx[0.5] - np.quantile(vals, 0.5)) < 2.0


def test_duplicates_count_nulls_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "a int")
    assert Q.duplicate_count(df).first()["duplicates"] == 2
    assert Q.drop_duplicates(df).count() == 2


def test_label_shares(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,)], "y int")
    s = {r["value"]: r["share"] for r in Q.value_shares(df, "y").collect()}
    assert abs(s[0] - 2 / 3) < 1e-12 and abs(s[1] - 1 / 3) < 1e-12


def test_null_group_key_dropped(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, None, 7.0), (0, 1, 9.0)], "isFraud int, day int, amt double")
    out = period_statistics(df, {"amt": {"statistic": "sum", "period": ["day"]}}).collect()
    assert [(r["period_value"], r["value"]) for r in out] == [("1", 5.0)]


def test_narrow_types(spark):
    df = spark.createDataFrame([(100000.005, 0.1, 1, 200, 40000), (100000.005, 123456.789, 0, 0, 0)],
                               "a double, b double, i long, j long, k long")
    plan = narrow_plan(df)
    assert "a" not in plan and plan["b"] == "float"
    assert plan["i"] == "tinyint" and plan["j"] == "smallint" and plan["k"] == "int"


def test_empty_frame_null_counts(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert {r["column"]: r["missing"] for r in Q.null_counts(df).collect()} == {"a": 0, "b": 0}


def test_transaction_type_first_match(spark):
    df = spark.createDataFrame([("C1", "C2"), ("C1", "M2"), ("M1", "C2"), ("M1", "M2"), ("X", "Y"), ("CM", "M")],
                               "nameOrig string, nameDest string")
    assert [r[0] for r in df.select(transaction_type()).collect()] == ["CC", "CM", "MC", "MM", None, "CM"]


def test_column_batches():
    parts = column_batches([str(i) for i in range(14)], 12)
    assert [len(p) for p in parts] == [2, 2] + [1] * 10


def test_ensure_timestamp_raises(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("not a date",)], "sample_datetime string")
    with pytest.raises(ValueError):
        ensure_timestamp(df)
    ok = spark.createDataFrame([("2024-01-01 00:00:00",)], "sample_datetime string")
    assert ensure_timestamp(ok).schema["sample_datetime"].dataType.typeName() == "timestamp_ntz"


def test_rules_and_quarantine(spark):
    df = spark.createDataFrame([(1.0,), (300000.0,), (None,)], "amount double")
    rules = {"positive": F.col("amount") > 0, "max_200k": F.col("amount") <= 200000}
    f = {r["rule"]: r["failed"] for r in Q.rule_failures(df, rules).collect()}
    assert f == {"positive": 1, "max_200k": 2}
    ok, bad = Q.quarantine(df, rules)
    assert ok.count() == 1 and bad.count() == 2


def test_mobile_report_covers_every_column(spark):
    import __spark_entry__ as entry
    from ledgerflow.sources.fixtures import load

    sf = "/root/testdata/sf0.001"
    m = load(spark, sf, "tx_mobile")
    rep = entry.queries()["e25_quality_report_mobile_full"](spark, sf).collect()
    for section in ("missing_values", "unique_values", "data_types"):
        assert {r["column"] for r in rep if r["section"] == section} == set(m.columns)
    dup = [r["value"] for r in rep if r["section"] == "duplicates"]
    assert dup == [m.count() - m.distinct().count()]


def test_rank_correlations_and_associations_with_missing_values(spark):
    import numpy as np
    import pandas as pd

    from ledgerflow.operators.profile import associations, rank_correlations

    rng = np.random.default_rng(4)
    x = pd.DataFrame({"a": rng.integers(0, 9, 300), "b": rng.standard_normal(300)})
    x["c"] = np.where(np.arange(300) % 7 == 0, None, x["a"] ** 3 - x["b"]).astype(float)
    df = spark.createDataFrame([(int(a), float(b), None if c != c else float(c)) for a, b, c in x.values], "a int, b double, c double")
    want = {(p, q): x[[p, q]].dropna().rank().corr().loc[p, q] for p, q in (("a", "b"), ("a", "c"), ("b", "c"))}
    got = {(r.column_a, r.column_b): r.spearman for r in rank_correlations(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    cats = spark.createDataFrame([("u", "1", "k")] * 10 + [("v", "2", "k")] * 10 + [("v", None, "k")], "p string, q string, r string")
    assert {(r.column_a, r.column_b): r.cramers_v for r in associations(cats).collect()} == {("p", "q"): 1.0, ("p", "r"): None, ("q", "r"): None}


def test_profile_in_its_three_modes(spark):
    import json

    import __spark_entry__ as entry

    sf, rows = "/root/testdata/sf0.001", {}
    for mode in ("full", "sample", "stratified"):
        got = entry.queries()[f"p7_profile_{mode}"](spark, sf).collect()
        assert {r.section for r in got} >= {"overview", "numeric", "categorical", "correlations", "rank_correlations", "types"}
        overview = [json.loads(r.entry) for r in got if r.section == "overview"]
        rows[mode] = {r["metric"]: r["value"] for r in overview}["rows"]
    events = spark.read.parquet(f"{sf}/events.parquet")
    strata = events.groupBy("event_type").count().collect()
    assert rows["full"] == events.count()
    assert abs(rows["stratified"] - sum(0.2 * r["count"] for r in strata)) <= len(strata) and 0 < rows["sample"] < rows["full"]
