"""Ordinary columns that break naive statistics: constant, zero, empty, tiny, NaN and infinite; pandas' rules are the expected values."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import comoments, value_index
from ledgerflow.operators import profile as P
from ledgerflow.operators import quality as Q
from ledgerflow.operators.anomaly import isolation_forest, kmeans_distance, zscore_flags
from ledgerflow.operators.features import standardize
from ledgerflow.operators.quantiles import quantiles
from ledgerflow.operators.series import acf, pacf, qq_points, residual_diagnostics

NAN, INF = float("nan"), float("inf")
COLUMNS = {
    "zeros": [0.0, 0.0, 0.0, 0.0, 0.0, 0.0], "tenth": [0.1] * 6, "centred": [-2.0, -1.0, 0.0, 0.0, 1.0, 2.0],
    "gaps": [1.0, None, 4.0, None, 2.0, 9.0], "nothing": [None] * 6, "one": [None, None, 3.0, None, None, None],
}


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(zip(range(6), *COLUMNS.values()))
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLUMNS))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def close(a, b):
    return a is None and (b is None or math.isnan(b)) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_numeric_profile_of_ordinary_columns(frame):
    got = by(P.numeric_profile(frame, list(COLUMNS)), "column")
    pdf = pd.DataFrame({c: pd.Series(v, dtype=float) for c, v in COLUMNS.items()})
    for c in ("zeros", "tenth", "centred", "gaps", "one"):
        x, r = pdf[c].dropna(), got[c]
        assert (r.n, r.distinct, r.zeros, r.negatives) == (len(x), x.nunique(), (x == 0).sum(), (x < 0).sum())
        assert close(r["mean"], x.mean()) and close(r.std, x.std()) and close(r.p25, x.quantile(0.25)) and close(r.p95, x.quantile(0.95))
        if x.nunique() > 1:
            assert close(r.skewness, x.skew())
        else:
            assert r.skewness is None and r.kurtosis is None
    assert got["zeros"].cv is None and got["centred"].cv is None and got["tenth"].cv == 0.0 and got["one"].std is None
    assert "nothing" not in got


@pytest.mark.parametrize("rows", [[], [(1.0,)], [(1.0,), (5.0,)], [(None,), (None,)], [(NAN,), (2.0,)], [(INF,), (1.0,), (2.0,), (-INF,), (3.0,)]])
def test_small_and_infinite_columns_do_not_fail(spark, rows):
    df = spark.createDataFrame(rows, "x double")
    finite = [r[0] for r in rows if r[0] is not None and not math.isnan(r[0])]
    prof = P.numeric_profile(df).collect()
    assert len(prof) == bool(any(r[0] is not None for r in rows))
    assert P.correlations(df.withColumn("y", F.col("x") * 2)).count() == 1
    assert P.rank_correlations(df.withColumn("y", F.col("x") * 2)).count() == 1
    for got in (quantiles(df, ["x"], [0.5]).collect(), value_index.build(df).quantiles(["x"], [0.5]).collect()):
        assert [r.value for r in got] == ([float(np.quantile(finite, 0.5))] if finite else [])
    assert Q.describe(df).count() >= 5 and Q.iqr_outliers(df).count() <= 1 and Q.quality_report(df).count() >= 4
    assert {r.anomaly_score for r in zscore_flags(df, ["x"]).collect()} <= {0}
    assert standardize(df, ["x"]).count() == len(rows)
    assert zscore_flags(df, ["x"], null_policy="omit").count() == len(rows)


def test_zscores_of_constant_and_nan_columns(spark):
    rows = [(float(i % 5), 0.1, NAN if i == 3 else float(i), None if i == 4 else float(i), 1000.0 if i == 99 else float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, constant double, has_nan double, has_null double, spiked double").withColumn("i", F.monotonically_increasing_id())
    assert zscore_flags(df, ["a", "constant", "has_nan", "has_null"]).agg(F.sum("anomaly_score")).first()[0] == 0
    flagged = zscore_flags(df, ["a", "constant", "has_nan", "has_null", "spiked"]).where("anomaly_score = 1").collect()
    assert [r.spiked for r in flagged] == [1000.0]


def test_correlations_of_ordinary_columns(frame):
    pdf = pd.DataFrame({c: pd.Series(v, dtype=float) for c, v in COLUMNS.items()})
    for fn, name, method in ((P.correlations, "pearson", "pearson"), (P.rank_correlations, "spearman", "spearman")):
        for r in fn(frame, list(COLUMNS)).collect():
            both = pdf[[r.column_a, r.column_b]].dropna()
            if method == "spearman":  # over the rows that have both
                both = both.rank()
            want = None if both.nunique().min() < 2 else both.iloc[:, 0].corr(both.iloc[:, 1])
            assert close(r[name], want), (r, want)


def test_comoments_merge_over_partitions_and_survive_a_large_mean(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 4))
    x[:, 1] += 0.5 * x[:, 0]
    big = x + 1e9
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) for r in big]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(7)
    pdf = pd.DataFrame(rows, columns=list("abcd")).astype(float) - 1e9
    for r in comoments.pair_correlations(df, list("abcd")).collect():
        assert abs(r.pearson - pdf[r.column_a].corr(pdf[r.column_b])) < 1e-6
    a, b = comoments.block_moments(x[:1000]), comoments.block_moments(x[1000:])
    assert np.allclose(comoments.merge_moments(a, b), comoments.block_moments(x))


def test_constant_and_short_series(spark):
    rows = [("flat", d, 0.1) for d in range(30)] + [("two", 0, 1.0), ("two", 1, 2.0)] + [("saw", d, float(d % 2)) for d in range(40)]
    s = spark.createDataFrame(rows, "series string, d int, value double").select("series", F.date_add(F.lit("2024-01-01"), F.col("d")).alias("day"), "value")
    got = {(r.series, r.lag): r.acf for r in acf(s, 5).collect()}
    assert all(got["flat", k] is None for k in range(6)) and got["saw", 0] == 1.0 and got["two", 1] == -0.5
    part = {(r.series, r.lag): r.pacf for r in pacf(s, 5).collect()}
    assert part["flat", 0] is None and part["saw", 0] == 1.0 and part["two", 0] == 1.0 and ("two", 1) not in part
    diag = by(residual_diagnostics(s.withColumnRenamed("value", "resid")), "series")
    assert diag["flat"].skew is None and diag["flat"].ljung_box_1 is None and diag["flat"].n == 30 and diag["saw"].kurtosis == pytest.approx(1.0)
    assert qq_points(s, "value").where("theoretical is null").count() == 0


def test_pacf_is_the_yule_walker_solution(spark):
    rng = np.random.default_rng(8)
    v = [0.0, 0.0]
    for _ in range(200):
        v.append(0.6 * v[-1] - 0.3 * v[-2] + rng.standard_normal())
    s = spark.createDataFrame([("a", d, x) for d, x in enumerate(v)], "series string, d int, value double").select(
        "series", F.date_add(F.lit("2024-01-01"), F.col("d")).alias("day"), "value")
    r = [x.acf for x in acf(s, 12).orderBy("lag").collect()]
    got = [x.pacf for x in pacf(s, 12).orderBy("lag").collect()]
    for k in range(1, 13):
        m = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(got[k] - np.linalg.solve(m, r[1:k + 1])[-1]) < 1e-9


def test_inverse_normal_everywhere(spark):
    from statistics import NormalDist

    from ledgerflow.functions.normal import inverse_normal

    ps = [1e-300, 1e-20, 1e-9, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.9251, 0.999999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0, None]], "p double")
    got = {r.p: r.x for r in df.select("p", inverse_normal("p").alias("x")).collect()}
    assert all(abs(got[p] - NormalDist().inv_cdf(p)) < 1e-9 for p in ps) and got[0.0] is None and got[1.0] is None and got[None] is None


def test_detectors_of_empty_tables(spark):
    df = spark.createDataFrame([], "id long, a double, b double")
    assert kmeans_distance(df, ["a", "b"]).count() == 0 and isolation_forest(df, ["a", "b"], "id").count() == 0
    assert P.overview(df).count() == 4 and Q.quality_report(df).where("section = 'duplicates' and value = 0").count() == 1


def test_value_index_against_pandas(spark):
    rng = np.random.default_rng(1)
    n = 4000
    pdf = pd.DataFrame({"hot": np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 300, n)), "big": rng.integers(0, 50, n) + 2**60,
                        "text": rng.choice(["a", "b", None], n), "cents": np.round(rng.random(n) * 100, 2)})
    rows = [tuple(None if v is None else v.item() if hasattr(v, "item") else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows + rows[:40], "hot double, big long, text string, cents double").repartition(9)
    pdf = pd.concat([pdf, pdf[:40]])
    ix = value_index.build(df)
    assert {r.column: r.distinct for r in ix.distinct_counts().collect()} == {c: pdf[c].nunique() for c in pdf}
    assert {r.column: r.missing for r in ix.null_counts().collect()} == {c: int(pdf[c].isna().sum()) for c in pdf}
    assert ix.duplicates().first()[0] == int(pdf.duplicated().sum()) and ix.rows().first()[0] == n + 40
    probs = [0.0, 0.05, 0.33, 0.5, 0.9, 1.0]
    for r in ix.quantiles(["hot", "cents"], probs).collect():
        assert r.value == pytest.approx(pdf[r.column].quantile(r.prob))
    top = [(r.value, r["count"]) for r in ix.top_values(["text"], 2).orderBy("rank").collect()]
    assert top == sorted(pdf.text.value_counts().items(), key=lambda x: (-x[1], x[0]))
    q1, q3 = pdf.cents.quantile([0.25, 0.75])
    out = by(ix.iqr_outliers(["cents", "hot"]), "column")
    assert out["cents"].outliers == int(((pdf.cents < q1 - 1.5 * (q3 - q1)) | (pdf.cents > q3 + 1.5 * (q3 - q1))).sum())


def test_report_reads_the_table_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2000).selectExpr("id % 7 as a", "cast(id % 3 as string) as b", "id * 0.5 as c").write.parquet(path)
    report = Q.quality_report(spark.read.parquet(path))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{path}]") <= 1  # the index itself has read it once before


def test_density_curves_within_the_kernels_reach(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.standard_normal(400), [60.0], np.repeat(1.25, 50)])
    df = spark.createDataFrame([(float(v), 1) for v in x] + [(2.0, 0)] * 3, "x double, label int")
    got = P.kde(df, ["x"], "label", grid=50).orderBy("point").collect()
    assert len(got) == 50 and {r.label for r in got} == {1}  # a constant group has no bandwidth
    h = x.std(ddof=1) * len(x) ** -0.2
    want = [np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for r in got]
    assert np.allclose([r.density for r in got], want, atol=1e-9) and min(want) < 1e-11
