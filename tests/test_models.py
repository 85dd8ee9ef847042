"""Series, models and detectors: property checks against direct numpy."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.operators.anomaly import isolation_forest, kmeans_distance
from ledgerflow.operators.sampling import sample_sizes, stratified_sample
from ledgerflow.operators.series import acf, decompose, pacf


def _series_df(spark, name, values, start=dt.date(2024, 1, 1)):
    rows = [(name, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, day date, value double")


def test_decompose_sums_to_observed(spark):
    rng = np.random.default_rng(1)
    v = 10 + np.sin(np.arange(60) * 2 * np.pi / 7) + rng.normal(0, 0.1, 60)
    out = decompose(_series_df(spark, "a", v), 7).collect()
    for r in out:
        if r["trend"] is not None:
            assert abs(r["trend"] + r["seasonal"] + r["resid"] - r["value"]) < 1e-9


def test_acf_pacf_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = np.cumsum(rng.normal(size=200)) * 0.1 + rng.normal(size=200)
    df = _series_df(spark, "a", x)
    got = {r["lag"]: r["acf"] for r in acf(df, 10).collect()}
    d = x - x.mean()
    for k in range(11):
        assert abs(got[k] - np.dot(d[: len(x) - k], d[k:]) / np.dot(d, d)) < 1e-9
    r = np.array([got[k] for k in range(11)])
    phi = np.linalg.solve(np.array([[r[abs(i - j)] for j in range(3)] for i in range(3)]), r[1:4])
    pac = {row["lag"]: row["pacf"] for row in pacf(df, 10).collect()}
    assert abs(pac[3] - phi[2]) < 1e-9
    assert abs(pac[1] - r[1]) < 1e-12 and abs(pac[0] - 1) < 1e-9


def test_stratified_sizes_exact(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = {r["y"]: r["n_sampled"] for r in sample_sizes(stratified_sample(df, 0.2, "y", "id", buckets=16), "y").collect()}
    assert s == {0: 900, 1: 100}


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(4)
    pts = rng.normal(0, 1, (3000, 3))
    pts[:10] += 12
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "id long, a double, b double, c double")
    out = isolation_forest(df, ["a", "b", "c"], "id", n_trees=50, contamination=0.01)
    top = [r["id"] for r in out.orderBy(F.col("iso_score").desc()).limit(10).collect()]
    assert set(top) == set(range(10))
    # 3000 rows: ranks 2970..2999 lie above the interpolated 0.99 quantile
    assert out.filter("anomaly_score = 1").count() == 30


def test_kmeans_fixed_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 0.0), (0.0, 1.0), (10.0, 2.0), (0.0, 50.0)], "a double, b double")
    out = kmeans_distance(df, ["a", "b"], centres=[[0.0, 0.0], [10.0, 0.0]]).orderBy("b", "a").collect()
    assert [r["cluster"] for r in out] == [0, 1, 0, 1, 0]
    assert out[-1]["anomaly_score"] == 1 and sum(r["anomaly_score"] for r in out) == 1


def test_tree_draws_hold_at_any_size(spark):
    from ledgerflow.operators.anomaly import tree_draws

    for n in (0, 1, 100, 38_400, 10**9, 10**13):
        rounds, per_round, p = tree_draws(n, 100, 256)
        assert p > 0 and rounds * per_round >= 100 and per_round * p <= 1.0 + 1e-12
        if n >= 10**9:
            assert rounds == 1 and abs(p * n - 384) < 1e-3


def test_isolation_forest_flags_the_share_and_keeps_rows(spark):
    rows = spark.range(0, 4000).select("id", F.col("id").cast("string").alias("name"), F.rand(3).alias("a"),
                                       F.when(F.col("id") % 100 == 0, F.lit(50.0)).otherwise(F.rand(4)).alias("b"))
    out = isolation_forest(rows, ["a", "b"], "id", n_trees=30, contamination=0.035)
    assert out.columns == ["id", "name", "a", "b", "iso_score", "anomaly_score"]
    got = out.groupBy("anomaly_score").count().collect()
    assert abs({r["anomaly_score"]: r["count"] for r in got}[1] - 140) <= 1
    assert out.where("b > 10 and anomaly_score = 0").count() == 0
    assert isolation_forest(rows.limit(0), ["a", "b"], "id", n_trees=3).count() == 0


def test_aligned_difference_of_unequal_days(spark):
    from ledgerflow.operators.joins import aligned_difference

    a = _series_df(spark, "s", [1.0, 2.0, 3.0])
    b = _series_df(spark, "s", [1.0, 1.0, 1.0], start=dt.date(2024, 1, 2)).withColumnRenamed("value", "v")
    got = {r["day"].day: r["difference"] for r in aligned_difference(a, b, ["series", "day"], "value", "v").collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: None}


def test_window_features_keep_other_columns(spark):
    from ledgerflow.operators.windows import window_features, window_features_plain

    rows = [(i, dt.datetime(2024, 1 + i % 3, 1 + i % 20, i % 24), None if i % 9 == 0 else float(i % 7), f"n{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, sample_datetime timestamp_ntz, TransactionAmt double, name string")
    got = window_features(df, ["sample_datetime", "id"], partitions=4)
    want = window_features_plain(df, ["sample_datetime", "id"])
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda r: r["id"]
    for a, b in zip(sorted(got.select(cols).collect(), key=key), sorted(want.select(cols).collect(), key=key)):
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(a, b) if not (x is None and y is None))


def test_label_copy_ranks_first(spark):
    from ledgerflow.operators.features import feature_importance

    df = spark.range(0, 600).select((F.col("id") % 3 == 0).cast("int").alias("y"), F.rand(1).alias("noise"), F.rand(2).alias("more"))
    top = feature_importance(df.withColumn("copy", F.col("y").cast("double")), "y", ["noise", "copy", "more"]).orderBy(F.desc("importance")).first()
    assert top[0] == "copy"


def test_isolation_forest_reads_the_selected_features(spark, monkeypatch):
    from ledgerflow.plans import catalog, model_queries

    sf, seen = "/root/testdata/sf0.001", []
    monkeypatch.setattr(model_queries, "isolation_forest", lambda df, cols, *a, **k: seen.append(cols) or isolation_forest(df, cols, *a, **k))
    out = catalog.QUERIES["m3_isolation_forest"](spark, sf)
    top = [c for c in catalog.QUERIES["l2_top_features"](spark, sf).columns if c not in ("sample_datetime", "isFraud")]
    assert sorted(seen[0]) == sorted(f"{c}_z" for c in top) and len(top) == 17  # fewer than the 20 asked for
    assert out.count() == 1000 and 20 <= out.where("anomaly_score = 1").count() <= 50


def test_importances_read_a_stored_model_input(spark, monkeypatch):
    from ledgerflow.plans import catalog, model_queries

    seen = []
    monkeypatch.setattr(model_queries, "feature_importance", lambda df, label, cols: seen.append((df, cols)) or df)
    catalog.QUERIES["l1_feature_importance"](spark, "/root/testdata/sf0.001")
    df, cols = seen[0]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan  # the passes of the model do not make the window features again
    assert len(cols) == 17 and df.count() == 1000
