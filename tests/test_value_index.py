"""The value-frequency index: quantiles by ranges, digests, distinct values."""

import math

import numpy as np
import pytest

from ledgerflow.operators import quality as Q
from ledgerflow.operators import value_index as V

INF = math.inf


def _values():
    rng = np.random.default_rng(3)
    return {
        "dense": [float(1_700_000_000 + x) for x in rng.integers(0, 90_000, 900)],  # all in one range of the first pass
        "wide": [float(x) for x in rng.choice([-1, 1], 900) * 10.0 ** rng.integers(-300, 300, 900)],
        "hot": [7.25] * 700 + [float(x) for x in rng.normal(7.25, 1e-12, 200)],
        "odd": [INF, -INF, 0.0, -0.0, 5e-324] + [None] * 300 + [math.nan] * 295 + [1e308, -1e308] * 150,
        "none": [None] * 900,
    }


def test_quantiles_from_sums_over_ranges(spark):
    data = _values()
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data))
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in V.build(df).quantiles(list(data), probs).collect()}
    assert {c for c, _ in got} == set(data) - {"none"}
    for c in ("dense", "wide", "hot"):
        for q in probs:
            at = q * (len(data[c]) - 1)
            x = sorted(data[c])
            lo, hi = x[math.floor(at)], x[math.ceil(at)]
            assert got[c, q] == (lo if lo == hi or at == math.floor(at) else lo + (hi - lo) * (at - math.floor(at))), (c, q)
    assert (got["odd", 0.0], got["odd", 0.5], got["odd", 1.0]) == (-INF, 0.0, INF)


@pytest.mark.parametrize("twice", [False, True])
def test_only_digests_that_repeat_are_written(spark, twice):
    rows = [(i, f"x{i}" if i % 3 else None) for i in range(200)] + [(5, "x5"), (5, "x5"), (9, None)] * twice
    df = spark.createDataFrame(rows, "a int, b string")
    index = V.build(df)
    assert index.table.filter("c = -1").count() == 2 * twice
    assert index.duplicates().collect()[0]["duplicates"] == 3 * twice
    assert index.rows().collect()[0]["n"] == len(rows)


def test_distinct_counts_without_a_row_as_wide_as_the_table(spark):
    big = 2**53
    rows = [(1, 1.5, "a", big, True), (1, math.nan, "", big + 1, None), (None, math.nan, None, big + 2, False), (2, 0.0, "a", None, True), (2, -0.0, "b", big, True)]
    df = spark.createDataFrame(rows, "i int, d double, s string, l long, b boolean")
    got = Q.distinct_counts(df)
    assert {r["column"]: r["distinct"] for r in got.collect()} == {"i": 2, "d": 3, "s": 3, "l": 3, "b": 2}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r["distinct"] for r in Q.distinct_counts(df.limit(0)).collect()} == {0}


def test_a_numeric_profile_counts_no_whole_rows(spark, monkeypatch):
    from ledgerflow.operators import profile as P

    seen, df = [], spark.createDataFrame([(i % 50, float(i % 50)) for i in range(200)], "a int, b double")
    monkeypatch.setattr(P, "build", lambda *a, **k: seen.append(V.build(*a, **k)) or seen[-1])
    got = {r["column"]: r for r in P.numeric_profile(df, ["a", "b"]).collect()}
    assert (got["a"]["n"], got["b"]["distinct"], got["b"]["p50"]) == (200, 50, 24.5)
    assert seen[0].table.filter("c = -1").count() == 0  # every row occurs four times
    with pytest.raises(ValueError):
        seen[0].duplicates()


def test_digests_are_as_narrow_as_numbers_and_equal_ones_are_compared(spark):
    rows = [(1, None, "x"), (None, 1, "x"), (1, None, "x"), (None, None, None), (None, None, None), (2, 3, "y")]  # the first two share a digest
    df = spark.createDataFrame(rows, "a int, b int, c string")
    assert df.select(V.row_digest(df)).dtypes[0][1] == "bigint"
    index = V.build(df)
    assert {int(r["s"]) for r in index.table.filter("c = -1").collect()} <= {r[0] for r in df.select(V.row_digest(df)).collect()}
    assert index.duplicates().first()["duplicates"] == 2
    assert index.table.filter("c = -1 AND v IS NOT NULL").count() == 0
