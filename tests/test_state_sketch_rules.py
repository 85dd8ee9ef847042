"""Keyed stream state, stored sketches, corrupt records, rules over several rows, ordered ranges."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import quality as Q
from ledgerflow.operators import sampling, sketches
from ledgerflow.sources.files import read_csv_quarantine
from ledgerflow.streaming.realtime import baseline, flag_stream, read_parquet_stream, run_running_flags, running_flags, time_slices

EVENT = "event_id long, ts timestamp, kind string, value double"
T0 = dt.datetime(2024, 1, 1)


def brute(events, threshold, min_seen):
    out, seen = {}, {}
    for i, _, kind, v in sorted(events, key=lambda e: (e[1], e[0])):
        past = seen.setdefault(kind, [])
        m, s = (np.mean(past), np.std(past)) if past else (0, 0)
        out[i] = (len(past), int(v is not None and len(past) >= min_seen and s > 1e-9 and abs(v - m) / s > threshold))
        if v is not None:
            past.append(v)
    return out


def stream(spark, batches):
    folder = tempfile.mkdtemp(prefix="lf-state-")
    for b in batches:
        spark.createDataFrame(b, EVENT).coalesce(1).write.mode("append").parquet(folder)
    return read_parquet_stream(spark, folder, spark.createDataFrame([], EVENT).schema)


def test_running_state_over_batches_equals_the_events_in_order(spark):
    rng = np.random.default_rng(2)
    events = [(i, T0 + dt.timedelta(minutes=i), "ab"[i % 2], None if i % 31 == 0 else float(rng.standard_normal() + 1e6 + 9 * (i % 40 == 39))) for i in range(240)]
    events += [(500 + i, T0 + dt.timedelta(minutes=i), "flat", 0.1) for i in range(60)]
    by_time = sorted(events, key=lambda e: e[1])
    scored, late = run_running_flags(running_flags(stream(spark, [by_time[:90], by_time[90:200], by_time[200:]]), "ts", "event_id", "kind", "value", min_seen=10))
    got = {r.event_id: (r.seen, r.anomaly_score) for r in scored.collect()}
    assert got == brute(events, 3.0, 10) and late.count() == 0 and sum(f for _, f in got.values()) > 0


def test_late_events_are_written_aside(spark):
    on_time = [(i, T0 + dt.timedelta(hours=i), "a", float(i % 5)) for i in range(20)]
    old = [(100, T0 + dt.timedelta(hours=3), "a", 1e9), (101, T0 + dt.timedelta(hours=30), "a", 2.0)]
    scored, late = run_running_flags(running_flags(stream(spark, [on_time, old]), "ts", "event_id", "kind", "value", min_seen=5, delay="2 days"))
    assert [(r.event_id, r.anomaly_score) for r in late.collect()] == [(100, 0)]
    assert {r.event_id: r.seen for r in scored.collect()} == {i: i for i in range(20)} | {101: 20}


def test_time_slices_are_consecutive(spark):
    rows = [(i, T0 + dt.timedelta(hours=i), "a", 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, EVENT)
    assert spark.read.parquet(time_slices(df, "ts", 4)).count() == 50
    assert spark.read.schema(df.schema).parquet(time_slices(df.limit(0), "ts", 4)).count() == 0


def test_a_type_without_deviation_is_not_flagged(spark):
    df = spark.createDataFrame([(i, T0, "same", 0.1) for i in range(5)] + [(9, T0, "two", 1.0), (10, T0, "two", 3.0)], EVENT)
    got = flag_stream(df, baseline(df, "kind", "value"), "kind", "value", 0.5).collect()
    assert {r.event_id: r.anomaly_score for r in got} == {i: 0 for i in range(5)} | {9: 1, 10: 1}


@pytest.fixture(scope="module")
def measured(spark):
    rng = np.random.default_rng(3)
    rows = [(T0 + dt.timedelta(hours=i % 480), float(v), f"u{u}", None) for i, (v, u) in enumerate(zip(rng.exponential(100, 20_000), rng.integers(0, 3000, 20_000)))]
    rows += [(None, 1.0, "x", None), (T0, float("nan"), None, None)]
    return spark.createDataFrame(rows, "ts timestamp, v double, u string, w double"), rows


def test_merged_sketches_keep_their_bounds(spark, measured):
    df, rows = measured
    folder = tempfile.mkdtemp(prefix="lf-sketch-") + "/t"
    daily = sketches.daily_sketches(df, "ts", ["v", "u", "w"])
    sketches.store_sketches(daily.filter("day < '2024-01-11'"), folder)
    sketches.store_sketches(daily.filter("day >= '2024-01-11'"), folder)  # later days are added
    stored = sketches.stored_sketches(spark, folder)
    lo, hi = dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 18)
    some = [r for r in rows if r[0] and lo <= r[0] < hi]
    values, users = np.sort([r[1] for r in some if not np.isnan(r[1])]), {r[2] for r in some if r[2]}
    probs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    for r in sketches.range_quantiles(stored, "2024-01-04", "2024-01-17", probs).collect():
        assert r.n == len(values)
        assert np.searchsorted(values, r.value, "left") / r.n - sketches.RANK_ERROR <= r.prob <= np.searchsorted(values, r.value, "right") / r.n + sketches.RANK_ERROR
    got = {r.column: r.distinct for r in sketches.range_distinct(stored, "2024-01-04", "2024-01-17").collect()}
    assert abs(got["u"] - len(users)) <= sketches.DISTINCT_ERROR * len(users) and "w" not in got
    assert sketches.range_distinct(stored, "2030-01-01", "2030-02-01").count() == 0


def test_corrupt_lines_are_kept(spark):
    folder = tempfile.mkdtemp(prefix="lf-corrupt-")
    with open(f"{folder}/a.csv", "w") as f:
        f.write("id,v\n1,2.5\nx,3\n3,\n4,nope\n5,1,extra\n")
    good, bad = read_csv_quarantine(spark, f"{folder}/a.csv", "id long, v double")
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2.5), (3, None)]
    assert sorted(r._corrupt_record for r in bad.collect()) == ["4,nope", "5,1,extra", "x,3"]


def test_rules_over_several_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (9, "f")], "k long, v string")
    other = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    assert {r.v for r in Q.not_unique(df, ["k"]).collect()} == {"a", "b"}
    assert {r.v for r in Q.without_reference(df, ["k"], other, ["id"]).collect()} == {"f"}
    none = df.limit(0)
    assert Q.not_unique(none, ["k"]).count() == 0 and Q.without_reference(df, ["k"], other.limit(0), ["id"]).count() == 4


def test_range_partitions_are_in_order(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("x"))
    ordered = sampling.range_report(sampling.range_partition(df, "x", 5), "x").first()
    assert (ordered.partitions, ordered.rows, ordered.unsorted, ordered.overlapping) == (5, 3000, 0, 0)
    mixed = sampling.range_report(df.repartition(3), "x").first()
    assert mixed.unsorted > 0 and mixed.overlapping > 0


def test_samples_take_a_null_stratum_too(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2).alias("s"))
    got = {r.s: r.n for r in sampling.stratified_sample(df, 0.2, "s", "id").groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {None: 50, 0: 50, 1: 100}
