"""Sources, sinks, streaming and plan shape."""

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from ledgerflow.operators import quality as Q
from ledgerflow.operators.aggregate import resample
from ledgerflow.sources.files import read_csv, read_zip_csv, write_table
from ledgerflow.streaming.realtime import hourly_stream, read_parquet_stream, run_upserts

SF = "/root/testdata/sf0.001"


def test_zip_members_by_name(spark):
    d = tempfile.mkdtemp(prefix="lf-zip-")
    p = os.path.join(d, "x.zip")
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("train_transaction.csv", "TransactionID,TransactionAmt\n1,2.5\n2,3.0\n")
        z.writestr("train_identity.csv", "TransactionID,id_01\n1,7\n")
    tx = read_zip_csv(spark, p, "TransactionID long, TransactionAmt double", member="train_transaction.csv")
    assert sorted(tuple(r) for r in tx.collect()) == [(1, 2.5), (2, 3.0)]


def test_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="lf-csv-")
    src = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "value", "event_type")
    write_table(src, f"{d}/ev", fmt="csv")
    back = read_csv(spark, f"{d}/ev", "event_id long, value double, event_type string")
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def _hours(df):
    return {r["sample_datetime"]: (round(r["value_sum"], 6), r["event_type_nunique"]) for r in df.collect()}


def _files(spark, folder, parts):
    """One file per part, in the order a stream reads them."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{folder}/p{i}")
        name = next(n for n in os.listdir(f"{folder}/p{i}") if n.endswith(".parquet"))
        os.makedirs(f"{folder}/in", exist_ok=True)
        os.replace(f"{folder}/p{i}/{name}", f"{folder}/in/{i}.parquet")
        os.utime(f"{folder}/in/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{folder}/in"


def _batch_hours(spark, df):
    return _hours(resample(df, "ts", "H", {"value": ["mean", "sum"], "event_type": "nunique"},
                           out_col="sample_datetime", fill_gaps=False))


def test_stream_in_time_order_equals_batch(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    cuts = ["2024-01-10 00:30:00", "2024-01-20 12:45:00"]
    parts = [ev.where(F.col("ts") < cuts[0]), ev.where((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])), ev.where(F.col("ts") >= cuts[1])]
    path = _files(spark, tempfile.mkdtemp(prefix="lf-stream-"), parts)
    src = read_parquet_stream(spark, path, ev.schema)
    assert _hours(run_upserts(hourly_stream(src, "ts", "value", "event_type"), ["sample_datetime"])) == _batch_hours(spark, ev)


def test_stream_counts_late_rows_within_the_delay(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    parts = [ev.where(F.pmod(F.col("event_id"), F.lit(3)) == i) for i in range(3)]
    path = _files(spark, tempfile.mkdtemp(prefix="lf-late-"), parts)
    src = read_parquet_stream(spark, path, ev.schema)
    assert _hours(run_upserts(hourly_stream(src, "ts", "value", "event_type", delay="40 days"), ["sample_datetime"])) == _batch_hours(spark, ev)
    short = _hours(run_upserts(hourly_stream(read_parquet_stream(spark, path, ev.schema), "ts", "value", "event_type"), ["sample_datetime"]))
    assert set(short) <= set(_batch_hours(spark, ev))  # one row per hour; rows beyond the delay are refused


def test_quality_report_plan_has_no_python_udf(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_quantity", "l_discount", "l_returnflag")
    rep = Q.quality_report(df)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    q = resample(df, "l_shipdate", "D", {"l_quantity": "sum"})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_quantity" in plan


def test_time_buckets_read_the_table_once(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = resample(df, "l_shipdate", "D", {"l_quantity": "sum"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_time_buckets_of_text(spark):
    good = spark.createDataFrame([("2024-01-01 00:10:00", 1.0), ("2024-01-01 03:00:00", 2.0), (None, 5.0)], "t string, v double")
    got = [(r["t"].hour, r["v_sum"]) for r in resample(good, "t", "H", {"v": "sum"}).orderBy("t").collect()]
    assert got == [(0, 1.0), (1, 0.0), (2, 0.0), (3, 2.0)]
    import pytest

    with pytest.raises(ValueError, match="1 value"):
        resample(spark.createDataFrame([("no date", 1.0)], "t string, v double"), "t", "H", {"v": "sum"})
    with pytest.raises(ValueError, match="missing"):
        resample(good, "absent", "H", {"v": "sum"})


def test_no_row_count_probe_above_raw_rows(spark):
    from ledgerflow.operators.quantiles import approx_quantiles, exact_quantiles

    df = spark.range(0, 10_001).select(((F.col("id") * 7919) % 10_001).cast("double").alias("x"))
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.25: 2500.0, 0.5: 5000.0, 1.0: 10_000.0}
    plan = exact_quantiles(df, ["x"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan
    for r in approx_quantiles(df, ["x"], [0.1, 0.5, 0.9], rel_err=0.05).collect():
        assert abs(r["value"] / 10_000 - r["prob"]) <= 0.05 + 1e-3
