"""Real-time flagging with Structured Streaming.

The reference only recommends real-time detection.  Here the batch hourly
aggregate (E4a) and the z-score rule (M2) run on a stream:

* ``hourly_stream``: event-time hourly windows with a watermark: state for an
  hour is kept until the watermark (the latest event time less ``delay``) passes
  its end, so rows that are late by at most ``delay`` count, later ones do not.
  ``delay`` is the price in state and the bound on lateness; choose it for the
  source.  Distinct types are counted exactly: an hour's state holds the set of its types.
* ``flag_stream``: a stream-static join against a baseline table of per-type
  mean/std, flagging ``|z| > 3``; the baseline is written once, so a micro-batch reads
  one row per type and not the history.
* ``running_flags``: the same rule against a baseline that the stream itself keeps.  Keyed state
  holds count, sums and last time of every type across micro-batches; an event is compared with all earlier ones of
  its type, then joins them.  Events before the type's last time are late: they are marked and
  scored by nobody (``run_running_flags`` writes them aside).  A type not seen for ``expiry`` loses its state.

Sinks are Parquet folders in the shared checkpoint folder.  Updated windows are
written per micro-batch under the batch's number (a repeated batch overwrites
its own folder), and the newest row of a window is its result.

Watermarks need a TIMESTAMP column; NTZ timestamps are cast first.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from ledgerflow.session import ensure_checkpoint_dir, stored


def hourly_stream(events: DataFrame, ts: str, amount: str, type_col: str, delay: str = "1 hour") -> DataFrame:
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    g = e.groupBy(F.window("_ts", "1 hour").alias("w")).agg(
        F.avg(amount).alias(f"{amount}_mean"), F.sum(amount).alias(f"{amount}_sum"),
        F.size(F.collect_set(type_col)).cast("long").alias(f"{type_col}_nunique"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("sample_datetime"), f"{amount}_mean",
                    f"{amount}_sum", f"{type_col}_nunique")


def baseline(history: DataFrame, type_col: str, amount: str) -> DataFrame:
    """Per-type mean and population std from a batch history (one row per type), written once."""
    spread = F.when(F.min(amount) < F.max(amount), F.stddev_pop(amount))  # equal values have none
    return stored(history.groupBy(type_col).agg(F.avg(amount).alias("_mean"), spread.alias("_std")), "baseline")


def flag_stream(events: DataFrame, base: DataFrame, type_col: str, amount: str, threshold: float = 3.0) -> DataFrame:
    z = (F.col(amount) - F.col("_mean")) / F.nullif("_std", F.lit(0.0))  # no deviation, no score
    j = events.join(base, type_col, "left")
    return j.withColumn("anomaly_score", F.coalesce(F.abs(z) > threshold, F.lit(False)).cast("int")).drop("_mean", "_std")


FLAGGED = "event_type string, event_id long, ts timestamp, value double, seen long, z double, anomaly_score int, late boolean"
STATE = "n long, origin double, s1 double, s2 double, last timestamp"


def running_flags(events: DataFrame, ts: str, id_col: str, type_col: str, amount: str, threshold: float = 3.0,
                  min_seen: int = 30, delay: str = "1 day", expiry: str = "30 days") -> DataFrame:
    """``(event_type, event_id, ts, value, seen, z, anomaly_score, late)`` of a stream of events: ``seen`` counts the
    earlier events of the type, ``z`` is the distance from their mean in population standard deviations
    (null below two of them, or without deviation), flagged above ``threshold`` once ``min_seen`` were seen.

    Events of one type and micro-batch are ordered by (time, id) in one group, whose size the trigger bounds
    (``maxFilesPerTrigger``); nothing of earlier batches is kept but the state row.  Null amounts are passed on
    without a score and do not count."""
    wait = pd.Timedelta(expiry)

    def update(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        n, origin, s1, s2, last = state.get if state.exists else (0, 0.0, 0.0, 0.0, None)
        pdf = pd.concat(list(frames)).sort_values(["ts", "event_id"], kind="stable")
        late = (pdf["ts"] < last) if last is not None else pd.Series(False, index=pdf.index)
        x = pdf["value"].to_numpy(dtype=float)
        counted = ~late.to_numpy() & ~np.isnan(x)
        if not n and counted.any():
            origin = float(x[counted][0])  # sums about a value of the type lose no digits to a large mean
        d = np.where(counted, x - origin, 0.0)
        seen = n + np.cumsum(counted) - counted
        before1, before2 = s1 + np.cumsum(d) - d, s2 + np.cumsum(d * d) - d * d
        safe = np.maximum(seen, 1)
        mean = before1 / safe
        spread = np.sqrt(np.maximum(before2 / safe - mean * mean, 0.0))
        scored = counted & (seen > 1) & (spread > 1e-9 * np.maximum(1.0, np.abs(mean)))
        z = np.where(scored, (d - mean) / np.where(scored, spread, 1.0), np.nan)
        flags = (scored & (seen >= min_seen) & (np.abs(np.nan_to_num(z)) > threshold)).astype("int32")
        on_time = pdf.loc[~late, "ts"]
        if len(on_time):
            last = on_time.max() if last is None else max(last, on_time.max())
        if last is not None:
            state.update((int(n + counted.sum()), origin, float(s1 + d.sum()), float(s2 + (d * d).sum()), last.to_pydatetime()))
            # The watermark may have passed the type's last event by more than the expiry already.
            state.setTimeoutTimestamp(max(int((last + wait).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"event_type": key[0], "event_id": pdf["event_id"].to_numpy(), "ts": pdf["ts"].to_numpy(), "value": x,
                            "seen": seen, "z": [None if np.isnan(v) else v for v in z], "anomaly_score": flags, "late": late.to_numpy()})

    e = events.select(F.col(type_col).alias("event_type"), F.col(id_col).cast("long").alias("event_id"),
                      F.col(ts).cast("timestamp").alias("ts"), F.col(amount).cast("double").alias("value")).withWatermark("ts", delay)
    return e.groupBy("event_type").applyInPandasWithState(update, FLAGGED, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def time_slices(events: DataFrame, ts: str, slices: int, folder: str | None = None) -> str:
    """Write a table as ``slices`` consecutive pieces of its time span, one after the other: a folder
    that a stream reads in time order."""
    spark = events.sparkSession
    folder = folder or _folder(spark, "time-slices")
    span = events.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    if span["lo"] is None:
        events.write.parquet(folder)
        return folder
    at = [span["lo"] + (span["hi"] - span["lo"]) * i / slices for i in range(slices)]
    for i, lo in enumerate(at):
        part = events.filter((F.col(ts) >= F.lit(lo)) if i == slices - 1 else (F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(at[i + 1])))
        part.write.mode("append").parquet(folder)
    return folder


def run_running_flags(stream: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Drive a stream of :func:`running_flags` over everything available: its scored and its late events,
    written to separate folders under the number of their micro-batch."""
    spark = stream.sparkSession
    folder = folder or _folder(spark, "running-flags")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, part in (("scored", batch.filter(~F.col("late"))), ("late", batch.filter("late"))):
            part.write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        batch.unpersist()

    q = (stream.writeStream.foreachBatch(write).outputMode("append")
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    return tuple(spark.read.schema(stream.schema).parquet(f"{folder}/{name}/batch=*") for name in ("scored", "late"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_upserts(stream: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """Drive an aggregating stream over everything available and return its newest
    row per key."""
    spark = stream.sparkSession
    folder = folder or _folder(spark, "stream-upserts")
    schema = StructType([*stream.schema.fields, StructField("_batch", LongType())])

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    q = (stream.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.schema(schema).parquet(f"{folder}/out/batch=*")
    rest = [c for c in stream.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r"))
    return newest.select(*keys, "_r.*").select(*stream.columns)


def run_appends(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Drive a stateless stream over everything available into a Parquet folder and return it."""
    spark = stream.sparkSession
    folder = folder or _folder(spark, "stream-appends")
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
