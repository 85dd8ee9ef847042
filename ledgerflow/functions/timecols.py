"""Date and time column functions (all JVM-side expressions)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def anchor_literal(anchor: dt.datetime | None) -> Column:
    """Start instant for elapsed-time columns.

    The reference adds offsets to the wall clock read per row, so its output
    changes with every run.  A fixed ``anchor`` makes the result reproducible;
    with ``None`` the query start time is used once for all rows.
    """
    if anchor is None:
        return F.current_timestamp().cast("timestamp_ntz")
    # From text, so the literal does not depend on the session time zone.
    return F.lit(anchor.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def elapsed_to_timestamp(elapsed, unit: str, anchor: dt.datetime | None = None) -> Column:
    """``anchor + elapsed <unit>`` as TIMESTAMP_NTZ (unit HOUR, SECOND, ...)."""
    return F.timestamp_add(unit.upper(), _col(elapsed), anchor_literal(anchor))


def add_sample_datetime(df: DataFrame, elapsed_col: str, unit: str,
                        anchor: dt.datetime | None = None,
                        out: str = "sample_datetime") -> DataFrame:
    """Elapsed hours/seconds column -> ``sample_datetime``."""
    return df.withColumn(out, elapsed_to_timestamp(elapsed_col, unit, anchor))


def add_time_parts(df: DataFrame, ts: str = "sample_datetime",
                   parts=("month", "day", "hour", "week", "day_of_week")) -> DataFrame:
    """Calendar columns of a timestamp.

    ``week`` is the ISO week number; ``day_of_week`` counts Monday as 0.
    """
    c = F.col(ts)
    exprs = {
        "month": F.month(c),
        "day": F.to_date(c),
        "hour": F.hour(c),
        "week": F.weekofyear(c),
        "day_of_week": F.weekday(c),
    }
    return df.withColumns({p: exprs[p] for p in parts})


def require_columns(df: DataFrame, *cols: str) -> None:
    """Raise ``ValueError`` when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {missing}")


def ensure_timestamp(df: DataFrame, col: str = "sample_datetime") -> DataFrame:
    """Coerce ``col`` to a timestamp and fail if any value does not parse.

    Already-typed timestamp columns pass through without a job.  A string
    column is parsed with ``try_to_timestamp`` and one aggregate counts the
    failures (nulls that were not null before parsing).
    """
    require_columns(df, col)
    dtype = df.schema[col].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return df
    src = F.col(col).cast("string") if not isinstance(dtype, StringType) else F.col(col)
    parsed = F.try_to_timestamp(src).cast("timestamp_ntz")
    out = df.withColumn(col, parsed)
    bad = df.select(F.count_if(F.col(col).isNotNull() & parsed.isNull()).alias("n")).first()["n"]
    if bad:
        raise ValueError(f"{bad} value(s) of {col!r} are no timestamps")
    return out


def future_days(last_day: Column, n: int = 30) -> Column:
    """Array of the ``n`` dates after ``last_day`` (C10), to be exploded."""
    d = F.to_date(last_day)
    return F.sequence(F.date_add(d, 1), F.date_add(d, n))
