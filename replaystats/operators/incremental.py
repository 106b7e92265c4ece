"""Watermarked re-scan windows for late data."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.functions.scalars import in_window, ts_lit

# Fixed values of the snapshot job: how far back late matches are re-read, and how fresh is too fresh.
LOOKBACK = timedelta(hours=36)
DELAY = timedelta(minutes=5)
FIRST_RUN = datetime(1970, 1, 1)


class ScanWindow(NamedTuple):
    start: datetime | None
    end: datetime


def read_watermark(meta: DataFrame, key: str) -> datetime | None:
    """The stored watermark of one job: a single value, so it is read to the driver."""
    row = meta.filter(F.col("key") == key).agg(F.max("last_loaded_at").cast("string").alias("at")).first()
    # Read as text: a timestamp would be shifted to the time zone of this Python process.
    return datetime.fromisoformat(row["at"]) if row["at"] else None


def scan_window(
    meta: DataFrame,
    key: str,
    as_of: datetime,
    lookback: timedelta = LOOKBACK,
    delay: timedelta = DELAY,
    first_run: datetime | None = FIRST_RUN,
) -> ScanWindow:
    """[watermark - lookback, as_of - delay). With no watermark the scan starts at ``first_run``;
    ``first_run=None`` then scans nothing, though the watermark still moves on."""
    mark = read_watermark(meta, key)
    if mark is None:
        mark = first_run
    return ScanWindow(None if mark is None else mark - lookback, as_of - delay)


def rows_in(df: DataFrame, window: ScanWindow, time: str = "start_time") -> DataFrame:
    """Rows inside the window; the bounds are literals and reach the scan."""
    if window.start is None:
        return df.filter(F.lit(False))
    return df.filter(in_window(time, window.start, window.end, closed="left"))


def advance_watermark(meta: DataFrame, key: str, end: datetime) -> DataFrame:
    """The metadata table with the job's watermark set to the window end. Publish after the data."""
    mark = meta.sparkSession.range(1).select(F.lit(key).alias("key"), ts_lit(end).alias("last_loaded_at"))
    return meta.filter(~F.col("key").eqNullSafe(key)).unionByName(mark)
