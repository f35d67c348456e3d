"""Tumbling-window concept counts on a stream (ST-02).

The streaming counterpart of the time-series tick rule: windows of
``delta`` aligned to a chosen ``start`` (``startTime`` = start modulo
delta), one sum of ``freq`` per concept and window. With the append
output mode a window is emitted, and its state released, once the
watermark has passed its end; rows older than the watermark may then be
dropped (Spark keeps every row within the watermark) - a behaviour the
batch operator does not have. The complete mode keeps every window. Zero
filling stays a batch step (:mod:`mentions.operators.series`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)


def start_offset(start: dt.datetime | dt.date, delta: dt.timedelta) -> dt.timedelta:
    """``startTime`` that aligns tumbling windows of ``delta`` to ``start``."""
    if not isinstance(start, dt.datetime):
        start = dt.datetime(start.year, start.month, start.day)
    return (start - EPOCH) % delta


def _duration(td: dt.timedelta) -> str:
    return f"{int(td.total_seconds() * 1_000_000)} microseconds"


def windowed_concept_counts(mentions: DataFrame, delta: dt.timedelta, start: dt.datetime | dt.date,
                            time_col: str = "ts", concepts=None, *, watermark: str | None) -> DataFrame:
    """Sum of ``freq`` per concept and tumbling window.

    ``mentions`` (batch or streaming) has ``concept, freq`` and a
    TIMESTAMP/TIMESTAMP_NTZ ``time_col``. Rows without a concept are left out.
    ``watermark`` says how late a row may come (``"1 hour"``); the caller
    chooses, as later rows are lost in append mode. None keeps every row, and
    all state. Columns ``concept, start, stop, count``.
    """
    if delta <= dt.timedelta(0):
        raise ValueError("delta must be positive")
    mentions = mentions.filter(F.col("concept").isNotNull())
    if concepts is not None:
        mentions = mentions.filter(F.col("concept").isin(list(concepts)))
    ntz = isinstance(mentions.schema[time_col].dataType, T.TimestampNTZType)
    if ntz:
        # Event-time watermarks need TIMESTAMP; read the wall-clock value as
        # UTC (independent of the session time zone) and convert back below.
        mentions = mentions.withColumn(time_col, F.timestamp_micros(
            F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time_col))))
    if watermark is not None and mentions.isStreaming:
        mentions = mentions.withWatermark(time_col, watermark)
    w = F.window(F.col(time_col), _duration(delta), _duration(delta), _duration(start_offset(start, delta)))

    def back(c):
        if not ntz:
            return c
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    return (mentions.groupBy(w.alias("w"), "concept")
            .agg(F.coalesce(F.sum("freq"), F.lit(0)).cast("long").alias("count"))
            .select("concept", back(F.col("w.start")).alias("start"), back(F.col("w.end")).alias("stop"), "count"))
