"""Zero-filled concept time series (AG-23).

Ticks are half-open ``[start + k*delta, start + (k+1)*delta)``; the interval
is stretched to a whole number of ticks, so ``n_ticks = ceil((stop - start) /
delta)``. Mentions are summed per document, get their tick number by
arithmetic on the document's date (an equi-grouping, not a range join), and
are summed per concept and tick. The result is joined onto the dense grid of
requested concepts x ticks, whose size is (names requested) x (ticks
requested) — both bounded by the caller's arguments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.operators import common as C
from mentions.sources.summaries import known_interval

MISSING = ("error", "drop")


def _delta_days(delta) -> int:
    if isinstance(delta, dt.timedelta):
        if delta.seconds or delta.microseconds:
            raise ValueError("a delta of whole days is needed for DATE columns")
        days = delta.days
    else:
        days = int(delta)
    if days <= 0:
        raise ValueError("delta must be positive")
    return days


def _delta_micros(delta) -> int:
    micros = (delta // dt.timedelta(microseconds=1)) if isinstance(delta, dt.timedelta) else int(delta) * 86_400_000_000
    if micros <= 0:
        raise ValueError("delta must be positive")
    return micros


def _dates_from_dict(spark, dates: dict, date_col: str) -> DataFrame:
    """A caller-held ``{doc_id: date}`` mapping as a ``(doc_id, date)`` table."""
    timed = any(isinstance(v, dt.datetime) for v in dates.values())
    kind = "timestamp_ntz" if timed else "date"
    rows = [(int(k), v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat())
            for k, v in dates.items()]
    raw = spark.createDataFrame(rows, f"doc_id long, {date_col} string")
    return raw.select("doc_id", F.col(date_col).cast(kind).alias(date_col))


def concept_time_series(concepts: DataFrame, names, date_info: DataFrame | dict, delta, interval=None,
                        missing_dates: str = "error", date_col: str = "doc_date") -> DataFrame:
    """Counts of each requested concept per tick, zero-filled.

    ``date_info`` is ``(doc_id, <date_col>)`` of DATE (``delta`` = whole days,
    an int or a timedelta) or TIMESTAMP_NTZ (any positive timedelta), or a
    ``{doc_id: date}`` dict held by the caller.
    ``interval=None`` spans min(date) to max(date) + delta over all of
    ``date_info`` (computed by one small aggregate job; an empty
    ``date_info`` gives a single empty tick). A document has one date: of
    several rows the earliest date counts, and NULL dates count as missing.
    A mention whose document has no date raises :class:`MissingDates` (a
    ``ValueError``) before a plan is returned (``missing_dates='error'``: one
    small job that stops at the first such document) or is left out (``'drop'``).

    Columns ``ord, concept, start, stop, count`` ordered by request order,
    then time.
    """
    if missing_dates not in MISSING:
        raise ValueError(f"missing_dates must be one of {MISSING}")
    if isinstance(date_info, dict):
        date_info = _dates_from_dict(concepts.sparkSession, date_info, date_col)
    is_date = isinstance(date_info.schema[date_col].dataType, T.DateType)
    step = _delta_days(delta) if is_date else _delta_micros(delta)

    if interval is None:
        # The default interval is data-dependent: one small aggregate job
        # (min and max date) fixes it, and the bounds become literals.
        lo, hi = date_info.agg(F.min(date_col), F.max(date_col)).first()
        if lo is None:
            lo = hi = dt.date(1970, 1, 1)
        hi = hi + (dt.timedelta(days=step) if is_date else dt.timedelta(microseconds=step))
        interval = (lo, hi)
    # ISO text casts keep the bounds independent of any time zone.
    lo, hi = (v.isoformat(sep=" ") if isinstance(v, dt.datetime) else str(v) for v in interval)
    kind = "date" if is_date else "timestamp_ntz"
    start, stop = F.lit(lo).cast(kind), F.lit(hi).cast(kind)

    def offset(c: Column) -> Column:  # days or microseconds since start
        return F.datediff(c, start) if is_date else F.timestamp_diff("MICROSECOND", start, c)

    def at(k: Column) -> Column:
        return (F.date_add(start, (k * F.lit(step)).cast("int")) if is_date
                else F.timestamp_add("MICROSECOND", k * F.lit(step), start))

    n_ticks = F.greatest(F.ceil(offset(stop).cast("double") / F.lit(float(step))), F.lit(0)).cast("int")

    requests = C.request_table(concepts.sparkSession, names, "concept")
    wanted = C.keep_names(concepts, "concept", names if isinstance(names, DataFrame) else C.as_name_list(names))
    dates = date_info.groupBy("doc_id").agg(F.min(date_col).alias("_date")).filter(F.col("_date").isNotNull())
    if missing_dates == "error":
        require_dates(wanted, dates)
    # Only dates inside the interval are joined (the test reaches the scan of
    # date_info), and mentions are summed per document first.
    n_steps = F.ceil(offset(stop).cast("double") / F.lit(float(step)))
    inside = dates.filter((F.col("_date") >= start) & (F.col("_date") < at(n_steps)))
    per_doc = wanted.groupBy("doc_id", "concept").agg(C.sum_or_zero("freq").alias("freq"))
    tick = F.floor(offset(F.col("_date")) / F.lit(step)).cast("long")
    counts = (per_doc.join(inside, "doc_id").groupBy("concept", tick.alias("tick"))
              .agg(C.sum_or_zero("freq").alias("count")))
    ticks = F.when(n_ticks > 0, F.sequence(F.lit(0), n_ticks - 1)).otherwise(F.array().cast("array<int>"))
    grid = (requests.select("ord", "concept", F.explode(ticks).alias("tick"))
            .withColumn("tick", F.col("tick").cast("long")))
    return (grid.join(counts, ["concept", "tick"], "left")
            .select("ord", "concept", at(F.col("tick")).alias("start"), at(F.col("tick") + 1).alias("stop"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
            .orderBy("ord", "start"))


def series_from_totals(summaries, names, delta, interval=None, missing_dates: str = "error") -> DataFrame:
    """:func:`concept_time_series` from the running totals of :class:`~mentions.sources.summaries.Summaries`.

    A tick's count is the difference of two look-ups, the running total at its
    end and at its beginning, so any ``delta`` of whole days is served by the
    same totals and ``concepts`` isn't read. Per batch, concept and tick the last
    total is kept (days before the interval are the tick before the first);
    windows hold the ticks of one concept in one batch. The default interval
    spans the dates that were known when the batches were summarised. Batches
    summarised without dates are refused.
    """
    if missing_dates not in MISSING:
        raise ValueError(f"missing_dates must be one of {MISSING}")
    step = _delta_days(delta)
    batches = summaries.batches()
    undated = sorted(n for n, b in batches.items() if not b["dated"])
    if undated:
        raise ValueError(f"batches {undated} were summarised without dates")
    days = summaries.table("days", batches)
    wanted = C.keep_names(days, "concept", names if isinstance(names, DataFrame) else C.as_name_list(names))
    if missing_dates == "error":
        lost = wanted.filter(F.col("day").isNull() & (F.col("undated") > 0)).select("concept").take(1)
        if lost:
            raise MissingDates(f"no date for a document that names {lost[0].concept!r}")
    if interval is None:
        lo, hi = known_interval(batches) or (dt.date(1970, 1, 1), dt.date(1970, 1, 1))
        interval = (lo, hi + dt.timedelta(days=step))
    lo, hi = interval
    ticks = max(0, -(-(hi - lo).days // step))
    start = F.lit(lo)
    tick = F.greatest(F.floor(F.datediff("day", start) / F.lit(step)), F.lit(-1)).cast("long")
    inside = wanted.filter(F.col("day") < F.lit(lo + dt.timedelta(days=ticks * step)))  # NULL days go, too
    ends = inside.groupBy("batch", "concept", tick.alias("tick")).agg(F.max_by("total", "day").alias("total"))
    before = F.lag("total", 1, 0).over(Window.partitionBy("batch", "concept").orderBy("tick"))
    counts = (ends.withColumn("count", F.col("total") - before).filter(F.col("tick") >= 0)
              .groupBy("concept", "tick").agg(F.sum("count").alias("count")))
    steps = F.sequence(F.lit(0), F.lit(ticks - 1)) if ticks else F.array().cast("array<int>")
    grid = (C.request_table(summaries.spark, names, "concept").select("ord", "concept", F.explode(steps).alias("tick"))
            .withColumn("tick", F.col("tick").cast("long")))

    def at(k: Column) -> Column:
        return F.date_add(start, (k * F.lit(step)).cast("int"))

    return (grid.join(counts, ["concept", "tick"], "left")
            .select("ord", "concept", at(F.col("tick")).alias("start"), at(F.col("tick") + 1).alias("stop"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
            .orderBy("ord", "start"))


class MissingDates(ValueError):
    """A requested concept is mentioned in a document without a date."""


def require_dates(mentions: DataFrame, dates: DataFrame) -> None:
    """Raise unless every mention's document is in ``dates`` (``take(1)`` on an anti join)."""
    undated = mentions.select("doc_id").join(dates.select("doc_id"), "doc_id", "left_anti").take(1)
    if undated:
        raise MissingDates(f"no date for document {undated[0].doc_id}")
