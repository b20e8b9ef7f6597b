"""Spines: one row per day and one row per second of the day.

Both come from ``spark.range``, which numbers rows without a window (a
global ``row_number`` would pull every row into one task) and splits the
range over tasks, so the spine is generated in parallel and is gapless.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions.timeofday import SECONDS_PER_DAY

# A dimension row is a few hundred bytes; a side of at most this many rows is
# broadcast to every task without a shuffle of the other side.
BROADCAST_MAX_ROWS = 200_000
# Rows per spine partition: spark.range would otherwise split a few thousand
# days over defaultParallelism (every core of the cluster) mostly empty tasks.
SPINE_ROWS_PER_PARTITION = 25_000


def spine_partitions(n: int) -> int:
    return max(1, -(-n // SPINE_ROWS_PER_PARTITION))


class EmptySpan(ValueError):
    """END is not after START."""


def to_date(x: dt.date | str) -> dt.date:
    """A date, or 'YYYY-MM-DD' text parsed strictly (bad text raises)."""
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(x)


def day_count(start: dt.date | str, end: dt.date | str) -> int:
    """Number of days from START (included) to END (excluded)."""
    start, end = to_date(start), to_date(end)
    n = (end - start).days
    if n <= 0:
        raise EmptySpan(f"end {end} must be after start {start}")
    return n


def date_spine(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, num_partitions: int | None = None
) -> DataFrame:
    """calendar_date for every day from ``start`` to ``end`` (excluded)."""
    start, end = to_date(start), to_date(end)
    n = day_count(start, end)
    return spark.range(0, n, 1, num_partitions or spine_partitions(n)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("calendar_date")
    )


def second_spine(spark: SparkSession, num_partitions: int | None = None) -> DataFrame:
    """second_of_day 0..86399."""
    return spark.range(0, SECONDS_PER_DAY, 1, num_partitions or spine_partitions(SECONDS_PER_DAY)).select(F.col("id").cast("int").alias("second_of_day"))


def fact_date_span(frames: list[tuple[DataFrame, str]], whole_years: bool = True) -> tuple[dt.date, dt.date]:
    """(START, END) covering every date of the given (DataFrame, column)
    pairs, in one job: the columns are unioned (no shuffle) and reduced by a
    partial min/max per task, so one row per task crosses the network. Zone
    free columns of one type (all date or all timestamp_ntz) are reduced raw
    and turned into dates on the driver (to_date is monotonic); any other mix
    (zoned timestamps, text) is converted in Spark, in the session zone. With
    ``whole_years`` the span is widened to 1 January of the first year and
    1 January after the last."""
    types = {df.select(c).dtypes[0][1] for df, c in frames}
    same = len(types) == 1 and types <= {"date", "timestamp_ntz"}
    dates = None
    for df, c in frames:
        d = df.select((F.col(c) if same else cal.as_date(c)).alias("d"))
        dates = d if dates is None else dates.unionByName(d)
    r = dates.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        raise EmptySpan("no dates in the inputs")
    lo = lo.date() if isinstance(lo, dt.datetime) else lo
    hi = hi.date() if isinstance(hi, dt.datetime) else hi
    if whole_years:
        return dt.date(lo.year, 1, 1), dt.date(hi.year + 1, 1, 1)
    return lo, hi + dt.timedelta(days=1)


def broadcast_if_bounded(df: DataFrame, ok: bool) -> DataFrame:
    """Mark ``df`` for broadcast only when its caller proved a size bound;
    otherwise leave the strategy to Catalyst and AQE (sort-merge or shuffled
    hash join, re-planned at run time from real sizes)."""
    return F.broadcast(df) if ok else df


def span_is_broadcastable(start: dt.date, end: dt.date) -> bool:
    """A date dimension has one row per day of its span: a proven bound."""
    return (end - start).days <= BROADCAST_MAX_ROWS
