"""To-date totals for every as-of date at once.

``facts.period_to_date`` answers one as-of date with the flags of a dimension
rolled to it. Here each day of a range is an as-of date: a flag marks, for every
as-of date, a beginning of one segment (a week, month, quarter, year or financial
period) in the order of its days, so its total is a running sum within that
segment, read at one place. Daily totals become the rows of the segments they
lie in, each (group, as-of date) asks one place of each flag's segment, and one
running sum over both answers all.

A segment has at most a year of days, so a window's partition holds at most a
year's daily totals and the questions about them, whatever the fact's size; no
window is without a partition, and the fact is scanned once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions import fiscal as fis
from caldim.operators.facts import TO_DATE_FLAGS, daily_totals, date_range_filter
from caldim.sources.spine import broadcast_if_bounded, span_is_broadcastable

#: Days back of last week's and last year's comparisons. Fixed values.
WEEK_BACK, YEAR_BACK = 7, 364


def _day_number(d: Column) -> Column:
    return F.unix_date(d)


def _month_day(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def _week(d: Column) -> Column:
    return _day_number(cal.week_commencing(d))


def _period(shift: int = 0) -> Column:
    """Number of the financial period, ``shift`` years on; null without a financial calendar row."""
    return (fis.year_no(F.col("fin_year")) + shift) * 100 + fis.period_no(F.col("fin_period"))


def _quarter(d: Column, shift: int = 0) -> Column:
    return (F.year(d) + shift) * 10 + F.quarter(d)


def _places(day: Column) -> list[Column]:
    """The segments that a day lies in, and its place in their order. Last year's
    period, quarter and year go by month and day, as the flags do; a financial
    period can cross New Year, so it has both orders."""
    place = lambda kind, segment, order: F.struct(
        F.lit(kind).alias("kind"), segment.cast("int").alias("segment"), order.cast("int").alias("place")
    )
    return [
        place("week", _week(day), _day_number(day)),
        place("month", F.year(day) * 100 + F.month(day), _month_day(day)),
        place("period", _period(), _day_number(day)),
        place("period by month and day", _period(), _month_day(day)),
        place("quarter", _quarter(day), _month_day(day)),
        place("year", F.year(day), _month_day(day)),
    ]


def _questions(day: Column) -> list[Column]:
    """For each flag, the segment and place that its total for an as-of date is read at."""
    back = lambda n: F.date_sub(day, n)
    asked = {
        "wtd": ("week", _week(day), _day_number(day)),
        "mtd": ("month", F.year(day) * 100 + F.month(day), _month_day(day)),
        "ptd": ("period", _period(), _day_number(day)),
        "qtd": ("quarter", _quarter(day), _month_day(day)),
        "ytd": ("year", F.year(day), _month_day(day)),
        "lw_wtd": ("week", _week(back(WEEK_BACK)), _day_number(back(WEEK_BACK))),
        "ly_wtd": ("week", _week(back(YEAR_BACK)), _day_number(back(YEAR_BACK))),
        "ly_ptd": ("period by month and day", _period(-1), _month_day(day)),
        "ly_qtd": ("quarter", _quarter(day, -1), _month_day(day)),
        "ly_ytd": ("year", F.year(day) - 1, _month_day(day)),
    }
    assert asked.keys() == TO_DATE_FLAGS.keys()
    return [
        F.struct(F.lit(flag).alias("flag"), F.lit(kind).alias("kind"), seg.cast("int").alias("segment"), at.cast("int").alias("place"))
        for flag, (kind, seg, at) in asked.items()
    ]


def to_date_all_days(
    fact: DataFrame,
    date_col: str,
    measures: dict[str, Column],
    dim: DataFrame,
    by: list[str],
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """For each group and each as-of date from ``first`` to ``last`` (both
    included) the columns of ``period_to_date``: ``F_rows`` and ``F_M`` for each
    flag F and measure M. A (group, as-of date) is in the output if and only if
    a row of the group lies on a date that one of the flags marks.

    ``dim`` has calendar_date, fin_year and fin_period, one row a day, and covers
    two years before ``first``; dates outside it are marked by no flag. Measures
    must be additive. Rows without a date count nowhere."""
    lo = first.replace(year=first.year - 2, month=1, day=1)
    days = dim.where(F.col("calendar_date").between(F.lit(lo), F.lit(last))).select("calendar_date", "fin_year", "fin_period")
    bounded = span_is_broadcastable(lo, last)
    is_date = dict(fact.dtypes).get(date_col) == "date"
    daily = daily_totals(fact.where(date_range_filter(date_col, lo, last, is_date)), date_col, measures, by)
    daily = daily.withColumnRenamed("_d", "calendar_date")
    named = [F.col(c) for c in by]
    held = daily.join(broadcast_if_bounded(days, bounded), "calendar_date")
    rows = held.select(
        *named, F.explode(F.array(*_places(F.col("calendar_date")))).alias("at"), "rows", *measures,
        F.lit(None).cast("date").alias("as_of"), F.lit(None).cast("string").alias("flag"),
    )
    # a group is asked about from its first day until its last one is no longer marked
    spans = daily.groupBy(*by).agg(F.min("calendar_date").alias("a"), F.max("calendar_date").alias("e"))
    until = F.least(F.lit(last), F.make_date(F.year("e") + 1, F.lit(12), F.lit(31)))
    asks = spans.where(until >= F.greatest("a", F.lit(first))).select(
        *named, F.explode(F.sequence(F.greatest("a", F.lit(first)), until)).alias("calendar_date")
    )
    asks = asks.join(broadcast_if_bounded(days, bounded), "calendar_date")
    types = {m: daily.schema[m].dataType for m in measures}
    asks = asks.select(*named, "calendar_date", F.explode(F.array(*_questions(F.col("calendar_date")))).alias("q")).select(
        *named, F.struct("q.kind", "q.segment", "q.place").alias("at"), F.lit(0).cast("long").alias("rows"),
        *(F.lit(None).cast(t).alias(m) for m, t in types.items()), F.col("calendar_date").alias("as_of"), F.col("q.flag").alias("flag"),
    )
    both = rows.unionByName(asks).where("at.segment is not null").select("*", "at.kind", "at.segment", "at.place").drop("at")
    up_to = Window.partitionBy(*by, "kind", "segment").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = both.select(*named, "as_of", "flag", *(F.sum(c).over(up_to).alias(c) for c in ("rows", *measures)))
    answered = summed.where("flag is not null")
    out = answered.groupBy(*by, "as_of").agg(
        *(F.sum(F.when(F.col("flag") == f, F.col(c))).alias(f"{f}_{c}") for f in TO_DATE_FLAGS for c in ("rows", *measures))
    )
    out = out.select(
        *named, "as_of",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) if c.endswith("_rows") else F.col(c) for c in out.columns[len(by) + 1 :]),
    )
    marked = F.lit(False)
    for f in TO_DATE_FLAGS:
        marked = marked | (F.col(f"{f}_rows") > 0)
    return out.where(marked)
