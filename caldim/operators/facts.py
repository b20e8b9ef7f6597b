"""Fact-scale jobs: the dimension rules applied to large tables.

Design rules at fact scale:
* facts are reduced first (daily totals, integer time buckets) so joins and
  text labels run on at most one row per day or bucket, not per fact row;
* attributes on every fact row come from a broadcast join to a dimension of
  proven size (cheaper per row than formatting text), or from numeric
  column expressions;
* a date dimension or financial calendar is joined by broadcast only behind
  a proven size bound (one row per day of its span, dates checked unique);
* aggregates run partial per task before the shuffle, so a hot date, hour or
  key never sends more than one partial row per task downstream;
* date windows reach the parquet scan as ranges on the raw timestamp column.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions import timeofday as tod
from caldim.sources.logs import LogTables, utc_now
from caldim.sources.spine import broadcast_if_bounded, span_is_broadcastable

# Output prefix of each to-date flag of the date dimension.
TO_DATE_FLAGS = {
    "wtd": "current_cal_wtd",
    "mtd": "current_cal_mtd",
    "ptd": "current_cal_ptd",
    "qtd": "current_cal_qtd",
    "ytd": "current_cal_ytd",
    "lw_wtd": "previous_wk_cal_wtd",
    "ly_wtd": "previous_yr_cal_wtd",
    "ly_ptd": "previous_yr_cal_ptd",
    "ly_qtd": "previous_yr_cal_qtd",
    "ly_ytd": "previous_yr_cal_ytd",
}


def ts_bound(d: dt.date) -> Column:
    """Midnight of ``d`` as a timestamp_ntz literal (folds to a constant, so
    a comparison with a raw column is pushed to the parquet reader)."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def date_range_filter(col: str, lo: dt.date, hi: dt.date, is_date: bool = False) -> Column:
    """lo <= col < hi + 1 day on the raw column, for file and row-group pruning."""
    c = F.col(col)
    if is_date:
        return (c >= F.lit(lo)) & (c <= F.lit(hi))
    return (c >= ts_bound(lo)) & (c < ts_bound(hi + dt.timedelta(days=1)))


def flagged_span(dim: DataFrame, flags: list[str]) -> tuple[dt.date, dt.date] | None:
    """First and last date any of ``flags`` marks (one-row aggregate over the
    dimension); None when no date is marked."""
    r = dim.where(any_flag(flags)).agg(F.min("calendar_date"), F.max("calendar_date")).first()
    return None if r[0] is None else (r[0], r[1])


def any_flag(flags: list[str]) -> Column:
    """Whether a dimension row carries at least one of the to-date flags."""
    hit = F.lit(False)
    for f in flags:
        hit = hit | F.coalesce(F.col(f) == "YES", F.lit(False))
    return hit


def dim_span(dim: DataFrame) -> tuple[dt.date, dt.date, int]:
    """(first date, day after the last date, row count) of a dimension."""
    r = dim.agg(F.min("calendar_date"), F.max("calendar_date"), F.count(F.lit(1))).first()
    return r[0], r[1] + dt.timedelta(days=1), r[2]


def with_calendar_attributes(
    fact: DataFrame, date_col: str, cal_dim: DataFrame, bounded: bool, prefix: str = ""
) -> DataFrame:
    """Add date_key and the calendar columns of ``date_col`` by a left join
    to a calendar dimension (one row per day, e.g. ``calendar_dim``), which
    is broadcast when ``bounded`` (its span is known). Dates outside the
    dimension get NULLs, as in any star join; ``with_date_attributes``
    computes the same columns by expressions, without that condition."""
    dim = cal_dim.select(
        F.col("calendar_date").alias("_d"), *[F.col(c).alias(prefix + c) for c in cal_dim.columns if c != "calendar_date"]
    )
    joined = fact.withColumn("_d", cal.as_date(date_col)).join(broadcast_if_bounded(dim, bounded), "_d", "left")
    return joined.select(*fact.columns, *dim.columns[1:])


def daily_totals(fact: DataFrame, date_col: str, measures: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """One row per (date, by...) with the row count ``rows`` and the sum of
    each measure: the first, partial-then-final aggregate of every rollup.

    Per fact row this costs a date cast and a hash-aggregate update; joins
    and text labels then run on at most (days x groups) rows instead of on
    every fact row. Measures must be additive (they are summed again)."""
    return fact.groupBy(cal.as_date(date_col).alias("_d"), *(by or [])).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(n) for n, m in measures.items()]
    )


def period_to_date(
    fact: DataFrame,
    date_col: str,
    measures: dict[str, Column],
    dim: DataFrame,
    by: list[str] | None = None,
    flags: dict[str, str] | None = None,
) -> DataFrame:
    """Week, month, period, quarter and year to date, with last-week and
    last-year comparisons, in one pass over the fact (X3).

    ``dim`` is a date dimension rolled to the wanted as-of date. For each
    flag F and measure M the output has ``F_M`` = sum of M over the rows of
    the flagged dates, and ``F_rows`` = their count. A group is in the output
    if and only if one of its rows falls on a date that some flag marks: the
    join keeps the dimension's flagged dates alone. The range from the first
    to the last of them only prunes the scan. The fact probes the broadcast
    flag columns on an int date key and is aggregated partial-then-final on
    ``by``. (Reducing to daily totals first was measured no faster here:
    the probe is cheap and the flag sums need no text.)
    """
    flags = flags or TO_DATE_FLAGS
    by = by or []
    span = flagged_span(dim, list(flags.values()))
    lo, hi = span if span else (dt.date(1, 1, 1), dt.date(1, 1, 1))
    # the dimension has one row per date (the merge keys on it), so the
    # flagged range bounds the broadcast side
    start, end = lo, hi + dt.timedelta(days=1)
    flagged = dim.where(any_flag(list(flags.values())) & F.col("calendar_date").between(F.lit(lo), F.lit(hi)))
    flag_cols = flagged.select(
        F.col("calendar_date").alias("_d"), *[(F.col(c) == "YES").alias("_f_" + k) for k, c in flags.items()]
    )
    is_date = dict(fact.dtypes).get(date_col) == "date"
    f = fact.where(date_range_filter(date_col, lo, hi, is_date)).withColumn("_d", cal.as_date(date_col))
    j = f.join(broadcast_if_bounded(flag_cols, span_is_broadcastable(start, end)), "_d")
    aggs = []
    for k in flags:
        flag = F.col("_f_" + k)
        aggs.append(F.count_if(flag).alias(f"{k}_rows"))
        for name, m in measures.items():
            aggs.append(F.sum(F.when(flag, m)).alias(f"{k}_{name}"))
    return j.groupBy(*by).agg(*aggs) if by else j.agg(*aggs)


def by_fiscal_period(
    fact: DataFrame,
    date_col: str,
    fin_cal: DataFrame,
    measures: dict[str, Column],
    fin_unique_checked: bool,
    fin_span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Totals per financial year and period (X2 + aggregate).

    The financial calendar has one row per day once its dates are checked
    unique, so its row count is bounded by its own date span (read from the
    calendar, not from the fact; pass ``fin_span`` = (first date, day after
    the last) when it is known): within the bound it is broadcast. The fact
    is first reduced to daily totals, so the join sees one row per day."""
    if fin_span is not None:
        lo, hi = fin_span[0], fin_span[1] - dt.timedelta(days=1)
    else:
        lo, hi = _date_minmax(fin_cal, "calendar_date")
    fin = fin_cal.select(
        F.col("calendar_date").alias("_d"),
        F.col("financial_year").alias("fin_year"),
        F.col("financial_period").alias("fin_period"),
    )
    ok = fin_unique_checked and span_is_broadcastable(lo, hi + dt.timedelta(days=1))
    daily = daily_totals(fact, date_col, measures)
    j = daily.join(broadcast_if_bounded(fin, ok), "_d", "left")
    return j.groupBy("fin_year", "fin_period").agg(
        F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in measures]
    )


def _date_minmax(df: DataFrame, date_col: str) -> tuple[dt.date, dt.date]:
    r = df.agg(F.min(cal.as_date(date_col)), F.max(cal.as_date(date_col))).first()
    return r[0], r[1]


def calendar_rollup(fact: DataFrame, date_col: str, measures: dict[str, Column], levels: list[str]) -> DataFrame:
    """Totals per calendar attributes (X1 + aggregate), e.g. levels
    ['cal_year', 'cal_quarter', 'month']: daily totals first, then the text
    labels are computed once per day rather than once per fact row."""
    cols = cal.calendar_columns(F.col("_d"))
    daily = daily_totals(fact, date_col, measures)
    return daily.groupBy(*[cols[l].alias(l) for l in levels]).agg(
        F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in measures]
    )


def _with_zero_rows(agg: DataFrame, spine: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """Add a zero row for every spine key missing from ``agg``: the spine's
    zero rows are unioned in and the few resulting rows re-aggregated, so the
    fact is scanned once and no join is needed. Rows whose key is NULL (no
    time) stay as their own row."""
    types = {k: agg.schema[k].dataType for k in measures}
    zeros = spine.select(
        key, F.lit(0).cast("long").alias("rows"), *[F.lit(0).cast(t).alias(k) for k, t in types.items()]
    )
    return (
        agg.unionByName(zeros)
        .groupBy(key)
        .agg(F.sum("rows").alias("rows"), *[F.sum(k).cast(t).alias(k) for k, t in types.items()])
    )


def interval_profile(
    spark: SparkSession, fact: DataFrame, ts_col: str, width_minutes: int, measures: dict[str, Column]
) -> DataFrame:
    """Row count and measures per time-of-day interval, with a zero row for
    every interval without data (X5), plus a NULL-interval row when some
    rows have no time.

    The fact is aggregated on the integer bucket number (partial-then-final,
    at most 1440/width groups); the text label is formatted afterwards on
    those few rows only, never per fact row."""
    n = 24 * 60 // width_minutes
    bucket = (tod.second_of_day(F.col(ts_col)) / (width_minutes * 60)).cast("int")
    agg = fact.groupBy(bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(k) for k, m in measures.items()]
    )
    spine = spark.range(0, n, 1, 1).select(F.col("id").cast("int").alias("_b"))
    out = _with_zero_rows(agg, spine, "_b", list(measures))
    label = tod.interval_label((F.col("_b") * (width_minutes * 60)).cast("int"), width_minutes)
    return out.select(label.alias("interval"), "rows", *measures)


def daypart_profile(spark: SparkSession, fact: DataFrame, ts_col: str, measures: dict[str, Column]) -> DataFrame:
    """Row count and measures per daypart, every daypart present (zero rows
    included), plus a NULL-daypart row when some rows have no time."""
    part = tod.daypart(tod.second_of_day(F.col(ts_col)))
    agg = fact.groupBy(part.alias("daypart")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(k) for k, m in measures.items()]
    )
    names = [p[0] for p in tod.DAYPARTS] + [tod.OTHER_DAYPART]
    # a range and a literal array: no Python tasks for six rows
    label = F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("id") + 1).cast("int"))
    spine = spark.range(0, len(names), 1, 1).select(label.alias("daypart"))
    return _with_zero_rows(agg, spine, "daypart", list(measures)).select("daypart", "rows", *measures)


class Load(NamedTuple):
    """Rows loaded, the new mark, and rows of the source without a time."""

    rows: int
    mark: dt.datetime
    rows_without_time: int


def incremental_load(
    spark: SparkSession,
    logs: LogTables,
    source: DataFrame,
    ts_col: str,
    target_path: str,
    table_name: str,
    schema_name: str | None = None,
    country: str | None = None,
    upper: dt.datetime | None = None,
    load_ts: dt.datetime | None = None,
) -> Load:
    """Append the rows with mark <= ``ts_col`` < ``upper`` to ``target_path``
    and log ``upper`` as the new mark with the row count (X6).

    Half-open loads never split rows of equal time: all rows of an instant
    fall in one load. ``upper`` must be an instant that no more rows will
    precede; the default is midnight of the load's day (UTC), so a column of
    dates is loaded one whole closed day after another and what arrives later
    on the day itself waits for the next load. A load whose ``upper`` does not
    pass the mark loads nothing and keeps it.

    Rows that arrive below the mark are not loaded: ``late_rows`` counts them, and
    ``maintenance`` keeps a rollup that takes them.

    Rows without a time belong to no interval: all of the source's are kept,
    newest state only, in ``<target_path>_without_time``, and counted in the
    result and, if there are any, in the audit table.

    Each load writes its own folder ``load_from=<previous mark>`` with
    overwrite, so a load retried after a failure between the write and the
    log entry replaces its earlier output instead of duplicating it. Counts
    are observed during the writes, not by extra jobs."""
    from pyspark.sql import Observation

    mark = logs.last_process_date(table_name, schema_name, country)
    load_ts = load_ts or utc_now()
    upper = upper or dt.datetime.combine(load_ts.date(), dt.time())
    if mark is not None and upper < mark:
        upper = mark
    time = F.col(ts_col)

    def instant(x: dt.datetime) -> Column:
        return F.lit(x.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    inc = source.where(time < instant(upper))
    if mark is not None:
        inc = inc.where(time >= instant(mark))
    tag = mark.strftime("%Y%m%dT%H%M%S%f") if mark is not None else "start"

    def written(df: DataFrame, path: str) -> int:
        obs = Observation()
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return obs.get["rows"]

    rows = written(inc, f"{target_path}/load_from={tag}") if upper != mark else 0
    without = written(source.where(time.isNull()), f"{target_path}_without_time")
    if without:
        logs.log_audit("INCREMENTAL_LOAD", table_name, f"rows without {ts_col}: {without}", schema_name, table_name, load_ts)
    logs.log_process_date(table_name, schema_name, upper, rows, country, ts=load_ts)
    return Load(rows, upper, without)


def late_rows(
    logs: LogTables,
    source: DataFrame,
    ts_col: str,
    table_name: str,
    schema_name: str | None = None,
    country: str | None = None,
    load_ts: dt.datetime | None = None,
) -> int:
    """Rows of the source below the mark that no load took, as they arrived too
    late: those below it (one column is read) less all that were loaded. They are
    written to the audit table if there are any."""
    mark = logs.last_process_date(table_name, schema_name, country)
    if mark is None:
        return 0
    below = source.where(F.col(ts_col) < F.lit(mark.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")).count()
    late = below - logs.rows_processed(table_name, schema_name, country)
    if late > 0:
        step = f"rows of {ts_col} below the mark that no load took: {late}"
        logs.log_audit("INCREMENTAL_LOAD", table_name, step, schema_name, table_name, load_ts)
    return late


def fact_days(facts: list[tuple[DataFrame, str]]) -> DataFrame:
    """(source, d, n): rows of each fact by date (rows without one are left
    out), map-side first; ``source`` is the date column's name. A row a day and
    fact, so a stored copy answers whatever is asked about the facts' dates."""
    parts = [
        df.select(cal.as_date(c).alias("d")).where("d is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(c).alias("source"), "d", "n")
        for df, c in facts
    ]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both


def dimension_checks(
    dim: DataFrame, fin_cal: DataFrame, facts: list[tuple[DataFrame, str]], days: DataFrame | None = None
) -> DataFrame:
    """Quality checks of a date dimension (X8), one row per check with the
    number of failures: duplicate dates, missing days inside its span, rows
    without a financial-calendar row, and fact dates it does not cover (rows
    without a date are not judged).

    Every source is reduced to its dates with a count, map-side first; the
    counts meet in one grouping by date, and one aggregate over the days
    gives all checks. With ``days`` (``fact_days`` of the same facts) the facts
    themselves are not read."""
    if days is None:
        days = fact_days(facts)
    names = ["dim", "fin", *(f"fact{k}" for k in range(len(facts)))]

    def per_date(df: DataFrame, name: str) -> DataFrame:
        return df.select("d", *[(F.col("n") if x == name else F.lit(0).cast("long")).alias(x) for x in names])

    def dates(df: DataFrame) -> DataFrame:
        return df.select(F.col("calendar_date").alias("d")).where("d is not null").groupBy("d").agg(F.count(F.lit(1)).alias("n"))

    parts = [per_date(dates(dim), "dim"), per_date(dates(fin_cal), "fin")]
    parts += [per_date(days.where(F.col("source") == c), f"fact{k}") for k, (_, c) in enumerate(facts)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    days = both.groupBy("d").agg(*[F.sum(x).alias(x) for x in both.columns[1:]])
    held = F.col("dim") > 0
    first, last = (f(F.when(held, F.col("d"))) for f in (F.min, F.max))
    checks = {
        "duplicate_dates": F.count_if(F.col("dim") > 1),
        "missing_dates": F.coalesce(F.datediff(last, first) + 1 - F.count_if(held), F.lit(0)),
        "dates_without_fin_row": F.coalesce(F.sum(F.when(F.col("fin") == 0, F.col("dim"))), F.lit(0)),
        **{
            f"fact_dates_outside_dim:{c}": F.count_if((F.col(f"fact{k}") > 0) & ~held) for k, (_, c) in enumerate(facts)
        },
    }
    row = days.agg(*[v.cast("long").alias(k) for k, v in checks.items()])
    return row.unpivot([], list(checks), "check_name", "failures")
