"""As-of rules: day and financial statuses, to-date and year-ago flags.

The as-of date is always an explicit argument (never ``current_date``), so
results are reproducible and one rule serves a nightly roll, a back-fill and
a fact query alike. The financial position of the as-of date (year, quarter,
period, week) is looked up once, on the driver, as a one-row result, and
enters the plan as literals, where constant folding reduces each rule to a
comparison of the row's own columns with constants.

Two variants exist because the two procedures of the original disagree:
``"roll"`` (the maintained logic, default) and ``"generate"`` (used when a
dimension is first generated).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions import fiscal as fis

# Labels written by the as-of rules.
TODAY = "Today"
PREVIOUS_DAY = "Previous Day"
TWO_DAYS_AGO = "2 Days Ago"
PREVIOUS_DAY_LAST_YEAR = "Previous Day Last Year"
OTHER_DAY = "Other"
CURRENT_YEAR = "Current Year"
PREVIOUS_YEAR = "Previous Year"
TWO_YEAR_BACK = "2 Year Back"
CURRENT_QUARTER = "Current Quarter"
PREVIOUS_QUARTER = "Previous Quarter"
CURRENT_QUARTER_LAST_YEAR = "Current Quarter Last Year"
CURRENT_PERIOD = "Current Period"
PREVIOUS_PERIOD = "Previous Period"
CURRENT_PERIOD_LAST_YEAR = "Current Period Last Year"
CURRENT_WEEK = "Current Week"
PREVIOUS_WEEK = "Previous Week"
TWO_WEEKS_BACK = "2 Weeks Back"
CURRENT_WEEK_LAST_YEAR = "Current Week Last Year"
PREVIOUS_WEEK_LAST_YEAR = "Previous Week Last Year"
TWO_WEEKS_BACK_LAST_YEAR = "2 Weeks Back Last Year"
CURRENT_WEEK_2_YEAR_BACK = "Current Week 2 Year Back"
PREVIOUS_WEEK_2_YEAR_BACK = "Previous Week 2 Year Back"
YES, NO = "YES", "NO"

VARIANTS = ("roll", "generate")

ASOF_COLUMNS = [
    "fin_year_status",
    "fin_quarter_status",
    "fin_period_status",
    "fin_week_status",
    "current_cal_wtd",
    "current_cal_mtd",
    "current_cal_ptd",
    "current_cal_qtd",
    "current_cal_ytd",
    "previous_wk_cal_wtd",
    "previous_yr_cal_wtd",
    "previous_yr_cal_ptd",
    "previous_yr_cal_qtd",
    "previous_yr_cal_ytd",
]


class AsOfNotFound(ValueError):
    """The as-of date has no row in the calendar it is looked up in."""


class DuplicateCalendarDate(ValueError):
    """A calendar date occurs more than once where it must be unique."""


@dataclass(frozen=True)
class Position:
    """The as-of date and its financial year, quarter, period and week."""

    as_of: dt.date
    fin_year: int | None
    fin_quarter: int | None
    fin_period: int | None
    fin_week: int | None


def _lookup(rows: list, as_of: dt.date, where: str) -> Position:
    if not rows:
        raise AsOfNotFound(f"as-of date {as_of} has no row in the {where}")
    if len(rows) > 1:
        raise DuplicateCalendarDate(f"as-of date {as_of} occurs {len(rows)} times in the {where}")
    r = rows[0]
    return Position(as_of, r[0], r[1], r[2], r[3])


def position_from_fin_calendar(fin_cal: DataFrame, as_of: dt.date) -> Position:
    """Financial position of ``as_of`` read from the financial calendar (one
    row, filter pushed to the scan)."""
    rows = (
        fin_cal.where(F.col("calendar_date") == F.lit(as_of))
        .select(
            fis.year_no(F.col("financial_year")),
            F.col("financial_quarter").cast("int"),
            fis.period_no(F.col("financial_period")),
            fis.week_no(F.col("financial_week")),
        )
        .take(2)
    )
    return _lookup(rows, as_of, "financial calendar")


def position_from_dim(dim: DataFrame, as_of: dt.date) -> Position:
    """Financial position of ``as_of`` read from the date dimension itself."""
    rows = (
        dim.where(F.col("calendar_date") == F.lit(as_of))
        .select(
            fis.year_no(F.col("fin_year")),
            F.col("fin_quarter_no").cast("int"),
            fis.period_no(F.col("fin_period")),
            fis.week_no(F.col("fin_week_in_year")),
        )
        .take(2)
    )
    return _lookup(rows, as_of, "date dimension")


def _int(v: int | None) -> Column:
    return F.lit(v).cast("int")


def _yes_no(cond: Column) -> Column:
    """'YES' when the condition holds, else 'NO' (NULL counts as not holding)."""
    return F.when(cond, YES).otherwise(NO)


def _after_leap_year(d: Column) -> Column:
    """The year test of the original: the year before d's year divides by 4."""
    return (F.year(d) - 1) % 4 == 0


def day_status(d: Column, as_of: dt.date, variant: str = "roll") -> Column:
    a = F.lit(as_of)
    st = F.when(d == a, TODAY).when(d == F.date_sub(a, 1), PREVIOUS_DAY)
    if variant == "roll":
        st = st.when(d == F.date_sub(a, 2), TWO_DAYS_AGO)
    last_year = (_after_leap_year(d) & (d == F.date_sub(a, 365))) | (
        ~_after_leap_year(d) & (d == F.date_sub(a, 364))
    )
    return st.when(last_year, PREVIOUS_DAY_LAST_YEAR).otherwise(OTHER_DAY)


def _year_quarter_status(fy: Column, n: Column, cy: Column, cn: Column, labels: tuple[str, str, str]) -> Column:
    cur, prev, cur_ly = labels
    return (
        F.when((fy == cy) & (n == cn), cur)
        .when((fy == cy) & (n == cn - 1), prev)
        .when((fy == cy - 1) & (n == cn), cur_ly)
    )


def asof_columns(cols: dict[str, Column], pos: Position, variant: str = "roll") -> dict[str, Column]:
    """All fourteen as-of columns after ``day_status`` (see ``ASOF_COLUMNS``).

    ``cols`` holds the dimension columns the rules read: calendar_date,
    month, cal_quarter, cal_year, fin_year, fin_quarter_no, fin_period,
    fin_week_in_year.
    """
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    d = cols["calendar_date"]
    a = F.lit(pos.as_of)
    cy, cq, cp, cw = _int(pos.fin_year), _int(pos.fin_quarter), _int(pos.fin_period), _int(pos.fin_week)
    fy = fis.year_no(cols["fin_year"])
    fq = cols["fin_quarter_no"]
    fp = fis.period_no(cols["fin_period"])
    fw = fis.week_no(cols["fin_week_in_year"])

    fin_year_status = F.when(fy == cy, CURRENT_YEAR).when(fy == cy - 1, PREVIOUS_YEAR).when(fy == cy - 2, TWO_YEAR_BACK)
    fin_quarter_status = _year_quarter_status(
        fy, fq, cy, cq, (CURRENT_QUARTER, PREVIOUS_QUARTER, CURRENT_QUARTER_LAST_YEAR)
    )
    fin_period_status = _year_quarter_status(
        fy, fp, cy, cp, (CURRENT_PERIOD, PREVIOUS_PERIOD, CURRENT_PERIOD_LAST_YEAR)
    )
    if variant == "roll":
        fin_week_status = (
            F.when((fy == cy) & (fw == cw), CURRENT_WEEK)
            .when((fy == cy) & (fw == cw - 1), PREVIOUS_WEEK)
            .when((fy == cy) & (fw == cw - 2), TWO_WEEKS_BACK)
            .when((fy == cy - 1) & (fw == cw), CURRENT_WEEK_LAST_YEAR)
            .when((fy == cy - 1) & (fw == cw - 1), PREVIOUS_WEEK_LAST_YEAR)
            .when((fy == cy - 1) & (fw == cw - 2), TWO_WEEKS_BACK_LAST_YEAR)
            .when((fy == cy - 2) & (fw == cw), CURRENT_WEEK_2_YEAR_BACK)
            .when((fy == cy - 2) & (fw == cw - 1), PREVIOUS_WEEK_2_YEAR_BACK)
        )
    else:
        fin_week_status = (
            F.when((fy == cy) & (fw == cw), CURRENT_WEEK)
            .when((fy == cy) & (fw == cw - 1), PREVIOUS_WEEK)
            .when((fy == cy - 1) & (fw == cw), CURRENT_WEEK_LAST_YEAR)
            .when((fy == cy - 1) & (fw == cw - 1), PREVIOUS_WEEK_LAST_YEAR)
        )

    up_to = d <= a
    mmdd_le = cal.mmdd(d) <= cal.mmdd(a)
    a_year, a_quarter = F.year(a), F.quarter(a)
    if variant == "roll":
        a_ly = F.date_sub(a, 364)
        prev_yr_wtd = (cal.week_commencing(a_ly) <= d) & (d <= a_ly)
    else:
        a_ly = F.when(_after_leap_year(d), F.date_sub(a, 366)).otherwise(F.date_sub(a, 365))
        prev_yr_wtd = (cal.week_commencing(a_ly) <= d) & mmdd_le
    a_lw = F.date_sub(a, 7)

    return {
        "fin_year_status": fin_year_status,
        "fin_quarter_status": fin_quarter_status,
        "fin_period_status": fin_period_status,
        "fin_week_status": fin_week_status,
        "current_cal_wtd": _yes_no((cal.week_commencing(a) <= d) & up_to),
        "current_cal_mtd": _yes_no((cols["month"] == cal.month_label(a)) & up_to),
        "current_cal_ptd": _yes_no((fy == cy) & (fp == cp) & up_to),
        "current_cal_qtd": _yes_no(
            (cols["cal_quarter"] == F.concat(a_year.cast("string"), F.lit("0"), a_quarter.cast("string"))) & up_to
        ),
        "current_cal_ytd": _yes_no((cols["cal_year"] == a_year) & up_to),
        "previous_wk_cal_wtd": _yes_no((cal.week_commencing(a_lw) <= d) & (d <= a_lw)),
        "previous_yr_cal_wtd": _yes_no(prev_yr_wtd),
        "previous_yr_cal_ptd": _yes_no((fy == cy - 1) & (fp == cp) & mmdd_le),
        "previous_yr_cal_qtd": _yes_no(
            (cols["cal_quarter"] == F.concat((a_year - 1).cast("string"), F.lit("0"), a_quarter.cast("string")))
            & mmdd_le
        ),
        "previous_yr_cal_ytd": _yes_no((cols["cal_year"] == a_year - 1) & mmdd_le),
    }

