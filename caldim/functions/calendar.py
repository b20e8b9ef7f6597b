"""Calendar attributes of a date, as plain Column expressions.

Every function takes a DateType column and returns a Column, so one rule
serves the date dimension, a fact table with billions of rows and a stream
alike. All of them are built-in Catalyst expressions: they stay inside
whole-stage codegen and need neither a join nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the dimension (Spark datetime patterns).
DESC_DATE_FORMAT = "MMMM dd,yyyy"  # "January 05,2020", no blank after the comma
MONTH_FORMAT = "yyyy-MM"  # "2020-01"
MONTH_NAME_FORMAT = "MMMM"  # "January"
MONTH_ABRV_FORMAT = "MMM"  # "Jan"
DAY_NAME_FORMAT = "EEEE"  # "Sunday"
INVALID_DAY = "Invalid Day"


def as_date(c: Column | str) -> Column:
    """A date from a date, timestamp or timestamp_ntz column (no zone shift
    for timestamp_ntz)."""
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def date_key(d: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic rather than text formatting."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_name(d: Column) -> Column:
    """Full weekday name; a NULL date gives 'Invalid Day'."""
    return F.coalesce(F.date_format(d, DAY_NAME_FORMAT), F.lit(INVALID_DAY))


def day_name_abrv(d: Column) -> Column:
    return F.dayname(d)


def day_in_week_no(d: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(d) - 1).cast("int")


def iso_day_no(d: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(d) + 1).cast("int")


def weekend_flag(d: Column) -> Column:
    """1 on Saturday and Sunday, else 0 (NULL date: 0)."""
    return F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0)


def weekday_flag(d: Column) -> Column:
    """1 from Monday to Friday, else 0 (NULL date: 0)."""
    return F.when(~F.dayofweek(d).isin(1, 7), 1).otherwise(0)


def week_commencing(d: Column) -> Column:
    """Monday of the ISO week holding d."""
    return F.date_sub(d, F.weekday(d))


def week_ending(d: Column) -> Column:
    """Sunday of the ISO week holding d."""
    return F.date_add(week_commencing(d), 6)


def month_label(d: Column) -> Column:
    return F.date_format(d, MONTH_FORMAT)


def monthend_flag(d: Column) -> Column:
    return F.when(d == F.last_day(d), "Y").otherwise("N")


def cal_quarter(d: Column) -> Column:
    """Year, '0' and quarter as text, e.g. '202001'."""
    return F.concat(F.year(d).cast("string"), F.lit("0"), F.quarter(d).cast("string"))


def mmdd(d: Column) -> Column:
    """Month and day as text 'MMdd', compared as text by the year-ago rules."""
    return F.date_format(d, "MMdd")


def calendar_columns(d: Column) -> dict[str, Column]:
    """The calendar columns of the date dimension that depend on the date
    alone, in dimension order (DATE_KEY and CALENDAR_DATE excluded)."""
    dn = day_name(d)
    return {
        "date_desc": F.concat(dn, F.lit(", "), F.date_format(d, DESC_DATE_FORMAT)),
        "day_name": dn,
        "day_name_abrv": day_name_abrv(d),
        "day_in_week_no": day_in_week_no(d),
        "day_in_month": F.dayofmonth(d),
        "weekday_flag": weekday_flag(d),
        "weekend_flag": weekend_flag(d),
        "week_commencing_date_key": date_key(week_commencing(d)),
        "week_commencing_date": week_commencing(d),
        "week_ending_date_key": date_key(week_ending(d)),
        "week_ending_date": week_ending(d),
        "month_no": F.month(d),
        "month": month_label(d),
        "month_name": F.date_format(d, MONTH_NAME_FORMAT),
        "month_name_abrv": F.date_format(d, MONTH_ABRV_FORMAT),
        "monthend_flag": monthend_flag(d),
        "cal_day_in_year": F.dayofyear(d),
        "cal_week_in_year": F.weekofyear(d),
        "cal_quarter_no": F.quarter(d),
        "cal_quarter": cal_quarter(d),
        "cal_year": F.year(d),
    }


def with_date_attributes(df, date_col: str | Column, prefix: str = "") -> "DataFrame":  # noqa: F821
    """Add the calendar columns (and date_key) of a date or timestamp column
    to any DataFrame: no join, no shuffle, one projection."""
    d = as_date(date_col)
    cols = {"date_key": date_key(d), **calendar_columns(d)}
    return df.withColumns({prefix + k: v for k, v in cols.items()})
