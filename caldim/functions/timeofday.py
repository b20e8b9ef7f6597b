"""Time-of-day attributes of a second of the day (0..86399), as Column
expressions: key, 24- and 12-hour text, minute of day, interval labels of
any width and the daypart.

The labels come from integer arithmetic, ``lpad`` and ``concat``, so they do
not depend on the session time zone and stay inside whole-stage codegen. The
same expressions build the 86 400-row dimension and enrich a fact or a stream
directly, without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400

# Daypart names and their first and last hour (both inclusive);
# every other hour is OTHER_DAYPART.
DAYPARTS = [
    ("BREAKFAST", 9, 10),
    ("LUNCH", 11, 14),
    ("AFTERNOON", 15, 16),
    ("DINNER", 17, 20),
    ("LATE NIGHT", 21, 22),
]
OTHER_DAYPART = "OTHER"

# Interval widths, in minutes, of the dimension's label columns.
INTERVAL_COLUMNS = [
    ("interval_05_min", 5),
    ("interval_15_min", 15),
    ("interval_30_min", 30),
    ("interval_01_hour", 60),
]


def second_of_day(ts: Column | str) -> Column:
    """Second of the day of a timestamp_ntz (or session-local timestamp)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def _parts(s: Column) -> tuple[Column, Column, Column]:
    return (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), (s % 60).cast("int")


def time_key(s: Column) -> Column:
    """The dimension key: 1-based, so second 0 has key 1."""
    return (s + 1).cast("int")


def _two(x: Column) -> Column:
    """Two-digit text of 0..99 (lpad + concat stay in generated code; a
    printf-style format costs several times more per row)."""
    return F.lpad(x.cast("string"), 2, "0")


def _hms(h: Column, m: Column, sec: Column) -> Column:
    # concat, not concat_ws: a NULL part must give NULL, not ""
    return F.concat(_two(h), F.lit(":"), _two(m), F.lit(":"), _two(sec))


def hh24(s: Column) -> Column:
    h, m, sec = _parts(s)
    return _hms(h, m, sec)


def hh12(s: Column) -> Column:
    """'hh:mm:ss AM', with 12 for the hour after midnight and after noon."""
    h, m, sec = _parts(s)
    h12 = ((h + 11) % 12) + 1
    return F.concat(_hms(h12, m, sec), F.lit(" "), F.when(h < 12, "AM").otherwise("PM"))


def minute_of_day(s: Column) -> Column:
    """floor(key / 60) on the 1-based key: second 59 already counts as
    minute 1 and the last second as minute 1440, as in the original."""
    return F.floor(time_key(s) / 60).cast("int")


def interval_label(s: Column, width_minutes: int) -> Column:
    """'HH:MM:00-HH:MM:59' for the width-minute bucket holding s
    (width divides 60)."""
    if width_minutes <= 0 or 60 % width_minutes:
        raise ValueError("interval width must divide 60")
    h, m, _ = _parts(s)
    lo = m - m % width_minutes
    hh = _two(h)
    return F.concat(hh, F.lit(":"), _two(lo), F.lit(":00-"), hh, F.lit(":"), _two(lo + (width_minutes - 1)), F.lit(":59"))


def daypart(s: Column) -> Column:
    """Daypart of a second of day; NULL for NULL (like every other column,
    and like a fact row that finds no dimension row)."""
    h = (s / 3600).cast("int")
    out = F.when(s.isNull(), F.lit(None).cast("string"))
    for name, first, last in DAYPARTS:
        cond = h.between(first, last)
        out = out.when(cond, name)
    return out.otherwise(OTHER_DAYPART)


def time_of_day_columns(s: Column) -> dict[str, Column]:
    """The dimension's columns (LAST_UPDATE_DATE excluded), in order."""
    cols = {
        "time_of_day_key": time_key(s),
        "time_of_day_hh24": hh24(s),
        "time_of_day_hh12": hh12(s),
        "minute_of_day": minute_of_day(s),
    }
    for name, width in INTERVAL_COLUMNS:
        cols[name] = interval_label(s, width)
    cols["serving_time"] = daypart(s)
    return cols


def with_time_of_day(df: DataFrame, ts: str | Column, prefix: str = "") -> DataFrame:
    """Add the time-of-day columns of a timestamp column to any DataFrame
    (X4): a projection, no join."""
    cols = time_of_day_columns(second_of_day(ts))
    return df.withColumns({prefix + k: v for k, v in cols.items()})
