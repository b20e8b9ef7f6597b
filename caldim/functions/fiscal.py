"""Financial-calendar attributes, as Column expressions over the columns of
the business-supplied financial calendar (one row per day).

Input contract (text offsets are 1-based):
  calendar_date          date, unique
  week_commencing        date
  financial_week         text, week number in chars 6-7   (e.g. '1999-03')
  financial_period       text, period number in chars 8-9 (e.g. '1999-P-01')
  financial_quarter      int 1..4
  financial_year         text castable to int
  financial_year_format  text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.functions import calendar as cal

# Where the numbers sit inside the financial text columns.
WEEK_NO_POS, WEEK_NO_LEN = 6, 2  # financial_week / fin_week_in_year
PERIOD_NO_POS, PERIOD_NO_LEN = 8, 2  # financial_period / fin_period


def week_no(fin_week_text: Column) -> Column:
    """Financial week number parsed from the week text (ANSI cast: bad text raises)."""
    return F.substring(fin_week_text, WEEK_NO_POS, WEEK_NO_LEN).cast("int")


def period_no(fin_period_text: Column) -> Column:
    """Financial period number parsed from the period text."""
    return F.substring(fin_period_text, PERIOD_NO_POS, PERIOD_NO_LEN).cast("int")


def year_no(fin_year_text: Column) -> Column:
    return fin_year_text.cast("int")


def fiscal_columns(d: Column, fin: dict[str, Column]) -> dict[str, Column]:
    """Financial columns of the dimension, in dimension order.

    ``fin`` maps the financial calendar's column names to Columns (after a
    join they may be NULL: then statuses are NULL and yearhalf is 2).
    """
    fw = week_no(fin["financial_week"])
    q = fin["financial_quarter"]
    return {
        "fin_day_in_year": ((fw - 1) * 7 + cal.iso_day_no(d)).cast("int"),
        "fin_week_in_year": fin["financial_week"],
        "fin_period": fin["financial_period"],
        "fin_quarter_no": q.cast("int"),
        "fin_quarter": F.concat(fin["financial_year"], F.lit("-0"), q.cast("string")),
        "fin_yearhalf": F.when(q.isin(1, 2), 1).otherwise(2),
        "fin_year": fin["financial_year"],
        "fin_year_name": fin["financial_year_format"],
    }


FIN_COLUMNS = [
    "calendar_date",
    "week_commencing",
    "financial_week",
    "financial_period",
    "financial_quarter",
    "financial_year",
    "financial_year_format",
]


def with_fiscal_attributes(df: DataFrame, date_col: str, fin_cal: DataFrame, broadcast_ok: bool) -> DataFrame:
    """Left-join a fact to the financial calendar on its date and add the
    financial columns (X2). ``broadcast_ok`` must come from a size check of
    the calendar (see ``caldim.sources.spine.broadcast_if_bounded``)."""
    from caldim.sources.spine import broadcast_if_bounded

    day = F.col("calendar_date")
    cols = fiscal_columns(day, {c: F.col(c) for c in FIN_COLUMNS[1:]})
    # computed once per day; a fact row only takes them over
    finished = fin_cal.select(day.alias("_fin_date"), *[v.alias(k) for k, v in cols.items()])
    joined = df.withColumn("_fact_date", cal.as_date(date_col)).join(
        broadcast_if_bounded(finished, broadcast_ok), F.col("_fact_date") == F.col("_fin_date"), "left"
    )
    # dates without a calendar row count as second half
    joined = joined.withColumn("fin_yearhalf", F.coalesce("fin_yearhalf", F.lit(2)))
    return joined.drop("_fact_date", "_fin_date")
