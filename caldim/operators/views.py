"""Business views: renames to reporting names, plus one derived label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Business names of the date view, in view order.
DATE_VIEW_NAMES = [
    ("date_key", "Date Key"),
    ("calendar_date", "Calendar Date"),
    ("date_desc", "Date Desc"),
    ("day_name", "Day Name"),
    ("day_name_abrv", "Day Name Abrv"),
    ("day_in_week_no", "Day In Week No"),
    ("day_in_month", "Day In Month"),
    ("day_status", "Day Status"),
    ("weekday_flag", "Weekday Flag"),
    ("weekend_flag", "Weekend Flag"),
    ("week_commencing_date_key", "Week Commencing Date Key"),
    ("week_commencing_date", "Week Commencing Date"),
    ("week_ending_date_key", "Week Ending Date Key"),
    ("week_ending_date", "Week Ending Date"),
    ("cal_year", "Calendar Year"),
    ("month_no", "Calendar Month No"),
    ("month", "Calendar Month"),
    ("month_name", "Calendar Month Name"),
    ("month_name_abrv", "Calendar Month Name Abrv"),
    ("monthend_flag", "Calendar Monthend Flag"),
    ("cal_week_in_year", "Calendar Week In Year"),
    ("cal_day_in_year", "Calendar Day In Year"),
    ("cal_quarter_no", "Calendar Quarter No"),
    ("cal_quarter", "Calendar Quarter"),
    ("fin_year", "Financial Year"),
    ("fin_year_name", "Financial Year Name"),
    ("fin_year_status", "Financial Year Status"),
    ("fin_yearhalf", "Financial Yearhalf"),
    ("fin_period", "Financial Period"),
    ("fin_period_status", "Financial Period Status"),
    ("fin_quarter", "Financial Quarter"),
    ("fin_quarter_no", "Financial Quarter No"),
    ("fin_quarter_status", "Financial Quarter Status"),
    ("fin_week_in_year", "Financial Week In Year"),
    ("fin_week_status", "Financial Week Status"),
    ("fin_day_in_year", "Financial Day In Year"),
    ("current_cal_wtd", "Current Cal WTD"),
    ("current_cal_mtd", "Current Cal MTD"),
    ("current_cal_ptd", "Current Cal PTD"),
    ("current_cal_qtd", "Current Cal QTD"),
    ("current_cal_ytd", "Current Cal YTD"),
    ("previous_wk_cal_wtd", "Previous Wk Cal WTD"),
    ("previous_yr_cal_wtd", "Previous Yr Cal WTD"),
    ("previous_yr_cal_ptd", "Previous Yr Cal PTD"),
    ("previous_yr_cal_qtd", "Previous Yr Cal QTD"),
    ("previous_yr_cal_ytd", "Previous Yr Cal YTD"),
]
WEEK_WTD_NAME = "Financial Week WTD"
# Labels of the week-to-date column, in test order.
WEEK_WTD_LABELS = [("current_cal_wtd", "WTD"), ("previous_wk_cal_wtd", "WTD-LW"), ("previous_yr_cal_wtd", "WTD-LY")]

# Business names of the time-of-day view, in view order.
TIME_OF_DAY_VIEW_NAMES = [
    ("time_of_day_key", "Time Of Day Key"),
    ("time_of_day_hh24", "Time Of Day HH24"),
    ("time_of_day_hh12", "Time Of Day HH12"),
    ("minute_of_day", "Minute Of Day"),
    ("interval_01_hour", "Interval 01 Hour"),
    ("interval_30_min", "Interval 30 Min"),
    ("interval_15_min", "Interval 15 Min"),
    ("interval_05_min", "Interval 05 Min"),
    ("serving_time", "Day-Part"),
]


def date_view(dim: DataFrame) -> DataFrame:
    wtd = None
    for col, label in WEEK_WTD_LABELS:
        cond = F.col(col) == "YES"
        wtd = F.when(cond, label) if wtd is None else wtd.when(cond, label)
    return dim.select(*[F.col(c).alias(n) for c, n in DATE_VIEW_NAMES], wtd.alias(WEEK_WTD_NAME))


def time_of_day_view(tod: DataFrame) -> DataFrame:
    return tod.select(*[F.col(c).alias(n) for c, n in TIME_OF_DAY_VIEW_NAMES])


def register_views(
    spark: SparkSession, dim: DataFrame | None = None, tod: DataFrame | None = None, suffix: str = ""
) -> None:
    """Publish the views as temp views ``date`` and ``time_of_day``, each name
    followed by ``suffix`` (so that a job need not replace a caller's views)."""
    if dim is not None:
        date_view(dim).createOrReplaceTempView(f"date{suffix}")
    if tod is not None:
        time_of_day_view(tod).createOrReplaceTempView(f"time_of_day{suffix}")
