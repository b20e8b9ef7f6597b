"""Declared schemas and column orders of inputs, dimensions and log tables."""

from __future__ import annotations

from pyspark.sql import types as T

FIN_CALENDAR = T.StructType(
    [
        T.StructField("calendar_date", T.DateType(), False),
        T.StructField("week_commencing", T.DateType(), True),
        T.StructField("financial_week", T.StringType(), True),
        T.StructField("financial_period", T.StringType(), True),
        T.StructField("financial_quarter", T.IntegerType(), True),
        T.StructField("financial_year", T.StringType(), True),
        T.StructField("financial_year_format", T.StringType(), True),
    ]
)

# Column names of the date dimension. 47 columns. STAGE_COLUMNS (46) lack DATE_KEY, which is
# assigned when a row is first inserted.
CALENDAR_COLUMNS = [
    "date_desc",
    "day_name",
    "day_name_abrv",
    "day_in_week_no",
    "day_in_month",
    "day_status",
    "weekday_flag",
    "weekend_flag",
    "week_commencing_date_key",
    "week_commencing_date",
    "week_ending_date_key",
    "week_ending_date",
    "month_no",
    "month",
    "month_name",
    "month_name_abrv",
    "monthend_flag",
    "cal_day_in_year",
    "cal_week_in_year",
    "cal_quarter_no",
    "cal_quarter",
    "cal_year",
]
FISCAL_COLUMNS = [
    "fin_day_in_year",
    "fin_week_in_year",
    "fin_period",
    "fin_quarter_no",
    "fin_quarter",
    "fin_yearhalf",
    "fin_year",
    "fin_year_name",
]
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
# Columns rewritten by the daily roll (besides last_update_date).
ROLLED_COLUMNS = ["day_status", *ASOF_COLUMNS]
# Columns a merge updates with coalesce(stage, target).
MERGE_UPDATE_COLUMNS = [*CALENDAR_COLUMNS, *FISCAL_COLUMNS, *ASOF_COLUMNS]
STAGE_COLUMNS = ["calendar_date", *MERGE_UPDATE_COLUMNS, "last_update_date"]
DIM_DATE_COLUMNS = ["date_key", *STAGE_COLUMNS]

DIM_TIME_OF_DAY_COLUMNS = [
    "time_of_day_key",
    "time_of_day_hh24",
    "time_of_day_hh12",
    "minute_of_day",
    "interval_05_min",
    "interval_15_min",
    "interval_30_min",
    "interval_01_hour",
    "serving_time",
    "last_update_date",
]

AUDIT = T.StructType(
    [
        T.StructField("audit_key", T.LongType(), False),
        T.StructField("procedure_name", T.StringType(), True),
        T.StructField("sql_step", T.StringType(), True),
        T.StructField("step_result", T.StringType(), True),
        T.StructField("schema_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("audit_timestamp", T.TimestampNTZType(), True),
    ]
)

PROCESS_DATE = T.StructType(
    [
        T.StructField("table_name", T.StringType(), True),
        T.StructField("schema_name", T.StringType(), True),
        T.StructField("last_process_date", T.TimestampNTZType(), True),
        T.StructField("last_process_rowcount", T.LongType(), True),
        T.StructField("last_update_date", T.TimestampNTZType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

# error_code holds Spark's error condition, which is text.
ERROR = T.StructType(
    [
        T.StructField("error_key", T.LongType(), False),
        T.StructField("procedure_name", T.StringType(), True),
        T.StructField("sql_step", T.StringType(), True),
        T.StructField("error_code", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("error_state", T.StringType(), True),
        T.StructField("stack_trace", T.StringType(), True),
        T.StructField("error_timestamp", T.TimestampNTZType(), True),
    ]
)
