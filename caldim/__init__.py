"""caldim: date, financial-calendar and time-of-day dimensions and calendar
analytics on Apache Spark. The main entry points are re-exported here."""

from caldim.operators.dimension import (
    calendar_dim,
    generate_date_dim,
    merge_dim,
    roll_date_dim,
    stage_date,
)
from caldim.operators.facts import (
    by_fiscal_period,
    calendar_rollup,
    daypart_profile,
    dimension_checks,
    incremental_load,
    interval_profile,
    period_to_date,
    with_calendar_attributes,
)
from caldim.operators.steps import (
    build_time_of_day_procedure,
    generate_dim_date_procedure,
    roll_dim_date_procedure,
    run_step,
)
from caldim.operators.time_of_day import time_of_day_dim, with_time_of_day
from caldim.operators.views import date_view, register_views, time_of_day_view
from caldim.sources.fincal import formula_financial_calendar, read_financial_calendar
from caldim.sources.logs import LogTables
from caldim.sources.spine import date_spine, fact_date_span, second_spine
from caldim.sources.store import VersionedTable

__all__ = [
    "LogTables",
    "VersionedTable",
    "build_time_of_day_procedure",
    "by_fiscal_period",
    "calendar_dim",
    "calendar_rollup",
    "date_spine",
    "date_view",
    "daypart_profile",
    "dimension_checks",
    "fact_date_span",
    "formula_financial_calendar",
    "generate_date_dim",
    "generate_dim_date_procedure",
    "incremental_load",
    "interval_profile",
    "merge_dim",
    "period_to_date",
    "read_financial_calendar",
    "register_views",
    "roll_date_dim",
    "roll_dim_date_procedure",
    "run_step",
    "second_spine",
    "stage_date",
    "time_of_day_dim",
    "time_of_day_view",
    "with_calendar_attributes",
    "with_time_of_day",
]
