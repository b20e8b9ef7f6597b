"""DuckDB SQL for each registered query: an independent second statement of
the same rules, run by the driver against the same parquet tables (views
``orders``, ``lineitem``, ``events``, ...). Column names and types are cast
to match the Spark side (INTEGER for Spark int, DOUBLE for money totals).
"""

from __future__ import annotations

import datetime as dt

from caldim.plans import catalog as C


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


def _wc(expr: str) -> str:
    """Monday of the ISO week of a date expression."""
    return f"CAST(date_trunc('week', {expr}) AS DATE)"


# Span: whole calendar years around the dates of both fact tables, or the
# START and END parameters of the queries that join facts to the dimension.
FACT_BOUNDS = """
bounds AS (
  SELECT make_date(CAST(year(min(d)) AS INTEGER), 1, 1) AS start_d,
         make_date(CAST(year(max(d)) AS INTEGER) + 1, 1, 1) AS end_d,
         CAST(year(min(d)) AS INTEGER) AS y0,
         CAST(year(max(d)) AS INTEGER) AS y1
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) x
)"""


def _bounds(fixed: bool = False) -> str:
    return f"bounds AS (SELECT {_d(C.START)} AS start_d, {_d(C.END)} AS end_d)" if fixed else FACT_BOUNDS


BOUNDS = _bounds()


def _spine(name: str, lo: str, hi: str) -> str:
    """Days from lo (included) to hi (excluded); lo and hi read ``bounds``."""
    return f"""
{name} AS (
  SELECT CAST(g AS DATE) AS calendar_date
  FROM (SELECT unnest(generate_series({lo}, {hi} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS g FROM bounds) s
)"""


FIN = """
fin AS (
  SELECT calendar_date, week_commencing,
         printf('%d-%02d', fy, w) AS financial_week,
         printf('%d-P-%02d', fy, p) AS financial_period,
         CAST(q AS INTEGER) AS financial_quarter,
         CAST(fy AS VARCHAR) AS financial_year,
         'FY' || CAST(fy AS VARCHAR) AS financial_year_format
  FROM (
    SELECT *, (q - 1) * 3 + CASE WHEN w - (q - 1) * 13 <= 4 THEN 1
                                 WHEN w - (q - 1) * 13 <= 8 THEN 2 ELSE 3 END AS p
    FROM (
      SELECT *, least(4, (w - 1) // 13 + 1) AS q
      FROM (
        SELECT *, date_diff('day', CAST(date_trunc('week', make_date(CAST(fy - 1 AS INTEGER), 7, 1)) AS DATE),
                            calendar_date) // 7 + 1 AS w
        FROM (
          SELECT calendar_date,
                 CAST(date_trunc('week', calendar_date) AS DATE) AS week_commencing,
                 CASE WHEN calendar_date >= CAST(date_trunc('week', make_date(CAST(year(calendar_date) AS INTEGER), 7, 1)) AS DATE)
                      THEN year(calendar_date) + 1 ELSE year(calendar_date) END AS fy
          FROM spine) a) b) c) e
)"""


def _calendar_select(d: str = "calendar_date") -> str:
    wc = _wc(d)
    return f"""
    CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key,
    {d} AS calendar_date,
    dayname({d}) || ', ' || strftime({d}, '%B %d,%Y') AS date_desc,
    dayname({d}) AS day_name,
    left(dayname({d}), 3) AS day_name_abrv,
    CAST(dayofweek({d}) AS INTEGER) AS day_in_week_no,
    CAST(day({d}) AS INTEGER) AS day_in_month,
    CASE WHEN dayofweek({d}) IN (0, 6) THEN 0 ELSE 1 END AS weekday_flag,
    CASE WHEN dayofweek({d}) IN (0, 6) THEN 1 ELSE 0 END AS weekend_flag,
    CAST(strftime({wc}, '%Y%m%d') AS INTEGER) AS week_commencing_date_key,
    {wc} AS week_commencing_date,
    CAST(strftime({wc} + 6, '%Y%m%d') AS INTEGER) AS week_ending_date_key,
    CAST({wc} + 6 AS DATE) AS week_ending_date,
    CAST(month({d}) AS INTEGER) AS month_no,
    strftime({d}, '%Y-%m') AS month,
    monthname({d}) AS month_name,
    strftime({d}, '%b') AS month_name_abrv,
    CASE WHEN {d} = last_day({d}) THEN 'Y' ELSE 'N' END AS monthend_flag,
    CAST(dayofyear({d}) AS INTEGER) AS cal_day_in_year,
    CAST(weekofyear({d}) AS INTEGER) AS cal_week_in_year,
    CAST(quarter({d}) AS INTEGER) AS cal_quarter_no,
    CAST(year({d}) AS VARCHAR) || '0' || CAST(quarter({d}) AS VARCHAR) AS cal_quarter,
    CAST(year({d}) AS INTEGER) AS cal_year"""


def _base(spine: str, name: str) -> str:
    """Calendar + financial columns of every day of ``spine``."""
    return f"""
{name} AS (
  SELECT {_calendar_select('s.calendar_date')},
    CAST((CAST(substr(f.financial_week, 6, 2) AS INTEGER) - 1) * 7 + isodow(s.calendar_date) AS INTEGER) AS fin_day_in_year,
    f.financial_week AS fin_week_in_year,
    f.financial_period AS fin_period,
    f.financial_quarter AS fin_quarter_no,
    f.financial_year || '-0' || CAST(f.financial_quarter AS VARCHAR) AS fin_quarter,
    CASE WHEN f.financial_quarter IN (1, 2) THEN 1 ELSE 2 END AS fin_yearhalf,
    f.financial_year AS fin_year,
    f.financial_year_format AS fin_year_name
  FROM {spine} s LEFT JOIN fin f ON f.calendar_date = s.calendar_date
)"""


def _status_select(a: dt.date, variant: str) -> str:
    """Day status and the fourteen as-of columns for as-of ``a``."""
    A = _d(a)
    pos = f"(SELECT {{}} FROM fin WHERE calendar_date = {A})"
    cy = pos.format("CAST(financial_year AS INTEGER)")
    cq = pos.format("financial_quarter")
    cp = pos.format("CAST(substr(financial_period, 8, 2) AS INTEGER)")
    cw = pos.format("CAST(substr(financial_week, 6, 2) AS INTEGER)")
    fy = "CAST(fin_year AS INTEGER)"
    fp = "CAST(substr(fin_period, 8, 2) AS INTEGER)"
    fw = "CAST(substr(fin_week_in_year, 6, 2) AS INTEGER)"
    d = "calendar_date"
    leap_after = f"(year({d}) - 1) % 4 = 0"
    two_days = f"WHEN {d} = {A} - 2 THEN '2 Days Ago'" if variant == "roll" else ""
    if variant == "roll":
        week = f"""CASE WHEN {fy} = {cy} AND {fw} = {cw} THEN 'Current Week'
           WHEN {fy} = {cy} AND {fw} = {cw} - 1 THEN 'Previous Week'
           WHEN {fy} = {cy} AND {fw} = {cw} - 2 THEN '2 Weeks Back'
           WHEN {fy} = {cy} - 1 AND {fw} = {cw} THEN 'Current Week Last Year'
           WHEN {fy} = {cy} - 1 AND {fw} = {cw} - 1 THEN 'Previous Week Last Year'
           WHEN {fy} = {cy} - 1 AND {fw} = {cw} - 2 THEN '2 Weeks Back Last Year'
           WHEN {fy} = {cy} - 2 AND {fw} = {cw} THEN 'Current Week 2 Year Back'
           WHEN {fy} = {cy} - 2 AND {fw} = {cw} - 1 THEN 'Previous Week 2 Year Back' END"""
        ly_wtd = f"{_wc(f'{A} - 364')} <= {d} AND {d} <= {A} - 364"
    else:
        week = f"""CASE WHEN {fy} = {cy} AND {fw} = {cw} THEN 'Current Week'
           WHEN {fy} = {cy} AND {fw} = {cw} - 1 THEN 'Previous Week'
           WHEN {fy} = {cy} - 1 AND {fw} = {cw} THEN 'Current Week Last Year'
           WHEN {fy} = {cy} - 1 AND {fw} = {cw} - 1 THEN 'Previous Week Last Year' END"""
        back = f"CASE WHEN {leap_after} THEN {A} - 366 ELSE {A} - 365 END"
        ly_wtd = f"{_wc(back)} <= {d} AND strftime({d}, '%m%d') <= strftime({A}, '%m%d')"
    mmdd = f"strftime({d}, '%m%d') <= strftime({A}, '%m%d')"
    aq = f"CAST(quarter({A}) AS VARCHAR)"

    def yn(cond: str) -> str:
        return f"CASE WHEN {cond} THEN 'YES' ELSE 'NO' END"

    return f"""
    CASE WHEN {d} = {A} THEN 'Today' WHEN {d} = {A} - 1 THEN 'Previous Day' {two_days}
         WHEN ({leap_after} AND {d} = {A} - 365) OR (NOT ({leap_after}) AND {d} = {A} - 364) THEN 'Previous Day Last Year'
         ELSE 'Other' END AS day_status,
    CASE WHEN {fy} = {cy} THEN 'Current Year' WHEN {fy} = {cy} - 1 THEN 'Previous Year'
         WHEN {fy} = {cy} - 2 THEN '2 Year Back' END AS fin_year_status,
    CASE WHEN {fy} = {cy} AND fin_quarter_no = {cq} THEN 'Current Quarter'
         WHEN {fy} = {cy} AND fin_quarter_no = {cq} - 1 THEN 'Previous Quarter'
         WHEN {fy} = {cy} - 1 AND fin_quarter_no = {cq} THEN 'Current Quarter Last Year' END AS fin_quarter_status,
    CASE WHEN {fy} = {cy} AND {fp} = {cp} THEN 'Current Period'
         WHEN {fy} = {cy} AND {fp} = {cp} - 1 THEN 'Previous Period'
         WHEN {fy} = {cy} - 1 AND {fp} = {cp} THEN 'Current Period Last Year' END AS fin_period_status,
    {week} AS fin_week_status,
    {yn(f"{_wc(A)} <= {d} AND {d} <= {A}")} AS current_cal_wtd,
    {yn(f"month = strftime({A}, '%Y-%m') AND {d} <= {A}")} AS current_cal_mtd,
    {yn(f"{fy} = {cy} AND {fp} = {cp} AND {d} <= {A}")} AS current_cal_ptd,
    {yn(f"cal_quarter = CAST(year({A}) AS VARCHAR) || '0' || {aq} AND {d} <= {A}")} AS current_cal_qtd,
    {yn(f"cal_year = year({A}) AND {d} <= {A}")} AS current_cal_ytd,
    {yn(f"{_wc(f'{A} - 7')} <= {d} AND {d} <= {A} - 7")} AS previous_wk_cal_wtd,
    {yn(ly_wtd)} AS previous_yr_cal_wtd,
    {yn(f"{fy} = {cy} - 1 AND {fp} = {cp} AND {mmdd}")} AS previous_yr_cal_ptd,
    {yn(f"cal_quarter = CAST(year({A}) - 1 AS VARCHAR) || '0' || {aq} AND {mmdd}")} AS previous_yr_cal_qtd,
    {yn(f"cal_year = year({A}) - 1 AND {mmdd}")} AS previous_yr_cal_ytd"""


CAL_COLS = """date_key, calendar_date, date_desc, day_name, day_name_abrv, day_in_week_no, day_in_month,
    day_status, weekday_flag, weekend_flag, week_commencing_date_key, week_commencing_date,
    week_ending_date_key, week_ending_date, month_no, month, month_name, month_name_abrv, monthend_flag,
    cal_day_in_year, cal_week_in_year, cal_quarter_no, cal_quarter, cal_year,
    fin_day_in_year, fin_week_in_year, fin_period, fin_quarter_no, fin_quarter, fin_yearhalf, fin_year, fin_year_name,
    fin_year_status, fin_quarter_status, fin_period_status, fin_week_status,
    current_cal_wtd, current_cal_mtd, current_cal_ptd, current_cal_qtd, current_cal_ytd,
    previous_wk_cal_wtd, previous_yr_cal_wtd, previous_yr_cal_ptd, previous_yr_cal_qtd, previous_yr_cal_ytd"""
ALL_COLS = [c.strip() for c in CAL_COLS.split(",")]
UPDATE_COLS = ALL_COLS[2:]
BASE_COLS = [c for c in ALL_COLS[: ALL_COLS.index("fin_year_name") + 1] if c != "day_status"]


def _dim(name: str, base: str, a: dt.date, variant: str, ts: dt.datetime) -> str:
    return f"""
{name} AS (
  SELECT {", ".join(BASE_COLS)}, {_status_select(a, variant)},
    {_ts(ts)} AS last_update_date
  FROM {base}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _full_dim_ctes(a=C.AS_OF, variant="roll", ts=C.TS_MERGE, fixed=False) -> str:
    return _with(
        _bounds(fixed), _spine("spine", "start_d", "end_d"), FIN, _base("spine", "base"), _dim("dim", "base", a, variant, ts)
    )


DIM_COLS = CAL_COLS + ", last_update_date"


def dim_select(cols: str = DIM_COLS, **kw) -> str:
    return f"{_full_dim_ctes(**kw)}\nSELECT {cols} FROM dim"


def _merge_ctes() -> str:
    return _with(
        BOUNDS,
        _spine("spine", "start_d", "end_d"),
        _spine("t_spine", "start_d", "make_date((y0 + y1) // 2 + 1, 1, 1)"),
        _spine("s_spine", "make_date((y0 + y1) // 2, 1, 1)", "end_d"),
        FIN,
        _base("t_spine", "t_base"),
        _base("s_spine", "s_base"),
        _dim("tgt", "t_base", C.PRIOR_AS_OF, "generate", C.TS_TARGET),
        _dim("stg", "s_base", C.AS_OF, "generate", C.TS_MERGE),
    )


def merge_upsert_sql() -> str:
    upd = ",\n  ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in UPDATE_COLS)
    return f"""{_merge_ctes()}
SELECT CASE WHEN t.calendar_date IS NOT NULL THEN t.date_key
            ELSE CAST(strftime(s.calendar_date, '%Y%m%d') AS INTEGER) END AS date_key,
  coalesce(t.calendar_date, s.calendar_date) AS calendar_date,
  {upd},
  CASE WHEN s.calendar_date IS NULL THEN t.last_update_date ELSE {_ts(C.TS_MERGE)} END AS last_update_date
FROM tgt t FULL OUTER JOIN stg s ON t.calendar_date = s.calendar_date"""


def merge_initial_load_sql() -> str:
    return f"{_merge_ctes()}\nSELECT {DIM_COLS} FROM stg"


def _tod_select(s: str) -> str:
    """Time-of-day columns of second-of-day expression s."""
    h, m, sec = f"({s}) // 3600", f"(({s}) % 3600) // 60", f"({s}) % 60"

    def label(w: int) -> str:
        lo = f"({m} - {m} % {w})"
        return f"printf('%02d:%02d:00-%02d:%02d:59', {h}, {lo}, {h}, {lo} + {w - 1})"

    return f"""
    CAST(({s}) + 1 AS INTEGER) AS time_of_day_key,
    printf('%02d:%02d:%02d', {h}, {m}, {sec}) AS time_of_day_hh24,
    printf('%02d:%02d:%02d %s', CASE WHEN {h} % 12 = 0 THEN 12 ELSE {h} % 12 END, {m}, {sec},
           CASE WHEN {h} < 12 THEN 'AM' ELSE 'PM' END) AS time_of_day_hh12,
    CAST((({s}) + 1) // 60 AS INTEGER) AS minute_of_day,
    {label(5)} AS interval_05_min,
    {label(15)} AS interval_15_min,
    {label(30)} AS interval_30_min,
    {label(60)} AS interval_01_hour,
    {_daypart(h)} AS serving_time"""


def _daypart(h: str) -> str:
    return f"""CASE WHEN {h} IS NULL THEN NULL WHEN {h} BETWEEN 9 AND 10 THEN 'BREAKFAST' WHEN {h} BETWEEN 11 AND 14 THEN 'LUNCH'
         WHEN {h} BETWEEN 15 AND 16 THEN 'AFTERNOON' WHEN {h} BETWEEN 17 AND 20 THEN 'DINNER'
         WHEN {h} BETWEEN 21 AND 22 THEN 'LATE NIGHT' ELSE 'OTHER' END"""


SOD = "(hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS INTEGER))"
MONEY = "CAST({} AS DECIMAL(18,2))"
FLAGS = [
    ("wtd", "current_cal_wtd"),
    ("mtd", "current_cal_mtd"),
    ("ptd", "current_cal_ptd"),
    ("qtd", "current_cal_qtd"),
    ("ytd", "current_cal_ytd"),
    ("lw_wtd", "previous_wk_cal_wtd"),
    ("ly_wtd", "previous_yr_cal_wtd"),
    ("ly_ptd", "previous_yr_cal_ptd"),
    ("ly_qtd", "previous_yr_cal_qtd"),
    ("ly_ytd", "previous_yr_cal_ytd"),
]


def orders_period_to_date_sql() -> str:
    any_flag = " OR ".join(f"f.{c} = 'YES'" for _, c in FLAGS)
    aggs = ",\n  ".join(
        f"CAST(count_if(f.{c} = 'YES') AS BIGINT) AS {k}_rows, "
        f"CAST(sum(CASE WHEN f.{c} = 'YES' THEN {MONEY.format('o.o_totalprice')} END) AS DOUBLE) AS {k}_sales"
        for k, c in FLAGS
    )
    return f"""{_full_dim_ctes(fixed=True)}
SELECT o.o_orderpriority,
  {aggs}
FROM orders o JOIN dim f ON CAST(o.o_orderdate AS DATE) = f.calendar_date
WHERE {any_flag}
GROUP BY o.o_orderpriority"""


def _fin_only(fixed: bool = False) -> str:
    return _with(_bounds(fixed), _spine("spine", "start_d", "end_d"), FIN)


def _money_sum(col: str, alias: str) -> str:
    return f"CAST(sum({MONEY.format(col)}) AS DOUBLE) AS {alias}"


# The business names of the date view, in its order.
DATE_VIEW = """
    date_key AS "Date Key", calendar_date AS "Calendar Date", date_desc AS "Date Desc", day_name AS "Day Name",
    day_name_abrv AS "Day Name Abrv", day_in_week_no AS "Day In Week No", day_in_month AS "Day In Month",
    day_status AS "Day Status", weekday_flag AS "Weekday Flag", weekend_flag AS "Weekend Flag",
    week_commencing_date_key AS "Week Commencing Date Key", week_commencing_date AS "Week Commencing Date",
    week_ending_date_key AS "Week Ending Date Key", week_ending_date AS "Week Ending Date",
    cal_year AS "Calendar Year", month_no AS "Calendar Month No", month AS "Calendar Month",
    month_name AS "Calendar Month Name", month_name_abrv AS "Calendar Month Name Abrv",
    monthend_flag AS "Calendar Monthend Flag", cal_week_in_year AS "Calendar Week In Year",
    cal_day_in_year AS "Calendar Day In Year", cal_quarter_no AS "Calendar Quarter No",
    cal_quarter AS "Calendar Quarter", fin_year AS "Financial Year", fin_year_name AS "Financial Year Name",
    fin_year_status AS "Financial Year Status", fin_yearhalf AS "Financial Yearhalf",
    fin_period AS "Financial Period", fin_period_status AS "Financial Period Status",
    fin_quarter AS "Financial Quarter", fin_quarter_no AS "Financial Quarter No",
    fin_quarter_status AS "Financial Quarter Status", fin_week_in_year AS "Financial Week In Year",
    fin_week_status AS "Financial Week Status", fin_day_in_year AS "Financial Day In Year",
    current_cal_wtd AS "Current Cal WTD", current_cal_mtd AS "Current Cal MTD", current_cal_ptd AS "Current Cal PTD",
    current_cal_qtd AS "Current Cal QTD", current_cal_ytd AS "Current Cal YTD",
    previous_wk_cal_wtd AS "Previous Wk Cal WTD", previous_yr_cal_wtd AS "Previous Yr Cal WTD",
    previous_yr_cal_ptd AS "Previous Yr Cal PTD", previous_yr_cal_qtd AS "Previous Yr Cal QTD",
    previous_yr_cal_ytd AS "Previous Yr Cal YTD",
    CASE WHEN current_cal_wtd = 'YES' THEN 'WTD' WHEN previous_wk_cal_wtd = 'YES' THEN 'WTD-LW'
         WHEN previous_yr_cal_wtd = 'YES' THEN 'WTD-LY' END AS "Financial Week WTD"
"""

FISCAL = "fin_day_in_year, fin_week_in_year, fin_period, fin_quarter_no, fin_quarter, fin_yearhalf, fin_year, fin_year_name"


def procedure_audit_sql() -> str:
    """Row counts of every statement, from the spans alone: the spine, the
    calendar, the financial calendar, the join and the stage have a row a day."""
    first, second = ("first", "make_date((y0 + y1) // 2 + 1, 1, 1)"), ("second", "make_date((y0 + y1) // 2, 1, 1)")
    staged = ("date spine", "calendar", "financial calendar", "joined", "stage")
    rows, key = [], 0

    def add(proc: str, step: str, result: str, ts: dt.datetime) -> None:
        nonlocal key
        key += 1
        rows.append(
            f"SELECT CAST({key} AS BIGINT) AS audit_key, '{proc}' AS procedure_name, '{step}' AS sql_step, "
            f"{result} AS step_result, CAST(NULL AS VARCHAR) AS schema_name, CAST(NULL AS VARCHAR) AS table_name, "
            f"{_ts(ts)} AS audit_timestamp FROM n"
        )

    gen = "GENERATE_DIM_DATE"
    for x in staged:
        add(gen, f"insert {x}", "'number of rows inserted: ' || first", C.TS_TARGET)
    add(gen, "truncate dim_date", "'number of rows deleted: 0'", C.TS_TARGET)
    add(gen, "merge into dim_date", "'number of rows inserted: ' || first || ', number of rows updated: 0'", C.TS_TARGET)
    for x in staged:
        add(gen, f"insert {x}", "'number of rows inserted: ' || second", C.TS_MERGE)
    merged = "'number of rows inserted: ' || (whole - first) || ', number of rows updated: ' || (first + second - whole)"
    add(gen, "merge into dim_date", merged, C.TS_MERGE)
    add("ROLL_DIM_DATE", "update dim_date", "'number of rows updated: ' || whole", C.TS_MERGE)
    return (
        f"WITH {FACT_BOUNDS}, n AS (SELECT date_diff('day', start_d, {first[1]}) AS first, "
        f"date_diff('day', {second[1]}, end_d) AS second, date_diff('day', start_d, end_d) AS whole FROM bounds)\n"
        + "\nUNION ALL ".join(rows)
    )


def quality_sql() -> str:
    def checks(name: str, dim: str, fin: str) -> str:
        outside = "".join(
            f"""
UNION ALL SELECT '{name}', 'fact_dates_outside_dim:{c}', (SELECT count(DISTINCT CAST({c} AS DATE)) FROM {t}
    WHERE CAST({c} AS DATE) NOT IN (SELECT calendar_date FROM {dim}))"""
            for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
        )
        return f"""
SELECT '{name}' AS dimension, 'duplicate_dates' AS check_name,
  (SELECT count(*) FROM (SELECT calendar_date FROM {dim} GROUP BY 1 HAVING count(*) > 1) z) AS failures
UNION ALL SELECT '{name}', 'missing_dates', (SELECT count(*) FROM spine WHERE calendar_date NOT IN (SELECT calendar_date FROM {dim}))
UNION ALL SELECT '{name}', 'dates_without_fin_row', (SELECT count(*) FROM {dim} WHERE calendar_date NOT IN (SELECT calendar_date FROM {fin})){outside}"""

    return f"""{_full_dim_ctes()},
damaged AS (
  SELECT calendar_date FROM dim WHERE year(calendar_date) <> (SELECT year(min(CAST(o_orderdate AS DATE))) + 1 FROM orders)
  UNION ALL SELECT calendar_date FROM dim WHERE calendar_date = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)),
shorter AS (SELECT * FROM fin WHERE calendar_date < (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem))
{checks('sound', 'dim', 'fin')}
UNION ALL {checks('damaged', 'damaged', 'shorter')}"""


def oracle_sql() -> dict[str, str]:

    q: dict[str, str] = {}
    q["date_spine"] = f"{_with(BOUNDS, _spine('spine', 'start_d', 'end_d'))}\nSELECT calendar_date FROM spine"
    q["calendar_columns"] = (
        f"{_with(BOUNDS, _spine('spine', 'start_d', 'end_d'))}\nSELECT {_calendar_select()} FROM spine"
    )
    q["fiscal_columns"] = dim_select("calendar_date, " + FISCAL)
    q["day_status"] = dim_select("calendar_date, day_status")
    q["fin_statuses"] = dim_select(
        "calendar_date, fin_year_status, fin_quarter_status, fin_period_status, fin_week_status"
    )
    q["cal_to_date_flags"] = dim_select(
        "calendar_date, current_cal_wtd, current_cal_mtd, current_cal_ptd, current_cal_qtd, current_cal_ytd"
    )
    q["prev_to_date_flags"] = dim_select(
        "calendar_date, previous_wk_cal_wtd, previous_yr_cal_wtd, previous_yr_cal_ptd, previous_yr_cal_qtd, "
        "previous_yr_cal_ytd"
    )
    q["prev_yr_wtd_generate_variant"] = dim_select(
        "calendar_date, day_status, fin_week_status, previous_yr_cal_wtd", variant="generate"
    )
    q["date_dim"] = dim_select()
    q["date_dim_generate"] = dim_select(variant="generate")
    q["lineitem_by_week_status"] = f"""{_full_dim_ctes(fixed=True)}
SELECT d.fin_week_status, count(*) AS n_rows,
       CAST(sum({MONEY.format('l.l_extendedprice')} * (1 - {MONEY.format('l.l_discount')})) AS DOUBLE) AS revenue
FROM lineitem l LEFT JOIN dim d ON d.calendar_date = CAST(l.l_shipdate AS DATE)
GROUP BY 1"""
    q["orders_by_week_wtd_sql"] = f"""{_full_dim_ctes(fixed=True)},
lab AS (SELECT calendar_date, CASE WHEN current_cal_wtd = 'YES' THEN 'WTD' WHEN previous_wk_cal_wtd = 'YES' THEN 'WTD-LW'
                                   WHEN previous_yr_cal_wtd = 'YES' THEN 'WTD-LY' END AS week_wtd FROM dim)
SELECT week_wtd, count(*) AS n_rows, {_money_sum('o.o_totalprice', 'sales')}
FROM orders o JOIN lab ON lab.calendar_date = CAST(o.o_orderdate AS DATE)
WHERE week_wtd IS NOT NULL GROUP BY 1"""
    q["date_view"] = dim_select(DATE_VIEW)
    q["merge_upsert"] = merge_upsert_sql()
    q["merge_initial_load"] = merge_initial_load_sql()
    q["roll_dim"] = dim_select()
    q["procedures_generate_roll"] = dim_select()
    q["procedure_audit"] = procedure_audit_sql()
    columns = "calendar_date, week_commencing, financial_week, financial_period, financial_quarter, financial_year, financial_year_format"
    q["fin_calendar_scan"] = f"""{_fin_only()}
SELECT {columns}, 'csv' AS file_format FROM fin UNION ALL SELECT {columns}, 'parquet' FROM fin"""
    q["events_time_of_day"] = f"SELECT event_id, {_tod_select(SOD)} FROM events"
    q["time_of_day_event_counts"] = f"""
WITH d AS (SELECT {_tod_select('CAST(range AS INTEGER)')} FROM range(86400)),
     e AS (SELECT CAST({SOD} + 1 AS INTEGER) AS k, count(*) AS event_count FROM events GROUP BY 1)
SELECT d.*, CAST(coalesce(e.event_count, 0) AS BIGINT) AS event_count
FROM d LEFT JOIN e ON d.time_of_day_key = e.k"""
    q["time_of_day_ctas"] = q["time_of_day_event_counts"].replace(
        "SELECT d.*,", f"SELECT d.*, {_ts(C.TS_MERGE)} AS last_update_date,"
    )
    q["time_of_day_view"] = f"""
SELECT serving_time AS "Day-Part", interval_01_hour AS "Interval 01 Hour", count(*) AS "Events"
FROM (SELECT {_tod_select(SOD)} FROM events) x GROUP BY 1, 2"""
    q["events_by_daypart_sql"] = f"""
SELECT serving_time AS day_part, interval_30_min, count(*) AS n_rows,
       CAST(sum({MONEY.format('value')}) AS DOUBLE) AS value_sum
FROM (SELECT value, {_tod_select(SOD)} FROM events) x GROUP BY 1, 2"""
    q["events_daypart"] = f"""
WITH parts(daypart) AS (VALUES ('BREAKFAST'), ('LUNCH'), ('AFTERNOON'), ('DINNER'), ('LATE NIGHT'), ('OTHER')),
     agg AS (SELECT serving_time AS daypart, count(*) AS n_rows, sum({MONEY.format('value')}) AS value_sum
             FROM (SELECT value, {_tod_select(SOD)} FROM events) x GROUP BY 1)
SELECT p.daypart, CAST(coalesce(a.n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(a.value_sum, 0) AS DOUBLE) AS value_sum
FROM parts p LEFT JOIN agg a ON a.daypart = p.daypart
UNION ALL SELECT daypart, n_rows, CAST(value_sum AS DOUBLE) FROM agg WHERE daypart IS NULL"""
    q["events_interval_profile"] = f"""
WITH slots AS (SELECT printf('%02d:%02d:00-%02d:%02d:59', range // 12, (range % 12) * 5, range // 12, (range % 12) * 5 + 4) AS interval
               FROM range(288)),
     agg AS (SELECT interval_05_min AS interval, count(*) AS n_rows, sum({MONEY.format('value')}) AS value_sum
             FROM (SELECT value, {_tod_select(SOD)} FROM events) x GROUP BY 1)
SELECT s.interval, CAST(coalesce(a.n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(a.value_sum, 0) AS DOUBLE) AS value_sum
FROM slots s LEFT JOIN agg a ON a.interval = s.interval
UNION ALL SELECT interval, n_rows, CAST(value_sum AS DOUBLE) FROM agg WHERE interval IS NULL"""
    q["orders_period_to_date"] = orders_period_to_date_sql()
    q["orders_by_fin_period"] = f"""{_fin_only(fixed=True)}
SELECT f.financial_year AS fin_year, f.financial_period AS fin_period, count(*) AS n_rows,
       {_money_sum('o.o_totalprice', 'sales')}
FROM orders o LEFT JOIN fin f ON f.calendar_date = CAST(o.o_orderdate AS DATE)
GROUP BY 1, 2"""
    q["orders_fiscal_attributes"] = f"""{_with(_bounds(fixed=True), _spine('spine', 'start_d', 'end_d'), FIN, _base('spine', 'base'))}
SELECT o.o_orderkey, {", ".join("b." + c.strip() for c in FISCAL.split(",") if "yearhalf" not in c)},
  coalesce(b.fin_yearhalf, 2) AS fin_yearhalf
FROM orders o LEFT JOIN base b ON b.calendar_date = CAST(o.o_orderdate AS DATE)"""
    q["lineitem_calendar_rollup"] = f"""
SELECT CAST(year(d) AS INTEGER) AS cal_year,
       CAST(year(d) AS VARCHAR) || '0' || CAST(quarter(d) AS VARCHAR) AS cal_quarter,
       strftime(d, '%Y-%m') AS month, count(*) AS n_rows,
       {_money_sum('l_quantity', 'sum_qty')},
       CAST(sum({MONEY.format('l_extendedprice')} * (1 - {MONEY.format('l_discount')})) AS DOUBLE) AS revenue
FROM (SELECT CAST(l_shipdate AS DATE) AS d, * FROM lineitem) x GROUP BY 1, 2, 3"""
    q["lineitem_date_attributes"] = (
        f"SELECT l_orderkey, l_linenumber, {_calendar_select('d').replace('d AS calendar_date,', '')} "
        "FROM (SELECT CAST(l_shipdate AS DATE) AS d, * FROM lineitem) x"
    )
    q["dim_quality_checks"] = quality_sql()

    def audit(key: int, step: str, result: str, source: str) -> str:
        return f"""
SELECT CAST({key} AS BIGINT) AS audit_key, '{C.STEP_PROCEDURE}' AS procedure_name, '{step}' AS sql_step,
       {result} AS step_result, CAST(NULL AS VARCHAR) AS schema_name, CAST(NULL AS VARCHAR) AS table_name,
       {_ts(C.TS_MERGE)} AS audit_timestamp FROM {source}"""

    q["audit_log"] = " UNION ALL ".join(
        (
            audit(1, "count lineitem", "'row_count: ' || CAST(count(*) AS VARCHAR)", "lineitem"),
            audit(2, "count orders", "'row_count: ' || CAST(count(*) AS VARCHAR)", "orders"),
            audit(3, "first order", "'first_order: ' || CAST(min(l_orderkey) AS VARCHAR)", "lineitem"),
        )
    )

    def error(key: int, step: str, value: str) -> str:
        return f"""
SELECT CAST({key} AS BIGINT) AS error_key, '{C.STEP_PROCEDURE}' AS procedure_name, '{step}' AS sql_step,
       'CAST_INVALID_INPUT' AS error_code, {value} AS bad_value, '22018' AS error_state,
       {_ts(C.TS_MERGE)} AS error_timestamp
FROM (SELECT count(*) AS n FROM orders WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL) x WHERE n > 0"""

    q["error_log"] = error(1, "cast priority", "(SELECT chr(39) || max(o_orderpriority) || chr(39) FROM orders)") + " UNION ALL " + error(2, "cast last row", "chr(39) || 'last' || chr(39)")
    lo, hi, loaded = _ts(C.HWM_FIRST_LOAD), _ts(C.HWM_LAST_LOAD), _ts(C.TS_MERGE)
    q["process_date_increment"] = f"""
WITH n AS (
  SELECT count_if(o_orderdate < {lo}) AS before, count_if(o_orderdate >= {lo} AND o_orderdate < {hi}) AS later,
         count_if(o_orderdate < {hi} AND (o_orderdate <> {lo} OR o_orderkey % 2 = 0)) AS other
  FROM orders)
SELECT schema_name, 'orders' AS table_name, last_process_date, last_process_rowcount, {loaded} AS last_update_date,
       'NZ' AS country, rows_in_target
FROM (SELECT 'tpch' AS schema_name, {lo} AS last_process_date, before AS last_process_rowcount, before + later AS rows_in_target FROM n
      UNION ALL SELECT 'other', {hi}, other, other FROM n
      UNION ALL SELECT 'tpch', {hi}, later, before + later FROM n) x"""
    q["events_stream_daypart"] = f"""
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, daypart, count(*) AS events,
       CAST(sum({MONEY.format('value')}) AS DOUBLE) AS value_sum
FROM (SELECT date_trunc('hour', ts) + to_minutes(CAST((minute(ts) // 30) * 30 AS BIGINT)) AS window_start,
             value, {_daypart('hour(ts)')} AS daypart
      FROM events) x
GROUP BY 1, 2, 3"""
    return q
