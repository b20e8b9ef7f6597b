"""Registered queries: each takes (spark, table folder) and returns a
DataFrame over the given tables or data Spark derives from them.

Queries of the dimension itself cover whole calendar years around every order
and ship date (span read from ``orders`` and ``lineitem``). Queries that apply
it to facts take START and END as parameters, as the generate procedure does,
so no fact is scanned to find the span; rows outside it follow the star-join
rule (no attributes), and ``dim_quality_checks`` is the query that looks for
them. The financial calendar is built over the same span from the public 4-4-5
rule in ``caldim.sources.fincal``. As-of dates and load times are fixed parameters,
so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim import schemas
from caldim.functions import asof
from caldim.functions import calendar as cal
from caldim.functions import fiscal as fis
from caldim.functions import timeofday as tod
from caldim.operators import dimension as dim_ops
from caldim.operators import facts
from caldim.operators import views
from caldim.operators.steps import (
    build_time_of_day_procedure,
    generate_dim_date_procedure,
    roll_dim_date_procedure,
    run_step,
)
from caldim.operators.time_of_day import time_of_day_dim, with_time_of_day
from caldim.session import work_dir
from caldim.sources.fincal import formula_financial_calendar, read_financial_calendar
from caldim.sources.logs import LogTables
from caldim.sources.spine import date_spine, fact_date_span, span_is_broadcastable
from caldim.sources.store import VersionedTable
from caldim.sources.tables import read_table, table_path

# Parameters of the registered queries.
AS_OF = dt.date(1998, 7, 15)
PRIOR_AS_OF = dt.date(1998, 6, 28)  # another financial year, quarter and period than AS_OF
START, END = dt.date(1992, 1, 1), dt.date(2003, 1, 1)  # of the dimension that facts are joined to
TS_TARGET = dt.datetime(1998, 7, 14, 3, 0, 0)
TS_MERGE = dt.datetime(1998, 7, 15, 3, 0, 0)
HWM_FIRST_LOAD = dt.datetime(1998, 7, 15, 0, 0, 0)
HWM_LAST_LOAD = dt.datetime(2003, 1, 1, 0, 0, 0)
STEP_PROCEDURE = "CALDIM_CHECKS"


DATE_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


class Inputs:
    """Span, spine and financial calendar: of the given span, or of one read
    from the dates of both fact tables of a folder."""

    def __init__(self, spark: SparkSession, base: str, span: tuple[dt.date, dt.date] | None = None):
        self.spark, self.base = spark, base
        self.start, self.end = span or fact_date_span(
            [(read_table(spark, base, t, c), c) for t, c in DATE_COLUMNS.items()]
        )
        self.fin = formula_financial_calendar(date_spine(self.spark, self.start, self.end))
        self._positions: dict[dt.date, asof.Position] = {}

    def position(self, as_of: dt.date, *others: dt.date) -> asof.Position:
        """Financial position of an as-of date; one job for it and ``others``,
        which also checks the calendar."""
        if as_of not in self._positions:
            self._positions |= dim_ops.check_and_positions(self.fin, [as_of, *others])
        return self._positions[as_of]

    @property
    def split_years(self) -> tuple[dt.date, dt.date]:
        """(end of the merge target, start of the merge stage): the target
        holds the first half of the years, the stage the second half, and
        they overlap by one year."""
        y0, y1 = self.start.year, self.end.year - 1
        ym = (y0 + y1) // 2
        return dt.date(ym + 1, 1, 1), dt.date(ym, 1, 1)

    def stage(self, start, end, as_of, variant, ts) -> DataFrame:
        return dim_ops.stage_date(
            self.spark, start, end, self.fin, as_of, variant=variant, load_ts=ts, position=self.position(as_of), check_unique=False
        )

    def dim(self, as_of=AS_OF, variant="roll", ts=TS_MERGE) -> DataFrame:
        return dim_ops.insert_rows(self.stage(self.start, self.end, as_of, variant, ts), ts)


def date_spine_q(spark, base):
    """One row per day of the span, END excluded."""
    i = Inputs(spark, base)
    return date_spine(spark, i.start, i.end)


def calendar_columns_q(spark, base):
    """Section 2.6 rows 1-7, 9-24: date_key and the calendar columns of every day."""
    i = Inputs(spark, base)
    return dim_ops.calendar_dim(spark, i.start, i.end)


def fiscal_columns_q(spark, base):
    """Section 2.6 rows 25-32: financial columns (J1 join to the financial calendar)."""
    i = Inputs(spark, base)
    return i.dim().select("calendar_date", *schemas.FISCAL_COLUMNS)


def day_status_q(spark, base):
    """Section 2.6 row 8: day status, roll variant, as of AS_OF."""
    return Inputs(spark, base).dim().select("calendar_date", "day_status")


def fin_statuses_q(spark, base):
    """Section 2.6 rows 33-36: financial year/quarter/period/week statuses (J3 position)."""
    return Inputs(spark, base).dim().select("calendar_date", *schemas.ASOF_COLUMNS[:4])


def cal_to_date_flags_q(spark, base):
    """Section 2.6 rows 37-41: week/month/period/quarter/year to date flags."""
    return Inputs(spark, base).dim().select("calendar_date", *schemas.ASOF_COLUMNS[4:9])


def prev_to_date_flags_q(spark, base):
    """Section 2.6 rows 42-46: previous-week and previous-year to date flags."""
    return Inputs(spark, base).dim().select("calendar_date", *schemas.ASOF_COLUMNS[9:])


def prev_yr_wtd_generate_variant_q(spark, base):
    """Generate-variant rules (no '2 Days Ago', 4 week labels, open-ended year-ago week)."""
    d = Inputs(spark, base).dim(variant="generate")
    return d.select("calendar_date", "day_status", "fin_week_status", "previous_yr_cal_wtd")


def date_dim_q(spark, base):
    """The generated 47-column dimension (initial load)."""
    return Inputs(spark, base).dim()


def date_dim_generate_q(spark, base):
    """The whole dimension in the generate variant of the as-of rules."""
    return Inputs(spark, base).dim(variant="generate")


def lineitem_by_week_status_q(spark, base):
    """Line items and revenue per financial-week status label (Current Week,
    Previous Week, ... of the rolled dimension): daily totals first, then
    one broadcast join of at most one row per day."""
    i = Inputs(spark, base, (START, END))
    li = read_table(spark, base, "lineitem", "l_shipdate", "l_extendedprice", "l_discount")
    revenue = _money("l_extendedprice") * (F.lit(1) - _money("l_discount"))
    daily = facts.daily_totals(li, "l_shipdate", {"revenue": revenue})
    status = i.dim().select(F.col("calendar_date").alias("_d"), "fin_week_status")
    j = daily.join(F.broadcast(status) if span_is_broadcastable(i.start, i.end) else status, "_d", "left")
    return j.groupBy("fin_week_status").agg(
        F.sum("rows").alias("n_rows"), F.sum("revenue").cast("double").alias("revenue")
    )


def orders_by_week_wtd_sql_q(spark, base):
    """Orders per "Financial Week WTD" label through the business view
    ``date``, in Spark SQL (the views are published as temp views of this
    query's own). Orders are cut to the labelled dates at the scan and reduced
    to daily totals before the view, of one row per day, is joined: only
    partial totals are shuffled, whatever the join strategy."""
    i = Inputs(spark, base, (START, END))
    dim = i.dim()
    lo, hi = facts.flagged_span(dim, [c for c, _ in views.WEEK_WTD_LABELS])
    own = _own_views()
    views.register_views(spark, dim=dim, suffix=own)
    orders = read_table(spark, base, "orders", "o_orderdate", "o_totalprice")
    orders.where(facts.date_range_filter("o_orderdate", lo, hi)).createOrReplaceTempView(f"orders{own}")
    hint = "/*+ BROADCAST(d) */" if span_is_broadcastable(i.start, i.end) else ""
    return spark.sql(
        f"""
        WITH daily AS (
          SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS sales
          FROM orders{own} GROUP BY CAST(o_orderdate AS DATE))
        SELECT {hint} d.`Financial Week WTD` AS week_wtd, sum(o.n) AS n_rows, CAST(sum(o.sales) AS DOUBLE) AS sales
        FROM daily o JOIN date{own} d ON d.`Calendar Date` = o.day
        WHERE d.`Financial Week WTD` IS NOT NULL
        GROUP BY d.`Financial Week WTD`
        """
    )


def _own_views() -> str:
    """A suffix for temp views that nobody else has."""
    return f"_{uuid.uuid4().hex}"


def date_view_q(spark, base):
    """The business view `date`, 46 renames plus 'Financial Week WTD'."""
    return views.date_view(Inputs(spark, base).dim())


def _merge_target(i: Inputs) -> DataFrame:
    target_end, _ = i.split_years
    return dim_ops.insert_rows(i.stage(i.start, target_end, PRIOR_AS_OF, "generate", TS_TARGET), TS_TARGET)


def merge_upsert_q(spark, base):
    """Stage the second half of the years as of AS_OF and merge it into a
    target holding the first half as of the day before (one year overlaps)."""
    i = Inputs(spark, base)
    _, stage_start = i.split_years
    position = i.position(AS_OF, PRIOR_AS_OF)
    return dim_ops.generate_date_dim(
        spark, stage_start, i.end, i.fin, AS_OF, target=_merge_target(i), load_ts=TS_MERGE, position=position
    )


def merge_initial_load_q(spark, base):
    """The generate procedure with INITIAL_LOAD over a committed target: the
    target's rows are gone from the version read back."""
    i = Inputs(spark, base)
    _, stage_start = i.split_years
    table, logs = _tables(spark, "initial")
    table.write(_merge_target(i))
    generate_dim_date_procedure(
        spark, table, logs, stage_start, i.end, i.fin, AS_OF, initial_load=True, load_ts=TS_MERGE
    )
    return table.read()


def _tables(spark, name) -> tuple[VersionedTable, LogTables]:
    root = work_dir(spark, name)
    return VersionedTable(spark, f"{root}/dim_date"), LogTables(spark, f"{root}/logs")


def procedure_audit_q(spark, base):
    """All audit rows of an initial load of the first half of the
    years, a generate of the second half that overlaps it, and a roll."""
    i = Inputs(spark, base)
    target_end, stage_start = i.split_years
    table, logs = _tables(spark, "audit")
    generate_dim_date_procedure(
        spark, table, logs, i.start, target_end, i.fin, PRIOR_AS_OF, initial_load=True, load_ts=TS_TARGET
    )
    generate_dim_date_procedure(spark, table, logs, stage_start, i.end, i.fin, PRIOR_AS_OF, load_ts=TS_MERGE)
    roll_dim_date_procedure(spark, table, logs, as_of=AS_OF, load_ts=TS_MERGE)
    return logs.audit()


def fin_calendar_scan_q(spark, base):
    """S3: the financial calendar of the span written as csv and as parquet,
    each read back by name with its declared schema."""
    fin, root = Inputs(spark, base).fin, work_dir(spark, "fincal")
    turned = fin.select(*reversed(fin.columns))  # columns are matched by name, not by place
    turned.write.option("header", "true").csv(f"{root}/csv")
    turned.write.parquet(f"{root}/parquet")
    parts = [
        read_financial_calendar(spark, f"{root}/{fmt}", fmt).withColumn("file_format", F.lit(fmt))
        for fmt in ("csv", "parquet")
    ]
    return parts[0].unionByName(parts[1])


def time_of_day_ctas_q(spark, base):
    """The time-of-day dimension committed by its procedure and read
    back, LAST_UPDATE_DATE included, with the events of each second."""
    root = work_dir(spark, "ctas")
    table = VersionedTable(spark, f"{root}/dim_time_of_day")
    build_time_of_day_procedure(spark, table, LogTables(spark, f"{root}/logs"), load_ts=TS_MERGE)
    return _with_event_counts(spark, base, table.read())


def roll_dim_q(spark, base):
    """A dimension generated as of the day before, rolled to AS_OF."""
    i = Inputs(spark, base)
    generated = i.dim(as_of=PRIOR_AS_OF, variant="generate", ts=TS_TARGET)
    return dim_ops.roll_date_dim(generated, AS_OF, load_ts=TS_MERGE)


def procedures_generate_roll_q(spark, base):
    """End to end: the generate procedure (initial load, as of an earlier
    date) and the roll procedure (as of AS_OF) commit two versions of a
    versioned table in the work folder; the current version is read back."""
    i = Inputs(spark, base)
    table, logs = _tables(spark, "procedures")
    generate_dim_date_procedure(
        spark, table, logs, i.start, i.end, i.fin, PRIOR_AS_OF, initial_load=True, load_ts=TS_TARGET
    )
    roll_dim_date_procedure(spark, table, logs, as_of=AS_OF, load_ts=TS_MERGE)
    return table.read()


def _events(spark, base, *cols):
    return read_table(spark, base, "events", *cols)


def _money(c: str):
    return F.col(c).cast("decimal(18,2)")


def events_time_of_day_q(spark, base):
    """X4/section 2.7: every event with its time-of-day columns (broadcast join)."""
    ev = _events(spark, base, "event_id", "ts")
    return with_time_of_day(ev, "ts", load_ts=TS_MERGE).drop("ts")


def time_of_day_event_counts_q(spark, base):
    """Every second of the day (the whole dimension) with its event count."""
    return _with_event_counts(spark, base, time_of_day_dim(spark, TS_MERGE).drop("last_update_date"))


def _with_event_counts(spark, base, dim):
    per_second = (
        _events(spark, base, "ts")
        .groupBy((tod.second_of_day(F.col("ts")) + 1).alias("time_of_day_key"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    # per_second has at most 86 400 rows: a proven bound
    out = dim.join(F.broadcast(per_second), "time_of_day_key", "left")
    return out.withColumn("event_count", F.coalesce(F.col("event_count"), F.lit(0).cast("long")))


def time_of_day_view_q(spark, base):
    """Events per daypart and hour through the business view: events are
    counted per dimension key first (at most 86 400 rows), which then meet
    the view (exactly 86 400 rows: broadcast) and are summed per label."""
    view = views.time_of_day_view(time_of_day_dim(spark, TS_MERGE))
    per_key = (
        _events(spark, base, "ts")
        .groupBy(tod.time_key(tod.second_of_day(F.col("ts"))).alias("Time Of Day Key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_key.join(F.broadcast(view), "Time Of Day Key", "left")
        .groupBy("Day-Part", "Interval 01 Hour")
        .agg(F.sum("n").alias("Events"))
    )


def events_by_daypart_sql_q(spark, base):
    """Events per daypart and half hour in Spark SQL through the business
    view ``time_of_day``: events are counted per dimension key first (at most
    86 400 rows), then meet the view (exactly 86 400 rows: broadcast). Events
    without a time keep a row of their own, without labels, as in X5."""
    own = _own_views()
    views.register_views(spark, tod=time_of_day_dim(spark, TS_MERGE), suffix=own)
    read_table(spark, base, "events", "ts", "value").createOrReplaceTempView(f"events{own}")
    return spark.sql(
        f"""
        WITH per_key AS (
          SELECT hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1 AS key,
                 count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS value_sum
          FROM events{own} GROUP BY 1)
        SELECT /*+ BROADCAST(t) */
               t.`Day-Part` AS day_part,
               t.`Interval 30 Min` AS interval_30_min,
               sum(e.n) AS n_rows,
               CAST(sum(e.value_sum) AS DOUBLE) AS value_sum
        FROM per_key e
        LEFT JOIN time_of_day{own} t ON t.`Time Of Day Key` = e.key
        GROUP BY t.`Day-Part`, t.`Interval 30 Min`
        """
    )


def events_daypart_q(spark, base):
    """Events and value per daypart, every daypart present."""
    ev = _events(spark, base, "ts", "value")
    out = facts.daypart_profile(spark, ev, "ts", {"value_sum": _money("value")})
    return out.select("daypart", F.col("rows").alias("n_rows"), F.col("value_sum").cast("double"))


def events_interval_profile_q(spark, base):
    """Events and value per five-minute interval, empty intervals as zero rows."""
    ev = _events(spark, base, "ts", "value")
    out = facts.interval_profile(spark, ev, "ts", 5, {"value_sum": _money("value")})
    return out.select("interval", F.col("rows").alias("n_rows"), F.col("value_sum").cast("double"))


def orders_period_to_date_q(spark, base):
    """X3 (flagship): to-date counts and sales per order priority, as of AS_OF."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    out = facts.period_to_date(orders, "o_orderdate", {"sales": _money("o_totalprice")}, i.dim(), by=["o_orderpriority"])
    return out.select(
        "o_orderpriority", *[F.col(c).cast("double") if c.endswith("_sales") else F.col(c) for c in out.columns[1:]]
    )


def orders_by_fin_period_q(spark, base):
    """Orders and sales per financial year and period."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderdate", "o_totalprice")
    dim_ops.assert_unique_dates(i.fin)
    out = facts.by_fiscal_period(
        orders, "o_orderdate", i.fin, {"sales": _money("o_totalprice")}, True, fin_span=(i.start, i.end)
    )
    return out.select("fin_year", "fin_period", F.col("rows").alias("n_rows"), F.col("sales").cast("double"))


def orders_fiscal_attributes_q(spark, base):
    """Every order with its financial columns."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderkey", "o_orderdate")
    dim_ops.assert_unique_dates(i.fin)
    out = fis.with_fiscal_attributes(orders, "o_orderdate", i.fin, span_is_broadcastable(i.start, i.end))
    return out.drop("o_orderdate")


def lineitem_calendar_rollup_q(spark, base):
    """Line items, quantity and revenue per calendar year, quarter and month."""
    li = read_table(spark, base, "lineitem", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount")
    revenue = _money("l_extendedprice") * (F.lit(1) - _money("l_discount"))
    out = facts.calendar_rollup(
        li, "l_shipdate", {"sum_qty": _money("l_quantity"), "revenue": revenue}, ["cal_year", "cal_quarter", "month"]
    )
    return out.select(
        "cal_year", "cal_quarter", "month", F.col("rows").alias("n_rows"),
        F.col("sum_qty").cast("double"), F.col("revenue").cast("double"),
    )


def lineitem_date_attributes_q(spark, base):
    """Calendar columns of every line item by a broadcast join to a calendar
    dimension over START to END."""
    i = Inputs(spark, base, (START, END))
    li = read_table(spark, base, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    dim = dim_ops.calendar_dim(spark, i.start, i.end)
    return facts.with_calendar_attributes(li, "l_shipdate", dim, span_is_broadcastable(i.start, i.end)).drop(
        "l_shipdate"
    )


def dim_quality_checks_q(spark, base):
    """The checks of a sound dimension, and of one that is damaged by what
    the facts hold: the year after the first order is missing, the last order's
    day occurs twice, and the financial calendar ends before the last ship date.
    Each fact is read once, into its rows by day; span, damage and checks follow
    from these."""
    fact_dates = [(read_table(spark, base, t, c), c) for t, c in DATE_COLUMNS.items()]
    path = work_dir(spark, "fact-days")
    facts.fact_days(fact_dates).write.parquet(path)
    days = spark.read.parquet(path)
    spans = {r["source"]: (r["a"], r["e"]) for r in days.groupBy("source").agg(F.min("d").alias("a"), F.max("d").alias("e")).collect()}
    first, last = min(a for a, _ in spans.values()), max(e for _, e in spans.values())
    i = Inputs(spark, base, (dt.date(first.year, 1, 1), dt.date(last.year + 1, 1, 1)))
    sound = i.dim().select("calendar_date")
    (first_order, last_order), (_, last_shipped) = (spans[c] for c in DATE_COLUMNS.values())
    damaged = sound.where(F.year("calendar_date") != first_order.year + 1)
    damaged = damaged.unionByName(sound.where(F.col("calendar_date") == F.lit(last_order)))
    shorter = i.fin.where(F.col("calendar_date") < F.lit(last_shipped))
    checks = [facts.dimension_checks(d, f, fact_dates, days) for d, f in ((sound, i.fin), (damaged, shorter))]
    names = ("sound", "damaged")
    parts = [c.select(F.lit(n).alias("dimension"), "*") for n, c in zip(names, checks, strict=True)]
    return parts[0].unionByName(parts[1])


def audit_log_q(spark, base):
    """Logged steps over the tables, SQL text and DataFrames, and the resulting audit rows."""
    logs = LogTables(spark, work_dir(spark, "logs"))
    own = _own_views()
    read_table(spark, base, "lineitem", "l_orderkey").createOrReplaceTempView(f"lineitem{own}")
    od = read_table(spark, base, "orders", "o_orderkey")
    kw = dict(ts=TS_MERGE)
    run_step(spark, logs, STEP_PROCEDURE, "count lineitem", f"SELECT count(*) AS row_count FROM lineitem{own}", **kw)
    run_step(spark, logs, STEP_PROCEDURE, "count orders", od.agg(F.count(F.lit(1)).alias("row_count")), **kw)
    first = f"SELECT l_orderkey AS first_order FROM lineitem{own} ORDER BY l_orderkey"
    run_step(spark, logs, STEP_PROCEDURE, "first order", first, **kw)
    return logs.audit()


def error_log_q(spark, base):
    """Steps that fail on the data (ANSI casts), of SQL text and of
    a DataFrame, one of them only in the last row of a sorted result; the
    resulting error rows, of the message the offending value."""
    logs = LogTables(spark, work_dir(spark, "logs"))
    own = _own_views()
    od = read_table(spark, base, "orders", "o_orderkey", "o_orderpriority")
    od.createOrReplaceTempView(f"orders{own}")
    bad = od.agg(F.max("o_orderpriority").cast("int").alias("last_priority"))
    run_step(spark, logs, STEP_PROCEDURE, "cast priority", bad, ts=TS_MERGE)
    late = f"""
        SELECT CAST(IF(o_orderkey = (SELECT max(o_orderkey) FROM orders{own}), 'last', '1') AS INT) AS v
        FROM orders{own} ORDER BY o_orderkey"""
    run_step(spark, logs, STEP_PROCEDURE, "cast last row", late, ts=TS_MERGE)
    value = F.regexp_extract("error_message", r"The value (\S+) of the type", 1)
    columns = ["error_key", "procedure_name", "sql_step", "error_code", "error_state", "error_timestamp"]
    return logs.errors().select(*columns, value.alias("bad_value"))


def process_date_increment_q(spark, base):
    """Incremental loads of orders by half-open intervals. The first
    stops within the data; of the next day a part arrives late, after a load of
    another schema; the last load takes it. The process-date rows, and the rows
    that lie in the target."""
    root = work_dir(spark, "incr")
    logs = LogTables(spark, root)
    src = read_table(spark, base, "orders", "o_orderkey", "o_orderdate")
    day = F.lit(HWM_FIRST_LOAD.isoformat(" ")).cast("timestamp_ntz")
    on_time = src.where((F.col("o_orderdate") != day) | (F.col("o_orderkey") % 2 == 0))
    kw = dict(table_name="orders", country="NZ", load_ts=TS_MERGE)
    here, there = f"{root}/orders", f"{root}/other"
    facts.incremental_load(spark, logs, on_time, "o_orderdate", here, schema_name="tpch", upper=HWM_FIRST_LOAD, **kw)
    facts.incremental_load(spark, logs, on_time, "o_orderdate", there, schema_name="other", upper=HWM_LAST_LOAD, **kw)
    facts.incremental_load(spark, logs, src, "o_orderdate", here, schema_name="tpch", upper=HWM_LAST_LOAD, **kw)
    loaded = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_in_target")).withColumn("schema_name", F.lit(name))
        for name, path in (("tpch", here), ("other", there))
    ]
    totals = F.broadcast(loaded[0].unionByName(loaded[1]))
    return logs.process_dates().join(totals, "schema_name")


def events_stream_daypart_q(spark, base):
    """Events per 30-minute window and daypart by Structured Streaming."""
    from caldim.streaming.daypart_stream import read_latest, start_daypart_stream

    root = work_dir(spark, "stream")
    q = start_daypart_stream(spark, table_path(base, "events"), f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    out = read_latest(spark, f"{root}/out")
    return out.withColumn("value_sum", F.col("value_sum").cast("double"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "date_spine": date_spine_q,
    "calendar_columns": calendar_columns_q,
    "fiscal_columns": fiscal_columns_q,
    "day_status": day_status_q,
    "fin_statuses": fin_statuses_q,
    "cal_to_date_flags": cal_to_date_flags_q,
    "prev_to_date_flags": prev_to_date_flags_q,
    "prev_yr_wtd_generate_variant": prev_yr_wtd_generate_variant_q,
    "date_dim": date_dim_q,
    "date_dim_generate": date_dim_generate_q,
    "date_view": date_view_q,
    "merge_upsert": merge_upsert_q,
    "merge_initial_load": merge_initial_load_q,
    "roll_dim": roll_dim_q,
    "procedures_generate_roll": procedures_generate_roll_q,
    "procedure_audit": procedure_audit_q,
    "fin_calendar_scan": fin_calendar_scan_q,
    "time_of_day_ctas": time_of_day_ctas_q,
    "events_time_of_day": events_time_of_day_q,
    "time_of_day_event_counts": time_of_day_event_counts_q,
    "time_of_day_view": time_of_day_view_q,
    "events_daypart": events_daypart_q,
    "events_by_daypart_sql": events_by_daypart_sql_q,
    "events_interval_profile": events_interval_profile_q,
    "orders_period_to_date": orders_period_to_date_q,
    "orders_by_fin_period": orders_by_fin_period_q,
    "orders_fiscal_attributes": orders_fiscal_attributes_q,
    "lineitem_calendar_rollup": lineitem_calendar_rollup_q,
    "lineitem_date_attributes": lineitem_date_attributes_q,
    "lineitem_by_week_status": lineitem_by_week_status_q,
    "orders_by_week_wtd_sql": orders_by_week_wtd_sql_q,
    "dim_quality_checks": dim_quality_checks_q,
    "audit_log": audit_log_q,
    "error_log": error_log_q,
    "process_date_increment": process_date_increment_q,
    "events_stream_daypart": events_stream_daypart_q,
}
