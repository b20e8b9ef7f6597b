"""Registered queries over whole histories: every as-of date, versions, runs,
series, sketches and maintained rollups. As in ``catalog``, each takes (spark,
table folder) and reads the given tables whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions import fiscal as fis
from caldim.operators import bands as band_ops
from caldim.operators import effective, facts, numbering, rollups, runs
from caldim.operators.maintenance import MaintainedRollup
from caldim.operators.to_date import to_date_all_days
from caldim.plans.catalog import AS_OF, END, PRIOR_AS_OF, START, Inputs, _money
from caldim.session import work_dir
from caldim.sources.spine import date_spine
from caldim.sources.tables import read_table
from caldim.streaming import sessions

# Parameters of the registered queries.
ALL_FIRST, ALL_LAST = dt.date(1995, 1, 1), END - dt.timedelta(days=1)
RESTATED_FROM = dt.date(1998, 3, 1)  # from then on the financial year's quarters are 5-4-4 weeks
DELIVERY_DAYS = 90
MANY_CUSTOMERS, PRICE_LIMIT = 150, 250_000
MARK_1, MARK_2 = dt.date(1998, 7, 1), dt.date(2000, 1, 1)
STREAM_CUT = dt.datetime(2024, 1, 16)
LATE_BEFORE = dt.datetime(2024, 1, 10)
# Fixed values of the bands table: group (none: all), name, first minute, minute after the last.
BANDS = [
    (None, "DAY", 6 * 60, 18 * 60),
    (None, "NIGHT", 22 * 60, 6 * 60),  # over midnight
    ("click", "MORNING RUSH", 7 * 60 + 30, 9 * 60 + 15),
    ("click", "LONG LUNCH", 11 * 60, 15 * 60),
    ("purchase", "EVENING", 17 * 60 + 45, 23 * 60 + 10),
    ("error", "WHOLE DAY", 0, 24 * 60),
]


def orders_to_date_all_days_q(spark, base):
    """X3 for every as-of date at once: to-date counts and sales per order
    priority, with last week's and last year's, for each day of eight years."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    dim = i.fin.select("calendar_date", F.col("financial_year").alias("fin_year"), F.col("financial_period").alias("fin_period"))
    measures = {"sales": _money("o_totalprice")}
    out = to_date_all_days(orders, "o_orderdate", measures, dim, ["o_orderpriority"], ALL_FIRST, ALL_LAST)
    return out.select(*[F.col(c).cast("double") if c.endswith("_sales") else F.col(c) for c in out.columns])


def orders_customers_to_date_q(spark, base):
    """Measures that do not add up, for two as-of dates from one stored rollup of
    daily sketches: whether a flag's orders come from ``MANY_CUSTOMERS`` or more
    customers, and whether half of them cost less than ``PRICE_LIMIT``."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderdate", "o_orderpriority", "o_custkey", "o_totalprice")
    by = ["o_orderpriority"]
    path = work_dir(spark, "sketches")
    rollups.daily_sketches(orders, "o_orderdate", by, "o_custkey", "o_totalprice").write.parquet(path)
    sketches = spark.read.parquet(path)
    i.position(AS_OF, PRIOR_AS_OF)
    sets = [rollups.flagged_days(i.dim(as_of=a), F.lit(a)) for a in (AS_OF, PRIOR_AS_OF)]
    out = rollups.decisions(
        sketches, sets[0].unionByName(sets[1]), orders, "o_orderdate", by, "o_custkey", "o_totalprice", MANY_CUSTOMERS, PRICE_LIMIT
    )
    return out.withColumnRenamed("rows", "n_rows")


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def lineitem_numbered_q(spark, base):
    """W1, W2, S15 at fact scale: all line items numbered without gaps in the
    order of their ship dates (then by their other columns)."""
    return numbering.number_rows(read_table(spark, base, "lineitem", *LINE_ORDER), LINE_ORDER, "line_key")


def _restated(fin: DataFrame) -> DataFrame:
    """The financial calendar with 5-4-4 quarters from ``RESTATED_FROM`` on."""
    week = fis.week_no(F.col("financial_week"))
    quarter = F.col("financial_quarter")
    in_quarter = week - (quarter - 1) * 13
    period = (quarter - 1) * 3 + F.when(in_quarter <= 5, 1).when(in_quarter <= 9, 2).otherwise(3)
    text = F.concat("financial_year", F.lit("-P-"), F.lpad(period.cast("string"), 2, "0"))
    later = F.col("calendar_date") >= F.lit(RESTATED_FROM)
    return fin.withColumn("financial_period", F.when(later, text).otherwise(F.col("financial_period")))


FIN_ATTRIBUTES = ["financial_week", "financial_period", "financial_quarter", "financial_year"]


def fin_versions(spark, i: Inputs) -> DataFrame:
    """The financial calendar's versions: the first, and the restated one."""
    fin = i.fin.select("calendar_date", *FIN_ATTRIBUTES)
    first = effective.open_versions(fin, FIN_ATTRIBUTES, i.start)
    return effective.apply_snapshot(first, _restated(fin), ["calendar_date"], FIN_ATTRIBUTES, RESTATED_FROM)


def orders_effective_period_q(spark, base):
    """S7/J2 with history: each order's delivery day, ``DELIVERY_DAYS`` after the
    order, labelled by the financial calendar that was valid on the order's own day."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderkey", "o_orderdate").where("o_orderdate is not null")
    orders = orders.withColumn("delivery_date", F.date_add(F.to_date("o_orderdate"), DELIVERY_DAYS))
    columns = ["financial_period", "version", "valid_from"]
    # two versions a day at most
    versions, bound = fin_versions(spark, i), 2 * (i.end - i.start).days
    out = effective.as_of_join(orders, versions, {"delivery_date": "calendar_date"}, "o_orderdate", columns, rows=bound)
    return out.select("o_orderkey", "delivery_date", *columns)


def events_by_band_q(spark, base):
    """Section 2.7 row 9 from a table: events and value per type in bands that
    overlap, cross midnight and differ from type to type; no band: null."""
    events = read_table(spark, base, "events", "ts", "event_type", "value")
    table = spark.createDataFrame(BANDS, band_ops.BANDS)
    out = band_ops.band_totals(events, "ts", "event_type", table, {"value_sum": _money("value")})
    return out.select("event_type", "band", F.col("rows").alias("n_rows"), F.col("value_sum").cast("double"))


def customer_order_gaps_q(spark, base):
    """Runs of weeks with orders and the gaps between them, per customer."""
    orders = read_table(spark, base, "orders", "o_custkey", "o_orderdate").withColumn("week", runs.week_number(cal.as_date("o_orderdate")))
    return runs.gap_summary(runs.runs(orders, "o_custkey", "week"), "o_custkey")


def part_idle_periods_q(spark, base):
    """Financial periods without sales, per part: shipments are reduced to days
    before they meet the calendar."""
    i = Inputs(spark, base, (START, END))
    days = read_table(spark, base, "lineitem", "l_partkey", "l_shipdate").select("l_partkey", cal.as_date("l_shipdate").alias("d")).distinct()
    number = fis.year_no(F.col("financial_year")) * 12 + fis.period_no(F.col("financial_period")) - 1
    fin = F.broadcast(i.fin.select(F.col("calendar_date").alias("d"), number.alias("period")))  # a row a day of START to END
    return runs.gap_summary(runs.runs(days.join(fin, "d"), "l_partkey", "period"), "l_partkey")


def supplier_daily_balance_q(spark, base):
    """X5 over days: revenue of every day between a supplier's first and last
    shipment, zero where there was none, the running balance, and the last
    day's revenue that was not zero, carried forward."""
    items = read_table(spark, base, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice")
    daily = facts.daily_totals(items.where("l_shipdate is not null"), "l_shipdate", {"movement": _money("l_extendedprice")}, ["l_suppkey"])
    daily = daily.select("l_suppkey", F.col("_d").alias("day"), "movement")
    return runs.daily_balance(daily, "l_suppkey", "day", "movement", "double")


def _maintained(spark, base) -> MaintainedRollup:
    """Orders in three batches: closed days of the first come late with the
    second; the third takes some orders back and corrects others' prices."""
    orders = read_table(spark, base, "orders", "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    rollup = MaintainedRollup(spark, work_dir(spark, "rollup"), ["o_orderpriority"], {"sales": _money("o_totalprice")})
    insert, delete = F.lit("I").alias("op"), F.lit("D").alias("op")
    day = F.to_date("o_orderdate")
    late = (F.col("o_orderkey") % 10 == 3) & (day < F.lit(MARK_1))
    first = orders.where((day < F.lit(MARK_1)) & ~late).select("*", insert)
    second = orders.where(late | ((day >= F.lit(MARK_1)) & (day < F.lit(MARK_2)))).select("*", insert)
    known = orders.where(day < F.lit(MARK_2))
    gone, wrong = known.where("o_orderkey % 50 = 0"), known.where("o_orderkey % 50 = 1")
    right = wrong.withColumn("o_totalprice", F.col("o_totalprice") + 100)
    third = orders.where(day >= F.lit(MARK_2)).select("*", insert).unionByName(gone.unionByName(wrong).select("*", delete))
    third = third.unionByName(right.select("*", insert))
    for batch, (changes, mark) in enumerate(((first, None), (second, MARK_1), (third, MARK_2)), 1):
        rollup.apply(batch, changes, "op", "o_orderdate", mark)
    return rollup


def orders_rollup_maintained_q(spark, base):
    """X6 with changes: the daily rollup of orders after three batches of
    insertions, late rows, deletions and corrections."""
    out = _maintained(spark, base).read()
    return out.select("day", "o_orderpriority", F.col("rows").alias("n_rows"), F.col("sales").cast("double"))


def orders_rollup_batches_q(spark, base):
    """What each batch of the maintained rollup held: inserted, deleted and late
    rows, rows without a day, and days touched."""
    return _maintained(spark, base).counts()


def events_stream_sessions_q(spark, base):
    """X7 with state: sessions of users from a stream in two runs, the second a
    restart. Events come repeated, late beyond the watermark and without a time;
    the counts of each are rows of their own kind."""
    root = work_dir(spark, "sessions")
    events = read_table(spark, base, "events", "event_id", "ts", "user_id", "value")
    cut = facts.ts_bound(STREAM_CUT.date())
    first = events.where(F.col("ts") < cut)
    repeats = first.where("event_id % 10 = 0")
    second = events.where(F.col("ts") >= cut)
    late = first.where((F.col("event_id") % 20 == 0) & (F.col("ts") < facts.ts_bound(LATE_BEFORE.date())))
    late = late.withColumn("event_id", -1 - F.col("event_id"))
    timeless = second.where("event_id % 25 = 0").withColumn("ts", F.lit(None).cast("timestamp_ntz")).withColumn("event_id", -1 - F.col("event_id"))
    again = second.where("event_id % 15 = 0")
    stream = dict(source=f"{root}/in/*", schema=events.schema, out_path=f"{root}/out", checkpoint=f"{root}/checkpoint")
    for k, rows in enumerate((first.unionByName(repeats), second.unionByName(again).unionByName(late).unionByName(timeless))):
        rows.write.parquet(f"{root}/in/{k}")
        sessions.run_once(spark, f"{root}/counts", **stream)
    found = spark.read.parquet(f"{root}/out").select(
        F.lit("session").alias("kind"), "user_id", "session_start", "session_end", "events", F.col("value_sum").cast("double")
    )
    counts = spark.read.schema(sessions.COUNTS).parquet(f"{root}/counts").agg(*(F.sum(c).alias(c) for c in ("without_time", "late", "repeated")))
    counts = counts.unpivot([], ["without_time", "late", "repeated"], "kind", "events")
    nulls = {c: F.lit(None).cast(found.schema[c].dataType) for c in ("user_id", "session_start", "session_end", "value_sum")}
    return found.unionByName(counts.withColumns(nulls))


def orders_hierarchy_totals_q(spark, base):
    """X1 and X2 at every level at once: orders and sales by financial year, half,
    quarter, period and week, and by calendar year, quarter, month and day of the
    week, in one pass over daily totals."""
    i = Inputs(spark, base, (START, END))
    orders = read_table(spark, base, "orders", "o_orderdate", "o_totalprice")
    daily = facts.daily_totals(orders, "o_orderdate", {"sales": _money("o_totalprice")})
    fin = F.broadcast(i.fin.withColumnRenamed("calendar_date", "_d"))  # a row a day of START to END
    day = cal.calendar_columns(F.col("_d"))
    half = F.when(F.col("financial_quarter") <= 2, 1).when(F.col("financial_quarter") > 2, 2)
    rows = daily.join(fin, "_d", "left").select(
        F.col("financial_year").alias("fin_year"), half.alias("fin_half"), F.col("financial_quarter").alias("fin_quarter"),
        F.col("financial_period").alias("fin_period"), F.col("financial_week").alias("fin_week"),
        *(day[c].alias(c) for c in ("cal_year", "cal_quarter", "month", "day_name")), "rows", "sales",
    )
    levels = {"financial": ["fin_year", "fin_half", "fin_quarter", "fin_period", "fin_week"], "calendar": ["cal_year", "cal_quarter", "month", "day_name"]}
    out = rollups.hierarchy_totals(rows, levels, ["rows", "sales"])
    return out.withColumnRenamed("rows", "n_rows").withColumn("sales", F.col("sales").cast("double"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "orders_to_date_all_days": orders_to_date_all_days_q,
    "orders_customers_to_date": orders_customers_to_date_q,
    "lineitem_numbered": lineitem_numbered_q,
    "orders_effective_period": orders_effective_period_q,
    "events_by_band": events_by_band_q,
    "customer_order_gaps": customer_order_gaps_q,
    "part_idle_periods": part_idle_periods_q,
    "supplier_daily_balance": supplier_daily_balance_q,
    "orders_rollup_maintained": orders_rollup_maintained_q,
    "orders_rollup_batches": orders_rollup_batches_q,
    "events_stream_sessions": events_stream_sessions_q,
    "orders_hierarchy_totals": orders_hierarchy_totals_q,
}
