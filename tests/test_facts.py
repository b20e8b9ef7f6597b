"""Fact-scale jobs against FIXTURES figures and brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caldim.operators import facts
from caldim.operators.dimension import generate_date_dim, roll_date_dim
from caldim.sources.logs import LogTables
from caldim.sources.tables import read_table
from conftest import END, SF001, START
from caldim.functions import calendar as cal


@pytest.fixture(scope="module")
def dim(spark, fin):
    d = generate_date_dim(spark, START, END, fin, dt.date(1998, 7, 14))
    return roll_date_dim(d, dt.date(1998, 7, 15)).cache()


def test_orders_period_to_date_fixture(spark, dim):
    orders = read_table(spark, SF001, "orders", "o_orderdate", "o_totalprice")
    r = facts.period_to_date(orders, "o_orderdate", {"sales": F.col("o_totalprice").cast("decimal(18,2)")}, dim).first()
    got = {k: r[f"{k}_rows"] for k in facts.TO_DATE_FLAGS}
    assert got == {"wtd": 17, "mtd": 81, "ptd": 96, "qtd": 81, "ytd": 1183, "lw_wtd": 14,
                   "ly_wtd": 17, "ly_ptd": 89, "ly_qtd": 82, "ly_ytd": 1222}
    assert round(float(r["ytd_sales"]), 2) == 305014480.85


def test_period_to_date_on_a_date_column(spark, dim):
    orders = read_table(spark, SF001, "orders", "o_orderdate").select(F.to_date("o_orderdate").alias("d"))
    out = facts.period_to_date(orders, "d", {}, dim)
    assert out.first()["ytd_rows"] == 1183


def test_period_to_date_brute_force(spark, dim):
    """Same totals as a plain join of every order to the dimension."""
    orders = read_table(spark, SF001, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    m = {"sales": F.col("o_totalprice").cast("decimal(18,2)")}
    fast = facts.period_to_date(orders, "o_orderdate", m, dim, by=["o_orderpriority"])
    j = orders.join(dim, cal.as_date("o_orderdate") == F.col("calendar_date"))
    slow = j.groupBy("o_orderpriority").agg(*[
        x for k, c in facts.TO_DATE_FLAGS.items() for x in (
            F.count_if(F.col(c) == "YES").alias(f"{k}_rows"),
            F.sum(F.when(F.col(c) == "YES", m["sales"])).alias(f"{k}_sales"))])
    assert fast.exceptAll(slow.select(fast.columns)).count() == 0 and fast.count() == slow.count()


def test_fact_filter_reaches_scan(spark, dim):
    orders = read_table(spark, SF001, "orders", "o_orderdate", "o_totalprice")
    plan = facts.period_to_date(orders, "o_orderdate", {"s": F.col("o_totalprice")}, dim)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_calendar_rollup_brute_force(spark):
    li = read_table(spark, SF001, "lineitem", "l_shipdate", "l_quantity")
    out = facts.calendar_rollup(li, "l_shipdate", {"q": F.col("l_quantity").cast("decimal(18,2)")}, ["cal_year", "month"])
    assert out.agg(F.sum("rows")).first()[0] == li.count()
    r = out.where(F.col("month") == "1996-02").first()
    exp = li.where(F.date_format("l_shipdate", "yyyy-MM") == "1996-02").agg(
        F.count("*"), F.sum(F.col("l_quantity").cast("decimal(18,2)"))).first()
    assert (r["rows"], r["q"]) == (exp[0], exp[1])


def test_by_fiscal_period_sums_to_total(spark, fin):
    orders = read_table(spark, SF001, "orders", "o_orderdate")
    out = facts.by_fiscal_period(orders, "o_orderdate", fin, {}, True)
    assert out.agg(F.sum("rows")).first()[0] == orders.count()
    assert out.where(F.col("fin_year").isNull()).count() == 0


def test_period_to_date_groups_need_a_flagged_row(spark, dim):
    """Which groups appear does not depend on where the scan is cut."""
    rows = [("flagged", dt.datetime(1998, 3, 1)), ("between", dt.datetime(1997, 12, 1)), ("before", dt.datetime(1996, 1, 1)),
            ("outside", dt.datetime(2050, 1, 1)), ("none", None)]
    df = spark.createDataFrame(rows, "g string, t timestamp_ntz")
    got = {r["g"]: r["ytd_rows"] for r in facts.period_to_date(df, "t", {}, dim, by=["g"]).collect()}
    assert got == {"flagged": 1}


def _load(spark, logs, rows, path, upper, schema_name=None, country=None):
    src = spark.createDataFrame([(i, t and dt.datetime.fromisoformat(t)) for i, t in rows], "i int, t timestamp_ntz")
    upper = upper and dt.datetime.fromisoformat(upper)
    got = facts.incremental_load(spark, logs, src, "t", path, "u", schema_name, country, upper=upper)
    return got.rows, got.rows_without_time


def test_incremental_load(spark, scratch):
    logs = LogTables(spark, scratch)
    src = read_table(spark, SF001, "orders")
    day = dt.datetime(1998, 1, 1)
    a = facts.incremental_load(spark, logs, src, "o_orderdate", f"{scratch}/o", "orders", upper=day)
    b = facts.incremental_load(spark, logs, src, "o_orderdate", f"{scratch}/o", "orders")
    c = facts.incremental_load(spark, logs, src, "o_orderdate", f"{scratch}/o", "orders")
    assert a.rows == src.where(F.col("o_orderdate") < F.lit(day)).count() and a.mark == day
    assert a.rows + b.rows == src.count() and c.rows == 0 and b.rows_without_time == 0
    assert spark.read.parquet(f"{scratch}/o").count() == src.count()
    # every closed day is loaded: the mark is the midnight before the load
    assert logs.last_process_date("orders") == b.mark == c.mark > src.agg(F.max("o_orderdate")).first()[0]


def test_rows_of_the_marks_own_day_are_loaded_late(spark, scratch):
    logs, path = LogTables(spark, scratch), f"{scratch}/o"
    rows = [(1, "2020-01-01"), (2, "2020-01-02")]
    assert _load(spark, logs, rows, path, "2020-01-02") == (1, 0)
    rows += [(3, "2020-01-02"), (4, "2020-01-02T12:00:00"), (5, "2020-01-03")]
    assert _load(spark, logs, rows, path, "2020-01-03") == (3, 0)
    assert _load(spark, logs, rows, path, "2020-01-01") == (0, 0)  # behind the mark: nothing, and the mark stays
    assert _load(spark, logs, rows, path, None) == (1, 0)
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_rows_without_a_time_are_kept_and_counted(spark, scratch):
    logs, path = LogTables(spark, scratch), f"{scratch}/o"
    rows = [(1, "2020-01-01"), (2, None)]
    assert _load(spark, logs, rows, path, "2020-01-02") == (1, 1)
    assert _load(spark, logs, [*rows, (3, None)], path, "2020-01-03") == (0, 2)
    assert sorted(r["i"] for r in spark.read.parquet(f"{path}_without_time").collect()) == [2, 3]
    assert [r["step_result"] for r in logs.audit().orderBy("audit_key").collect()] == [
        "rows without t: 1", "rows without t: 2"]


def test_marks_belong_to_one_schema_and_country(spark, scratch):
    logs, rows = LogTables(spark, scratch), [(1, "2020-01-01"), (2, "2020-01-02")]
    for k, (schema_name, country) in enumerate([("A", "NZ"), (None, None), ("A", None), ("B", "NZ")]):
        assert _load(spark, logs, rows, f"{scratch}/o{k}", "2021-01-01", schema_name, country) == (2, 0)
    assert _load(spark, logs, rows, f"{scratch}/o1", "2021-01-01") == (0, 0)


def test_dimension_checks_find_faults(spark, fin, dim):
    orders = read_table(spark, SF001, "orders", "o_orderdate")
    clean = {r[0]: r[1] for r in facts.dimension_checks(dim, fin, [(orders, "o_orderdate")]).collect()}
    assert set(clean.values()) == {0}
    broken = dim.where(F.col("calendar_date") != dt.date(1996, 5, 5)).unionByName(
        dim.where(F.col("calendar_date") == dt.date(1997, 2, 2)))
    fin_part = fin.where(F.col("calendar_date") != dt.date(1999, 9, 9))
    got = {r[0]: r[1] for r in facts.dimension_checks(broken, fin_part, [(orders, "o_orderdate")]).collect()}
    assert got["duplicate_dates"] == 1 and got["missing_dates"] == 1 and got["dates_without_fin_row"] == 1
    missing_orders_day = orders.where(cal.as_date("o_orderdate") == dt.date(1996, 5, 5)).count()
    assert got["fact_dates_outside_dim:o_orderdate"] == (1 if missing_orders_day else 0)


def test_calendar_join_path_equals_expressions(spark):
    from caldim.operators.dimension import calendar_dim

    li = read_table(spark, SF001, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    by_expr = cal.with_date_attributes(li, "l_shipdate")
    by_join = facts.with_calendar_attributes(li, "l_shipdate", calendar_dim(spark, START, END), True)
    assert by_expr.columns == by_join.columns
    assert by_expr.exceptAll(by_join).count() == 0 and by_join.count() == li.count()
