"""Physical-plan properties the jobs rely on at scale."""


from pyspark.sql import functions as F

from caldim.functions import calendar as cal
from caldim.functions import timeofday as tod
from caldim.plans import catalog
from caldim.sources.tables import read_table
from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_date_range_and_prunes_columns(spark):
    p = _plan(catalog.orders_period_to_date_q(spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert p.count("Exchange hashpartitioning") == 1  # only the final aggregate shuffles


def test_expression_enrichment_has_no_shuffle_or_join(spark):
    li = read_table(spark, SF001, "lineitem", "l_orderkey", "l_shipdate")
    ev = read_table(spark, SF001, "events", "event_id", "ts")
    for df in (cal.with_date_attributes(li, "l_shipdate"), tod.with_time_of_day(ev, "ts")):
        p = _plan(df)
        assert "Exchange" not in p and "Join" not in p and "PythonUDF" not in p and "ArrowEval" not in p


def test_rollups_aggregate_partially_before_the_shuffle(spark):
    for q in (catalog.lineitem_calendar_rollup_q, catalog.events_daypart_q, catalog.orders_by_fin_period_q):
        p = _plan(q(spark, SF001))
        assert "partial_" in p and "SortMergeJoin" not in p


def test_dimension_builds_from_range_without_shuffle(spark):
    p = _plan(catalog.date_dim_q(spark, SF001))
    assert "Range" in p and "Exchange hashpartitioning" not in p and "Window" not in p


def test_no_python_udf_anywhere(spark):
    for name, q in catalog.QUERIES.items():
        if name in ("audit_log", "error_log", "process_date_increment", "events_stream_daypart",
                    "procedures_generate_roll", "merge_initial_load", "procedure_audit", "fin_calendar_scan",
                    "time_of_day_ctas"):
            continue  # these run side effects when built
        p = _plan(q(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_as_of_lookup_on_a_stored_dimension_is_pushed_down(spark, fin, scratch):
    import datetime as dt

    from pyspark.sql import functions as F

    from caldim.operators.dimension import generate_date_dim
    from caldim.sources.store import VersionedTable
    from conftest import END, START

    t = VersionedTable(spark, f"{scratch}/dim_date")
    t.write(generate_date_dim(spark, START, END, fin, dt.date(1998, 7, 14)))
    q = t.read().where(F.col("calendar_date") == F.lit(dt.date(1998, 7, 15))).select("fin_year", "fin_period")
    p = _plan(q)
    assert "PushedFilters: [IsNotNull(calendar_date), EqualTo(calendar_date,1998-07-15)]" in p
    assert "ReadSchema: struct<calendar_date:date,fin_period:string,fin_year:string>" in p


def test_profiles_scan_the_fact_once(spark):
    for q in (catalog.events_daypart_q, catalog.events_interval_profile_q):
        p = _plan(q(spark, SF001))
        assert p.count("Scan parquet") == 1, p  # also matches "FileScan parquet"
        assert "Join" not in p


def test_each_fact_table_is_scanned_once(spark):
    import re

    side_effects = ("audit_log", "error_log", "process_date_increment", "events_stream_daypart",
                    "procedures_generate_roll", "merge_initial_load", "procedure_audit", "fin_calendar_scan",
                    "time_of_day_ctas")
    for name, q in catalog.QUERIES.items():
        if name in side_effects:
            continue
        p = _plan(q(spark, SF001))
        tables = re.findall(r"sf0\.01/(\w+)\.parquet", p)
        assert len(tables) == len(set(tables)), (name, tables)


def test_fact_queries_do_not_scan_facts_for_the_span(spark, monkeypatch):
    """Queries that join facts to the dimension take its span as a parameter."""
    def no_scan(*_):
        raise AssertionError("a fact was scanned for its dates")

    monkeypatch.setattr(catalog, "fact_date_span", no_scan)
    for q in (catalog.orders_period_to_date_q, catalog.orders_by_fin_period_q, catalog.orders_fiscal_attributes_q,
              catalog.orders_by_week_wtd_sql_q, catalog.lineitem_by_week_status_q, catalog.lineitem_date_attributes_q):
        q(spark, SF001)


def test_week_wtd_sql_pushes_the_range_and_shuffles_daily_totals_only(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(catalog.orders_by_week_wtd_sql_q(spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "GreaterThanOrEqual(o_orderdate" in p and "BroadcastHashJoin" in p
    scan = p[: p.index("FileScan parquet")]
    assert "partial_sum" in scan[scan.rindex("Exchange"):]  # the fact's shuffle carries partial sums


def test_fiscal_columns_are_computed_per_day(spark):
    p = _plan(catalog.orders_fiscal_attributes_q(spark, SF001))
    above = p[: p.index("BroadcastHashJoin")]
    assert "BroadcastHashJoin" in p and "substring" not in above and "concat" not in above


def test_date_partitioned_fact_is_pruned(spark, scratch):
    import datetime as dt

    from pyspark.sql import functions as F

    from caldim.operators import facts
    from caldim.operators.dimension import generate_date_dim, roll_date_dim
    from caldim.sources.fincal import formula_financial_calendar
    from caldim.sources.spine import date_spine
    from conftest import SF0001

    o = spark.read.parquet(f"{SF0001}/orders.parquet").withColumn("d", F.to_date("o_orderdate"))
    o.write.partitionBy("d").parquet(f"{scratch}/orders_by_day")
    po = spark.read.parquet(f"{scratch}/orders_by_day")
    start, end = dt.date(1994, 1, 1), dt.date(2002, 1, 1)
    fin = formula_financial_calendar(date_spine(spark, start, end))
    dim = roll_date_dim(generate_date_dim(spark, start, end, fin, dt.date(1998, 7, 14)), dt.date(1998, 7, 15))
    out = facts.period_to_date(po, "d", {}, dim)
    # scan metadata is cut at spark.sql.maxMetadataStringLength (100 chars by default)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = _plan(out)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "PartitionFilters: [isnotnull(d" in p and "(d#" in p and "dynamicpruningexpression" in p
    assert out.first()["ytd_rows"] == o.where((F.col("d") >= "1998-01-01") & (F.col("d") <= "1998-07-15")).count()
