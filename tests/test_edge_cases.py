"""Edge cases: DATE marks, folder sources, NULL timestamps and dates."""

import datetime as dt

from pyspark.sql import functions as F

from caldim.functions import timeofday as tod
from caldim.operators import facts
from caldim.operators.dimension import check_and_position
from caldim.operators.time_of_day import with_time_of_day
from caldim.sources.logs import LogTables
from caldim.sources.spine import fact_date_span
from caldim.sources.tables import read_table
from conftest import SF001


def test_incremental_load_on_a_date_column(spark, scratch):
    logs = LogTables(spark, scratch)
    src = read_table(spark, SF001, "orders", "o_orderkey", "o_orderdate").withColumn("d", F.to_date("o_orderdate"))
    n1, h1, _ = facts.incremental_load(spark, logs, src, "d", f"{scratch}/o", "orders", upper=dt.datetime(1998, 1, 1))
    n2, h2, _ = facts.incremental_load(spark, logs, src, "d", f"{scratch}/o", "orders")
    assert n1 + n2 == src.count() and h1 == dt.datetime(1998, 1, 1)
    assert logs.last_process_date("orders") == h2 > dt.datetime(2001, 8, 1)


def test_stream_over_a_folder_named_like_a_file(spark, scratch):
    from caldim.streaming.daypart_stream import read_latest, start_daypart_stream

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.repartition(3).write.parquet(f"{scratch}/events.parquet")
    q = start_daypart_stream(spark, f"{scratch}/events.parquet", f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination()
    assert read_latest(spark, f"{scratch}/out").agg(F.sum("events")).first()[0] == ev.count()


def test_null_timestamps_give_null_time_of_day_on_both_paths(spark):
    ev = read_table(spark, SF001, "events", "event_id", "ts").withColumn(
        "ts", F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("ts"))
    )
    by_expr = tod.with_time_of_day(ev, "ts")
    by_join = with_time_of_day(ev, "ts")
    assert by_expr.exceptAll(by_join).count() == 0
    nulls = by_join.where(F.col("ts").isNull())
    assert nulls.count() == ev.where(F.col("ts").isNull()).count() > 0
    assert nulls.where(F.col("serving_time").isNotNull() | F.col("interval_05_min").isNotNull()).count() == 0


def test_null_calendar_date_is_not_a_duplicate(spark, fin):
    with_null = fin.unionByName(fin.limit(1).withColumn("calendar_date", F.lit(None).cast("date")))
    pos = check_and_position(with_null, dt.date(1998, 7, 15))
    assert (pos.fin_year, pos.fin_quarter, pos.fin_period, pos.fin_week) == (1999, 1, 1, 3)


def test_span_of_text_and_zoned_columns(spark):
    o = read_table(spark, SF001, "orders", "o_orderdate")
    as_text = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    zoned = o.select(F.col("o_orderdate").cast("timestamp").alias("d"))
    assert fact_date_span([(as_text, "d")]) == fact_date_span([(o, "o_orderdate")]) == fact_date_span([(zoned, "d")])
    assert fact_date_span([(o, "o_orderdate")], whole_years=False) == (dt.date(1995, 1, 1), dt.date(2001, 8, 2))


def test_profiles_keep_rows_without_time(spark):
    ev = read_table(spark, SF001, "events", "event_id", "ts").withColumn(
        "ts", F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("ts"))
    )
    n_null = ev.where(F.col("ts").isNull()).count()
    parts = {r["daypart"]: r["rows"] for r in facts.daypart_profile(spark, ev, "ts", {}).collect()}
    assert parts[None] == n_null and sum(parts.values()) == ev.count() and len(parts) == 7
    iv = facts.interval_profile(spark, ev, "ts", 60, {})
    assert iv.count() == 25 and iv.agg(F.sum("rows")).first()[0] == ev.count()


def test_stream_source_given_as_a_relative_file(spark, scratch):
    import os

    from caldim.sources.store import single_file

    rel = os.path.relpath(f"{SF001}/events.parquet")  # relative to the (shared) working folder
    full = f"file:{SF001}/events.parquet"
    assert single_file(spark, rel) == single_file(spark, "./" + rel) == single_file(spark, full) == full
    assert single_file(spark, SF001) is None and single_file(spark, f"{SF001}/*.parquet") is None
    assert single_file(spark, f"{SF001}/missing.parquet") is None


def test_reading_an_uncommitted_version_fails(spark, scratch):
    import pytest

    from caldim.sources.store import VersionedTable

    t = VersionedTable(spark, f"{scratch}/t")
    t.write(spark.range(2))
    with pytest.raises(FileNotFoundError):
        t.read(7)


def test_empty_increment_returns_the_previous_mark(spark, scratch):
    logs = LogTables(spark, scratch)
    src = read_table(spark, SF001, "orders", "o_orderkey", "o_orderdate")
    _, h1, _ = facts.incremental_load(spark, logs, src, "o_orderdate", f"{scratch}/o", "orders")
    n2, h2, _ = facts.incremental_load(spark, logs, src, "o_orderdate", f"{scratch}/o", "orders")
    assert n2 == 0 and h2 == h1 == logs.last_process_date("orders")


def test_span_accepts_any_column_case(spark):
    o = read_table(spark, SF001, "orders", "o_orderdate")
    assert fact_date_span([(o, "O_ORDERDATE")]) == fact_date_span([(o, "o_orderdate")])


def test_default_roll_as_of_is_yesterday_in_the_business_zone():
    from zoneinfo import ZoneInfo

    from caldim.operators.dimension import default_roll_as_of

    for zone in ("Pacific/Auckland", "UTC", "America/Los_Angeles"):
        today = dt.datetime.now(ZoneInfo(zone)).date()
        assert default_roll_as_of(zone) in (today - dt.timedelta(days=1), today)  # midnight may pass mid-test
