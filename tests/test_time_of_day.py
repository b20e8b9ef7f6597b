"""Time-of-day dimension, its view and the fact/stream enrichment."""

import datetime as dt

from pyspark.sql import functions as F

from caldim.functions import timeofday as tod
from caldim.operators.time_of_day import time_of_day_dim
from caldim.operators.views import time_of_day_view
from caldim.sources.tables import read_table
from conftest import SF001
import pyref


def test_all_rows_match_python(spark):
    dim = time_of_day_dim(spark, dt.datetime(2020, 1, 1))
    rows = dim.drop("last_update_date").collect()
    assert len(rows) == 86_400
    for r in rows:
        assert r.asDict() == pyref.time_row(r["time_of_day_key"] - 1)


def test_fixture_rows_and_counts(spark):
    dim = time_of_day_dim(spark)
    r = {x["time_of_day_key"]: x for x in dim.where(F.col("time_of_day_key").isin(1, 60, 301, 46800, 86400)).collect()}
    assert r[1]["time_of_day_hh12"] == "12:00:00 AM" and r[1]["minute_of_day"] == 0
    assert r[60]["minute_of_day"] == 1
    assert r[301]["interval_05_min"] == "00:05:00-00:09:59"
    assert r[46800]["time_of_day_hh12"] == "12:59:59 PM" and r[46800]["serving_time"] == "LUNCH"
    assert r[86400]["minute_of_day"] == 1440 and r[86400]["interval_30_min"] == "23:30:00-23:59:59"
    parts = {x[0]: x[1] for x in dim.groupBy("serving_time").count().collect()}
    assert parts == {"OTHER": 36000, "LUNCH": 14400, "DINNER": 14400, "BREAKFAST": 7200,
                     "AFTERNOON": 7200, "LATE NIGHT": 7200}
    assert dim.groupBy("interval_05_min").count().where("count != 300").count() == 0
    assert dim.select("minute_of_day").distinct().count() == 1441


def test_view_names(spark):
    v = time_of_day_view(time_of_day_dim(spark))
    assert v.columns == ["Time Of Day Key", "Time Of Day HH24", "Time Of Day HH12", "Minute Of Day",
                         "Interval 01 Hour", "Interval 30 Min", "Interval 15 Min", "Interval 05 Min", "Day-Part"]


def test_expression_path_equals_join_path(spark):
    from caldim.operators.time_of_day import with_time_of_day

    ev = read_table(spark, SF001, "events", "event_id", "ts")
    by_expr = tod.with_time_of_day(ev, "ts")
    by_join = with_time_of_day(ev, "ts")
    assert by_expr.columns == by_join.columns
    assert by_expr.exceptAll(by_join).count() == 0 and by_join.count() == ev.count()
    plan = by_join._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_events_daypart_counts(spark):
    from caldim.operators.facts import daypart_profile

    ev = read_table(spark, SF001, "events", "ts")
    got = {r["daypart"]: r["rows"] for r in daypart_profile(spark, ev, "ts", {}).collect()}
    assert got == {"OTHER": 4116, "LUNCH": 1694, "DINNER": 1681, "BREAKFAST": 850, "AFTERNOON": 850, "LATE NIGHT": 809}


def test_interval_profile_has_zero_rows(spark):
    from caldim.operators.facts import interval_profile

    ev = read_table(spark, SF001, "events", "ts").where(F.hour("ts") < 12)
    out = interval_profile(spark, ev, "ts", 15, {})
    assert out.count() == 96
    assert out.where(F.col("rows") == 0).count() == 48
    assert out.agg(F.sum("rows")).first()[0] == ev.count()


def test_stream_equals_batch(spark, scratch):
    from caldim.streaming.daypart_stream import read_latest, start_daypart_stream

    path = f"{SF001}/events.parquet"
    q = start_daypart_stream(spark, path, f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination()
    got = read_latest(spark, f"{scratch}/out")
    ev = spark.read.parquet(path)
    batch = ev.groupBy(F.window("ts", "30 minutes").alias("w"),
                       tod.daypart(tod.second_of_day(F.col("ts"))).alias("daypart")).agg(F.count("*").alias("events"))
    batch = batch.select(F.col("w.start").alias("window_start"), "daypart", "events")
    assert got.select("window_start", "daypart", "events").exceptAll(batch).count() == 0
    assert got.agg(F.sum("events")).first()[0] == ev.count()


def test_stream_state_is_updated_in_parallel(spark, scratch):
    """The stage that updates the state has a task for each state partition."""
    from caldim.streaming.daypart_stream import start_daypart_stream

    q = start_daypart_stream(spark, f"{SF001}/events.parquet", f"{scratch}/out", f"{scratch}/ckpt")
    run = str(q.runId)
    q.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(run) for s in tracker.getJobInfo(j).stageIds]
    tasks = [i.numTasks for s in stages if (i := tracker.getStageInfo(s))]
    partitions = q.lastProgress["stateOperators"][0]["numShufflePartitions"]
    assert partitions == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1 and partitions in tasks
    batch = spark.read.parquet(f"{scratch}/out/batch_id=0")
    assert len(batch.inputFiles()) == 1


def test_stream_micro_batches_and_late_rows(spark, scratch):
    """Events arrive as three files: two in time order, then one of rows
    older than the watermark, which the stream drops (and says so)."""
    from caldim.streaming.daypart_stream import read_latest, start_daypart_stream

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src = f"{scratch}/src"
    first = ev.where(F.col("ts") < "2024-01-15")
    second = ev.where(F.col("ts") >= "2024-01-15")
    first.coalesce(1).write.parquet(f"{src}/a")
    second.coalesce(1).write.parquet(f"{src}/b")
    q = start_daypart_stream(spark, f"{src}/*", f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    got = read_latest(spark, f"{scratch}/out")
    assert got.agg(F.sum("events")).first()[0] == ev.count()
    # a late file: early-January rows again, far behind the 1-hour watermark
    first.where(F.col("ts") < "2024-01-02").coalesce(1).write.parquet(f"{src}/c")
    q = start_daypart_stream(spark, f"{src}/*", f"{scratch}/out", f"{scratch}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    again = read_latest(spark, f"{scratch}/out")
    assert again.agg(F.sum("events")).first()[0] == ev.count()  # late rows dropped, totals unchanged


def test_stream_compaction(spark, scratch):
    from caldim.sources.store import VersionedTable
    from caldim.streaming.daypart_stream import compact, read_latest, start_daypart_stream

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    spans = [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]

    def add(i):
        lo, hi = spans[i]
        ev.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.parquet(f"{src}/{i}")

    def run():
        start_daypart_stream(spark, f"{src}/*", out, ckpt, max_files_per_trigger=1).awaitTermination()

    snap = VersionedTable(spark, f"{scratch}/snapshot")
    add(0), add(1), run()
    compact(spark, out, snap)  # folds batches 0 and 1
    add(2), run()  # batch 2 arrives after the snapshot
    full = read_latest(spark, out)
    via_snapshot = read_latest(spark, out, snapshot=snap)
    assert via_snapshot.exceptAll(full).count() == 0 and via_snapshot.count() == full.count()
    assert via_snapshot.agg(F.sum("events")).first()[0] == ev.count()


def test_snapshot_read_after_batch_folders_are_gone(spark, scratch):
    from caldim.sources.store import VersionedTable
    from caldim.streaming.daypart_stream import compact, read_latest, start_daypart_stream

    ev = spark.read.parquet(f"{SF001}/events.parquet")
    out, snap = f"{scratch}/out", VersionedTable(spark, f"{scratch}/snapshot")
    start_daypart_stream(spark, f"{SF001}/events.parquet", out, f"{scratch}/ckpt").awaitTermination()
    assert compact(spark, out, snap) is not None
    assert compact(spark, out, snap) is None  # nothing new to fold
    # the batch folders removed by lifecycle rules: an empty or a missing output folder
    empty = f"{scratch}/empty_out"
    spark.range(0).write.parquet(empty)
    for where in (empty, f"{scratch}/never_written"):
        got = read_latest(spark, where, snapshot=snap)
        assert got.agg(F.sum("events")).first()[0] == ev.count()
