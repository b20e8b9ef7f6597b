"""Merge cases, versioned table, procedures and logged steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caldim import schemas
from caldim.operators.dimension import generate_date_dim, merge_dim
from caldim.operators.steps import generate_dim_date_procedure, roll_dim_date_procedure, run_step
from caldim.sources.logs import LogTables
from caldim.sources.store import VersionedTable
from conftest import END, START

TS0, TS1, TS2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 3)


def _rows(spark, data, with_key):
    """Tiny target/stage frames: all dimension columns NULL except the key,
    date_desc (x) and fin_year_status (s)."""
    from pyspark.sql import types as T

    cols = schemas.DIM_DATE_COLUMNS if with_key else schemas.STAGE_COLUMNS
    types = _types(spark)
    schema = T.StructType([T.StructField(c, types[c], True) for c in cols])
    ts = TS0 if with_key else TS1
    rows = []
    for d, x, st in data:
        r = {c: None for c in cols}
        r.update(calendar_date=d, date_desc=x, fin_year_status=st, last_update_date=ts)
        if with_key:
            r["date_key"] = 1
        rows.append(tuple(r[c] for c in cols))
    return spark.createDataFrame(rows, schema)


_TYPES = {}


def _types(spark):
    if not _TYPES:
        from caldim.sources.fincal import formula_financial_calendar
        from caldim.sources.spine import date_spine

        fin = formula_financial_calendar(date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 5)))
        d = generate_date_dim(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 5), fin, dt.date(2020, 1, 2))
        _TYPES.update({f.name: f.dataType for f in d.schema.fields})
    return _TYPES


def test_merge_cases(spark):
    d = [dt.date(2020, 1, i) for i in range(1, 5)]
    target = _rows(spark, [(d[0], "A", "Cur"), (d[1], "B", None), (d[3], None, None)], True)
    stage = _rows(spark, [(d[0], None, None), (d[2], "C", "S"), (d[3], None, "n")], False)
    out = {r["calendar_date"]: r for r in merge_dim(target, stage, TS2).collect()}
    assert len(out) == 4
    assert (out[d[0]]["date_desc"], out[d[0]]["fin_year_status"]) == ("A", "Cur")  # nothing cleared
    assert (out[d[1]]["date_desc"], out[d[1]]["fin_year_status"]) == ("B", None)  # target only, kept
    assert (out[d[2]]["date_desc"], out[d[2]]["fin_year_status"]) == ("C", "S")  # inserted
    assert (out[d[3]]["date_desc"], out[d[3]]["fin_year_status"]) == (None, "n")  # matched, all-NULL target
    assert out[d[1]]["last_update_date"] == TS0 and out[d[2]]["last_update_date"] == TS2
    assert out[d[0]]["last_update_date"] == TS1  # matched: stage load time
    assert out[d[0]]["date_key"] == 1 and out[d[2]]["date_key"] == 20200103  # key kept / assigned


def test_merge_is_idempotent(spark, fin):
    a = dt.date(1998, 7, 15)
    dim = generate_date_dim(spark, START, END, fin, a, load_ts=TS0)
    again = generate_date_dim(spark, START, END, fin, a, target=dim, load_ts=TS0)
    assert dim.exceptAll(again).count() == 0 and again.count() == dim.count()


def test_initial_load_discards_target(spark, fin):
    a = dt.date(1998, 7, 15)
    target = generate_date_dim(spark, START, dt.date(1996, 1, 1), fin, a, load_ts=TS0)
    out = generate_date_dim(spark, dt.date(1997, 1, 1), END, fin, a, target=target, initial_load=True, load_ts=TS1)
    assert out.agg(F.min("calendar_date")).first()[0] == dt.date(1997, 1, 1)
    assert out.count() == (END - dt.date(1997, 1, 1)).days


def test_old_status_survives_generate(spark, fin):
    """A NULL in the stage never clears the target (kept quirk)."""
    old = generate_date_dim(spark, START, END, fin, dt.date(1996, 7, 15), load_ts=TS0)
    new = generate_date_dim(spark, START, END, fin, dt.date(1999, 7, 15), target=old, load_ts=TS1)
    r = new.where(F.col("calendar_date") == dt.date(1995, 3, 1)).first()
    assert r["fin_year_status"] == "2 Year Back"  # from the old as-of (FY1997); the new one is NULL


def test_versioned_table(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    assert t.current_version() is None and t.read() is None
    assert t.write(spark.range(5)) == (1, 5)
    assert t.write(spark.range(7)) == (2, 7)
    assert t.read().count() == 7 and t.read(1).count() == 5


def test_procedures_generate_then_roll(spark, fin, scratch):
    table, logs = VersionedTable(spark, f"{scratch}/dim_date"), LogTables(spark, scratch)
    assert generate_dim_date_procedure(spark, table, logs, START, dt.date(1999, 1, 1), fin, dt.date(1998, 7, 14),
                                       initial_load=True) == "ALL OK"
    assert generate_dim_date_procedure(spark, table, logs, dt.date(1998, 1, 1), END, fin, dt.date(1998, 7, 14)) == "ALL OK"
    assert roll_dim_date_procedure(spark, table, logs, as_of=dt.date(1998, 7, 15)) == "ALL OK"
    assert table.current_version() == 3
    dim = table.read()
    assert dim.count() == 2922 and dim.columns == schemas.DIM_DATE_COLUMNS
    assert dim.where(F.col("day_status") == "Today").first()["calendar_date"] == dt.date(1998, 7, 15)
    audit = logs.audit().orderBy("audit_key").collect()
    first, second = (dt.date(1999, 1, 1) - START).days, (END - dt.date(1998, 1, 1)).days
    staged = ["insert date spine", "insert calendar", "insert financial calendar", "insert joined", "insert stage"]
    want = [(s, f"number of rows inserted: {first}") for s in staged]
    want += [("truncate dim_date", "number of rows deleted: 0"),
             ("merge into dim_date", f"number of rows inserted: {first}, number of rows updated: 0")]
    want += [(s, f"number of rows inserted: {second}") for s in staged]
    want += [("merge into dim_date", f"number of rows inserted: {2922 - first}, number of rows updated: 365"),
             ("update dim_date", "number of rows updated: 2922")]
    assert [(r["sql_step"], r["step_result"]) for r in audit] == want
    assert [r["audit_key"] for r in audit] == list(range(1, len(want) + 1))


def test_roll_failure_is_logged_and_raised(spark, fin, scratch):
    table, logs = VersionedTable(spark, f"{scratch}/dim_date"), LogTables(spark, scratch)
    generate_dim_date_procedure(spark, table, logs, START, END, fin, dt.date(1998, 7, 14), initial_load=True)
    with pytest.raises(Exception):
        roll_dim_date_procedure(spark, table, logs, as_of=dt.date(2030, 1, 1))
    err = logs.errors().collect()
    assert len(err) == 1 and err[0]["procedure_name"] == "ROLL_DIM_DATE" and err[0]["error_code"] == "AsOfNotFound"
    assert table.current_version() == 1  # the failed roll left the dimension as it was


def test_run_step_cases(spark, scratch):
    logs = LogTables(spark, scratch)
    assert run_step(spark, logs, "P", "ok", "SELECT count(*) AS n FROM range(10)") == "n: 10"
    msg = run_step(spark, logs, "P", "analysis", "SELECT no_such_column FROM range(1)")
    assert msg.startswith("analysis failed:")
    msg = run_step(spark, logs, "P", "runtime", "SELECT sum(cast(concat('x', id) AS int)) AS s FROM range(3)")
    assert msg.startswith("runtime failed:")
    msg = run_step(spark, logs, "P", "empty", "SELECT id FROM range(0)")
    assert msg.startswith("empty failed:")
    # the whole statement runs: an error in its last partition, or in another column, is an error
    late = spark.range(0, 100, 1, 10).select(F.col("id"), F.when(F.col("id") == 99, "x").otherwise("1").cast("int").alias("v"))
    assert run_step(spark, logs, "P", "late", late).startswith("late failed:")
    assert run_step(spark, logs, "P", "first", "SELECT id, id AS id FROM range(0, 100, 1, 10) ORDER BY 1 DESC") == "id: 99"
    errs = {r["sql_step"]: r for r in logs.errors().collect()}
    assert errs.pop("late")["error_code"] == "CAST_INVALID_INPUT"
    assert errs["analysis"]["error_code"] == "UNRESOLVED_COLUMN.WITH_SUGGESTION"
    assert errs["runtime"]["error_code"] == "CAST_INVALID_INPUT" and errs["runtime"]["error_state"] == "22018"
    assert errs["empty"]["error_code"] == "EmptyResult"
    assert sorted(r["error_key"] for r in errs.values()) == [1, 2, 3]
    assert logs.audit().count() == 2


def test_generate_failure_is_logged_and_raised(spark, fin, scratch):
    table, logs = VersionedTable(spark, f"{scratch}/dim_date"), LogTables(spark, scratch)
    with pytest.raises(Exception):
        generate_dim_date_procedure(spark, table, logs, START, END, fin, dt.date(2040, 1, 1), initial_load=True)
    err = logs.errors().first()
    assert err["procedure_name"] == "GENERATE_DIM_DATE" and err["error_code"] == "AsOfNotFound"
    assert table.current_version() is None


def test_command_line(spark, fin, scratch):
    from caldim.__main__ import main

    fin.write.parquet(f"{scratch}/fin")
    assert main(["generate", "--start", "1994-01-01", "--end", "2002-01-01", "--fin", f"{scratch}/fin",
                 "--base", scratch, "--as-of", "1998-07-14", "--initial-load"]) == 0
    assert main(["roll", "--base", scratch, "--as-of", "1998-07-15"]) == 0
    assert main(["time-of-day", "--base", scratch]) == 0
    dim = VersionedTable(spark, f"{scratch}/dim_date")
    assert dim.current_version() == 2 and dim.read().count() == 2922
    assert VersionedTable(spark, f"{scratch}/dim_time_of_day").read().count() == 86_400
    steps = [r["sql_step"] for r in LogTables(spark, f"{scratch}/logs").audit().collect()]
    assert len(steps) == 9 and {"merge into dim_date", "update dim_date", "create dim_time_of_day"} <= set(steps)


def test_interrupted_write_keeps_current_version(spark, scratch):
    from pyspark.sql import functions as F

    t = VersionedTable(spark, f"{scratch}/t")
    t.write(spark.range(3))
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.lit("x")).otherwise(F.col("id").cast("string"))
                                   .cast("int").alias("id"))
    with pytest.raises(Exception):
        t.write(bad)  # fails inside the job (ANSI cast), after some tasks may have written
    assert t.current_version() == 1 and t.read().count() == 3
    assert t.write(spark.range(5)) == (2, 5)  # the retry writes a fresh folder; the failed one is never read
    assert t.read().count() == 5


def test_pointer_names_a_whole_version(spark, scratch):
    """A folder without a pointer to it is no version; the next write replaces it."""
    t = VersionedTable(spark, f"{scratch}/t")
    t.write(spark.range(3))
    spark.range(99).write.parquet(f"{scratch}/t/v=2")  # a writer that died before it moved the pointer
    assert t.current_version() == 1 and t.read().count() == 3
    with pytest.raises(FileNotFoundError):
        t.read(2)
    assert t.write(spark.range(4)) == (2, 4)
    assert t.read().count() == 4 and t.read(1).count() == 3
    assert VersionedTable(spark, f"{scratch}/t/").current_version() == 2


def test_a_version_may_be_computed_from_the_one_before(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.write(spark.range(3))
    for k in range(3):
        t.write(t.read().unionByName(spark.range(100 + k, 101 + k)))
    assert t.current_version() == 4 and t.read().count() == 6 and t.read(2).count() == 4


def test_log_keys_follow_the_newest_append(spark, scratch):
    """Keys stay gapless over appends of several rows, and over one that failed."""
    logs = LogTables(spark, scratch)
    assert logs.log_audits("p", [("a", "1"), ("b", "2"), ("c", "3")]) == 1
    assert logs.log_audit("p", "d", "4") == 4
    logs.audit().limit(0).write.parquet(f"{logs.audit_path}/from={5:020d}")  # an append without rows
    assert logs.log_audits("p", [("e", "5"), ("f", "6")]) == 5
    assert logs.log_error("p", "s", None, "m", None, None) == 1 and logs.log_error("p", "s", None, "m", None, None) == 2
    assert sorted(r.audit_key for r in logs.audit().collect()) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.error_key for r in logs.errors().collect()) == [1, 2]


def test_work_folder_needs_a_shared_place_on_a_cluster(spark, monkeypatch):
    from caldim import session

    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

        def set(self, key, value):
            pass

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(Session(master))
    assert session.checkpoint_dir(Session("local[2]"))


def test_command_line_step(spark, scratch):
    from caldim.__main__ import main

    ok = main(["step", "--base", scratch, "--procedure", "test_procedure", "--step", "count_step",
               "--sql", "select count(*) AS n from fact_sales", "--view", "fact_sales=/root/testdata/sf0.01/orders.parquet"])
    bad = main(["step", "--base", scratch, "--procedure", "test_procedure", "--step", "bad_step",
                "--sql", "select nope from fact_sales"])
    assert (ok, bad) == (0, 1)
    logs = LogTables(spark, f"{scratch}/logs")
    assert logs.audit().first()["step_result"] == "n: 15000"
    assert logs.errors().first()["sql_step"] == "bad_step"


def test_command_line_step_with_a_bad_view_is_logged(spark, scratch):
    from caldim.__main__ import main

    assert main(["step", "--base", scratch, "--procedure", "p", "--step", "s", "--sql", "select 1",
                 "--view", "no_equals_sign"]) == 1
    assert main(["step", "--base", scratch, "--procedure", "p", "--step", "t", "--sql", "select 1",
                 "--view", f"x={scratch}/missing"]) == 1
    assert sorted(r["sql_step"] for r in LogTables(spark, f"{scratch}/logs").errors().collect()) == ["s", "t"]


def test_command_line_load(spark, scratch, capsys):
    from caldim.__main__ import main

    src = "/root/testdata/sf0.001/orders.parquet"
    run = lambda until: main(["load", "--base", scratch, "--source", src, "--table", "orders", "--time-column", "o_orderdate",
                              "--schema", "tpch", "--until", until])
    assert run("1998-01-01") == 0 and run("2003-01-01") == 0 and run("2003-01-01") == 0
    lines = [x for x in capsys.readouterr().out.splitlines() if x.startswith("rows loaded")]
    loaded = [int(x.split(",")[0].split(": ")[1]) for x in lines]
    assert sum(loaded) == spark.read.parquet(src).count() == spark.read.parquet(f"{scratch}/orders").count()
    assert loaded[0] > 0 and loaded[2] == 0 and all("late: 0, without time: 0" in x for x in lines)
    assert str(LogTables(spark, f"{scratch}/logs").last_process_date("orders", "tpch")) == "2003-01-01 00:00:00"


def test_a_failing_audit_write_is_told_from_a_failing_step(spark, scratch, monkeypatch):
    logs = LogTables(spark, scratch)

    def broken(*_, **__):
        raise OSError("no space left")

    monkeypatch.setattr(logs, "log_audit", broken)
    assert run_step(spark, logs, "P", "count", "SELECT 1 AS n") == "count (audit) failed: no space left"
    assert [(r.sql_step, r.error_code) for r in logs.errors().collect()] == [("count (audit)", "OSError")]
    with pytest.raises(OSError):
        run_step(spark, logs, "P", "count", "SELECT 1 AS n", raise_errors=True)
