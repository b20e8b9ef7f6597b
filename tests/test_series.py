"""Operators over whole histories: against the single-date jobs, brute force and
their plans."""

import datetime as dt
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from caldim.operators import bands, effective, facts, numbering, rollups, runs
from caldim.operators.maintenance import MaintainedRollup
from caldim.operators.to_date import to_date_all_days
from caldim.plans import catalog as C
from caldim.plans import catalog_series as S
from caldim.session import work_dir
from conftest import SF0001
from test_entry import TABLES, _norm


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, column):
    return len(re.findall(rf"FileScan parquet [^\n]*{column}", plan))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(S.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    srows, scols = [r.asDict() for r in sdf.collect()], sdf.columns
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = [dict(zip(ocols, r)) for r in res.fetchall()]
    assert sorted(scols) == sorted(ocols) and srows
    key = sorted(scols)
    text = lambda rows: sorted("|".join(_norm(r[c]) for c in key) for r in rows)
    assert text(srows) == text(orows)


# every as-of date


@pytest.mark.parametrize("as_of", [C.AS_OF, dt.date(1997, 1, 3), dt.date(2000, 2, 29), dt.date(1999, 12, 31)])
def test_all_days_hold_each_single_day(spark, as_of):
    """On any as-of date the same rows as the job for one: period borders, New
    Year within a financial period, leap days."""
    i = C.Inputs(spark, SF0001, (C.START, C.END))
    orders = C.read_table(spark, SF0001, "orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    one = facts.period_to_date(orders, "o_orderdate", {"sales": C._money("o_totalprice")}, i.dim(as_of=as_of), by=["o_orderpriority"])
    one = one.select("o_orderpriority", *[F.col(c).cast("double") if c.endswith("_sales") else F.col(c) for c in one.columns[1:]])
    got = S.orders_to_date_all_days_q(spark, SF0001).where(F.col("as_of") == F.lit(as_of)).drop("as_of")
    assert sorted(map(str, got.collect())) == sorted(map(str, one.select(got.columns).collect()))


def test_all_days_plan(spark):
    """One scan of the fact, no window without a partition, no nested loop."""
    plan = plan_of(S.orders_to_date_all_days_q(spark, SF0001))
    assert "SinglePartition" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    final = plan.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in plan else plan
    assert "windowspecdefinition(o_orderpriority" in final


def test_all_days_of_odd_rows(spark, fin):
    dim = fin.select("calendar_date", F.col("financial_year").alias("fin_year"), F.col("financial_period").alias("fin_period"))
    rows = [("a", dt.date(1998, 3, 1), 5), ("a", None, 7), (None, dt.date(1998, 3, 2), 1), ("b", dt.date(1950, 1, 1), 9), ("a", dt.date(1998, 3, 1), None)]
    df = spark.createDataFrame(rows, "g string, d date, v int")
    kw = dict(by=["g"], first=dt.date(1998, 3, 1), last=dt.date(1998, 3, 9))
    got = {(r.g, r.as_of): (r.wtd_rows, r.wtd_s, r.mtd_rows, r.lw_wtd_rows) for r in to_date_all_days(df, "d", {"s": F.col("v")}, dim, **kw).collect()}
    assert got["a", dt.date(1998, 3, 1)] == (2, 5, 2, 0) and got["a", dt.date(1998, 3, 2)] == (0, None, 2, 0)
    assert got["a", dt.date(1998, 3, 8)] == (0, None, 2, 2) and got[None, dt.date(1998, 3, 2)] == (1, 1, 1, 0)
    assert len(got) == 9 + 8 and not any(g == "b" for g, _ in got)
    assert to_date_all_days(df.limit(0), "d", {"s": F.col("v")}, dim, **kw).count() == 0


# gapless numbers


def test_numbers_do_not_depend_on_partitions(spark):
    items = C.read_table(spark, SF0001, "lineitem", *S.LINE_ORDER)
    hot = items.withColumn("l_shipdate", F.when(F.col("l_orderkey") % 3 == 0, F.lit("1999-01-01").cast("timestamp_ntz")).otherwise(F.col("l_shipdate")))
    found = [numbering.number_rows(hot.repartition(p), S.LINE_ORDER, "k", partitions=n).orderBy("k").collect() for p, n in ((1, 1), (7, 5), (3, 16))]
    assert found[0] == found[1] == found[2]
    assert [r.k for r in found[0]] == list(range(1, hot.count() + 1))
    assert [r.l_shipdate for r in found[0]] == sorted(r.l_shipdate for r in found[0])


def test_numbers_plan_and_hot_value(spark, monkeypatch, scratch):
    """No window, no single partition; one date's rows lie in several tasks."""
    items = C.read_table(spark, SF0001, "lineitem", *S.LINE_ORDER).withColumn("l_shipdate", F.lit("1999-01-01").cast("timestamp_ntz"))
    monkeypatch.setattr(numbering, "work_dir", lambda *_: f"{scratch}/ordered")
    plan = plan_of(numbering.number_rows(items, S.LINE_ORDER, "k", partitions=8))
    assert "Window" not in plan and "SinglePartition" not in plan
    parts = spark.read.parquet(f"{scratch}/ordered").groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 0.4 * items.count()


def test_numbers_of_few_rows(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (1,)], "v int")
    assert [tuple(r) for r in numbering.number_rows(df, ["v"], first=10).orderBy("row_key").collect()] == [(10, None), (11, 1), (12, 1), (13, 3)]
    assert numbering.number_rows(df.limit(0), ["v"]).count() == 0


def test_running_totals_by_block(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), k, rng.choice([None, 1, 2, 5])) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    got = numbering.running_total(df, ["g"], ["t"], {"v": F.col("v")}, F.expr("t div 7")).collect()
    sums = {}
    want = {}
    for g, t, v in rows:
        if v is not None:
            sums[g] = sums.get(g, 0) + v
        want[g, t] = sums.get(g)
    assert {(r.g, r.t): r.v for r in got} == want


# versions


def states(spark):
    rows = {
        1: [("a", 1), ("b", 2), ("c", None)],
        2: [("a", 1), ("b", 3), ("d", 4), ("c", None)],
        3: [("b", 3), ("d", 5), ("c", 0)],
        4: [("a", 1), ("b", 2), ("d", 5), ("c", 0)],
    }
    return {k: spark.createDataFrame(v, "k string, v int") for k, v in rows.items()}, rows


def test_versions_hold_every_state(spark):
    """Unchanged rows stay, changed, gone, new and returning ones are versioned;
    each day's valid versions are that day's state."""
    frames, rows = states(spark)
    day = lambda k: dt.date(2020, k, 1)
    versions = effective.open_versions(frames[1], ["v"], day(1))
    for k in (2, 3, 4):
        versions = effective.apply_snapshot(versions, frames[k], ["k"], ["v"], day(k))
    got = versions.collect()
    for k, want in rows.items():
        valid = [(r.k, r.v) for r in got if r.valid_from <= day(k) < r.valid_to]
        assert sorted(valid, key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.version, r.valid_from, r.valid_to))
    assert len(by["b"]) == 3 and len(by["c"]) == 2 and by["a"][0][0] == 1
    for v in by.values():
        v.sort()
        assert [x[0] for x in v] == list(range(1, len(v) + 1)) and all(a[2] <= b[1] for a, b in zip(v, v[1:]))
    again = effective.apply_snapshot(versions, frames[4], ["k"], ["v"], day(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_as_of_join_by_broadcast_and_by_cells(spark, monkeypatch):
    frames, _ = states(spark)
    versions = effective.open_versions(frames[1], ["v"], dt.date(2018, 1, 1))
    for k in (2, 3, 4):
        versions = effective.apply_snapshot(versions, frames[k], ["k"], ["v"], dt.date(2018 + k, 6, 1))
    rng = random.Random(3)
    days = [dt.date(2017, 6, 1) + dt.timedelta(rng.randrange(3000)) for _ in range(200)]
    rows = [(k, rng.choice(["a", "b", "c", "d", "z", None]), d) for k, d in enumerate(days)] + [(999, "a", None)]
    df = spark.createDataFrame(rows, "i int, key string, t date")
    join = lambda: effective.as_of_join(df, versions, {"key": "k"}, "t", ["v", "version"])
    held = versions.collect()
    want = []
    for i, key, t in rows:
        m = [(r.v, r.version) for r in held if r.k == key and t and r.valid_from <= t < r.valid_to]
        assert len(m) <= 1
        want.append((i, key, t, *(m[0] if m else (None, None))))
    few = join()
    assert sorted(map(tuple, few.collect())) == sorted(want)
    monkeypatch.setattr(effective, "BROADCAST_MAX_ROWS", 3)
    many = join()
    assert sorted(map(tuple, many.collect())) == sorted(want)
    assert all("NestedLoop" not in plan_of(x) and "Cartesian" not in plan_of(x) for x in (few, many))


# bands


def test_fixed_dayparts_as_bands(spark):
    """From a table of bands the same totals as from the fixed rule."""
    events = C._events(spark, SF0001, "ts", "value").withColumn("g", F.lit("all"))
    got = bands.band_totals(events, "ts", "g", bands.daypart_bands(spark), {"s": C._money("value")})
    want = {r.daypart: (r.n_rows, r.value_sum) for r in C.events_daypart_q(spark, SF0001).collect() if r.n_rows}
    assert {r.band: (r.rows, float(r.s)) for r in got.collect()} == want
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_bands_of_any_shape(spark):
    table = [("x", "A", 0, 1440), ("x", "A", 60, 120), (None, "N", 1380, 60), ("y", "EQ", 600, 600), ("y", "none", None, 5), ("q", "unused", 0, 5)]
    at = lambda m, s=0: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m, seconds=s)
    rows = [(g, at(m, s)) for g in ("x", "y", None) for m, s in ((0, 0), (59, 59), (60, 0), (61, 0), (600, 0), (1379, 59), (1380, 0))] + [("x", None)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("g", T.StringType()), T.StructField("t", T.TimestampNTZType())]))
    want = {}
    for g, t in rows:
        m = t.hour * 60 + t.minute if t else None
        hit = {b for bg, b, a, e in table if t and None not in (a, e) and (bg is None or bg == g) and ((a <= m < e) if a < e else (m >= a or m < e))}
        for b in hit or {None}:
            want[g, b] = want.get((g, b), 0) + 1
    got = bands.band_totals(df, "t", "g", spark.createDataFrame(table, bands.BANDS), {}).collect()
    assert {(r.g, r.band): r["rows"] for r in got} == want and len(got) == len(want)
    none = spark.createDataFrame([], bands.BANDS)
    assert {(r.g, r.band): r["rows"] for r in bands.band_totals(df, "t", "g", none, {}).collect()} == {("x", None): 8, ("y", None): 7, (None, None): 7}


# runs, gaps and series


@pytest.mark.parametrize("block", [1, 4, 64])
def test_runs_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(runs, "BLOCK", block)
    rng = random.Random(block)
    held = {k: sorted(rng.sample(range(-40, 60), rng.randint(1, 70))) for k in ["a", "b", "c", None]} | {"one": [5]}
    rows = [(k, u) for k, us in held.items() for u in us for _ in range(rng.randint(1, 3))] + [("a", None), ("gone", None)]
    df = spark.createDataFrame(rows, "k string, u int")
    want = {}
    for k, us in held.items():
        parts = [[us[0], us[0]]]
        for u in us[1:]:
            if u == parts[-1][1] + 1:
                parts[-1][1] = u
            else:
                parts.append([u, u])
        want[k] = parts
    found = runs.runs(df, "k", "u")
    got = {}
    for r in found.collect():
        got.setdefault(r.k, []).append([r.first, r.last])
    assert {k: sorted(v) for k, v in got.items()} == want
    for r in runs.gap_summary(found, "k").collect():
        p = want[r.k]
        gaps = [(b[0] - a[1] - 1, a[1] + 1) for a, b in zip(p, p[1:])]
        longest = max(gaps, key=lambda g: (g[0], -g[1])) if gaps else (0, None)
        assert (r.active, r.runs, r.gaps, r.longest_gap, r.longest_gap_from) == (len(held[r.k]), len(p), len(gaps), *longest)
        assert (r.longest_run, r.first, r.last) == (max(b - a + 1 for a, b in p), p[0][0], p[-1][1])


def test_balance_against_brute_force(spark):
    rng = random.Random(7)
    rows = {(rng.choice(["a", "b", None]), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(200))): rng.choice([1, -2, 0, 10]) for _ in range(60)}
    rows["one", dt.date(2020, 5, 5)] = 3
    df = spark.createDataFrame([(k, d, v) for (k, d), v in rows.items()], "k string, d date, v int")
    want = set()
    for k in {k for k, _ in rows}:
        days = sorted(d for x, d in rows if x == k)
        day, balance, last = days[0], 0, None
        while day <= days[-1]:
            v = rows.get((k, day))
            balance, last = balance + (v or 0), v if v is not None else last
            want.add((k, day, v or 0, balance, last))
            day += dt.timedelta(1)
    got = runs.daily_balance(df, "k", "d", "v")
    assert {tuple(r) for r in got.collect()} == want
    assert runs.daily_balance(df.limit(0), "k", "d", "v").count() == 0
    assert "NestedLoop" not in plan_of(got) and "SinglePartition" not in plan_of(got)


def test_balance_reads_once_and_makes_days_last(spark):
    """The line items are read once, nothing is joined, a key's days with a movement
    are dealt and sorted once, and the days between are made and the figures cast
    behind that."""
    plan = plan_of(E.queries()["supplier_daily_balance"](spark, SF0001))
    assert scans(plan, "l_suppkey") == 1 and "Join" not in plan
    assert plan.count("Exchange ") == 2 and plan.count("Sort [") == 1
    top, below = plan.split("Generate explode")  # the plan's top comes first
    assert "Window" not in top and "cast(" not in top and "Window" in below


def test_balance_of_odd_rows(spark):
    """Rows without a day are left out; a movement of null counts as zero and is
    not carried; a single day, days before 1970, a leap day and the type asked for."""
    day = dt.date.fromisoformat
    rows = [
        ("a", day("2020-02-28"), None), ("a", day("2020-03-01"), 5), ("a", day("2020-03-02"), None), ("a", None, 7),
        (None, day("1969-12-31"), 2), (None, day("1970-01-02"), -2), ("gone", None, 1), ("none", day("2021-01-01"), None),
    ]
    df = spark.createDataFrame(rows, "k string, d date, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = runs.daily_balance(df, "k", "d", "v", "double")
    assert got.dtypes == [("k", "string"), ("d", "date"), ("v", "double"), ("balance", "double"), ("last_movement", "double")]
    assert sorted([(r[0] or "", str(r[1]), *r[2:]) for r in got.collect()]) == [
        ("", "1969-12-31", 2.0, 2.0, 2.0), ("", "1970-01-01", 0.0, 2.0, 2.0), ("", "1970-01-02", -2.0, 0.0, -2.0),
        ("a", "2020-02-28", 0.0, 0.0, None), ("a", "2020-02-29", 0.0, 0.0, None), ("a", "2020-03-01", 5.0, 5.0, 5.0), ("a", "2020-03-02", 0.0, 5.0, 5.0),
        ("none", "2021-01-01", 0.0, 0.0, None),
    ]


def test_densified_columns(spark):
    """Made days: zeros, values held, nulls; a date that comes twice keeps both rows."""
    day = dt.date.fromisoformat
    df = spark.createDataFrame([(1, day("2020-01-01"), 4, 8, 9), (1, day("2020-01-03"), None, 7, None), (1, day("2020-01-03"), None, 7, None)], "k int, d date, z int, h int, o int")
    got = sorted(map(tuple, runs.densified(df, "k", "d", ["z"], ["h"]).collect()), key=str)
    assert got == [(1, day("2020-01-01"), 4, 8, 9), (1, day("2020-01-02"), 0, 8, None), *[(1, day("2020-01-03"), 0, 7, None)] * 2]


def test_blocks_or_whole_groups(spark):
    """Running totals and carried values are the same with blocks as without."""
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice(["a", "b", None]), t, rng.choice([None, None, 1, 2])) for t in range(200)], "g string, t int, v int")
    for f in (
        lambda block: numbering.running_total(df, ["g"], ["t"], {"v": F.col("v"), "w": F.col("v").cast("decimal(18,2)")}, block),
        lambda block: runs.carried_forward(df, ["g"], "t", ["v"], block),
    ):
        whole, blocks = f(None), f(F.expr("t div 7"))
        assert whole.dtypes == blocks.dtypes and sorted(map(str, whole.collect())) == sorted(map(str, blocks.collect()))


# maintained rollups


def test_maintained_rollup(spark, scratch):
    """Equal to a rebuild after each batch, also when one is run twice; unknown
    operations raise; folding changes nothing."""
    fact, rng = {}, random.Random(4)
    store = MaintainedRollup(spark, f"{scratch}/r", ["g"], {"s": F.col("v")})
    for batch in (1, 2, 3, 4):
        changes = []
        for _ in range(40):
            if fact and rng.random() < 0.3:
                changes.append((*fact.pop(rng.choice(list(fact))), "D"))
            else:
                row = (rng.choice(["x", "y", None]), rng.choice([None, *(dt.date(2020, 1, d) for d in range(1, 9))]), rng.randint(1, 9))
                fact[len(fact), batch, rng.random()] = row
                changes.append((*row, "I"))
        df = spark.createDataFrame(changes, "g string, d date, v int, op string")
        for _ in range(batch % 2 + 1):
            store.apply(batch, df, "op", "d", dt.date(2020, 1, batch + 2))
        want = {}
        for g, d, v in fact.values():
            n, s = want.get((d, g), (0, 0))
            want[d, g] = (n + 1, s + v)
        assert {(r.day, r.g): (r["rows"], r.s) for r in store.read().collect()} == want
        c = store.counts().where(f"batch = {batch}").first()
        mark = dt.date(2020, 1, batch + 2)
        assert (c.inserted, c.deleted) == (sum(x[3] == "I" for x in changes), sum(x[3] == "D" for x in changes))
        assert c.late == sum(x[3] == "I" and x[1] is not None and x[1] < mark for x in changes)
        assert c.without_day == sum(x[1] is None for x in changes)
    folded = store.fold(f"{scratch}/folded")
    assert sorted(map(str, folded.read().collect())) == sorted(map(str, store.read().collect()))
    bad = spark.createDataFrame([("x", dt.date(2020, 1, 1), 1, "U")], "g string, d date, v int, op string")
    with pytest.raises(Exception, match="unknown operation"):
        store.apply(9, bad, "op", "d")


def test_maintained_rollup_reads_no_fact(spark):
    plan = plan_of(S.orders_rollup_maintained_q(spark, SF0001))
    assert len(re.findall("FileScan parquet", plan)) == 1 and "o_totalprice" not in plan and "batch#" in plan


def test_late_rows_below_the_mark_are_counted(spark, scratch):
    from caldim.sources.logs import LogTables

    logs, t = LogTables(spark, f"{scratch}/logs"), lambda d: dt.datetime(2020, 1, d)
    rows = lambda days: spark.createDataFrame([(t(d),) for d in days], T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    load = lambda df, d: facts.incremental_load(spark, logs, df, "ts", f"{scratch}/t", "tab", upper=t(d))[:2]
    late = lambda df: facts.late_rows(logs, df, "ts", "tab")
    assert late(rows([1, 2])) == 0
    assert load(rows([1, 2, 2, 5]), 3) == (3, t(3)) and late(rows([1, 2, 2, 5])) == 0
    assert load(rows([1, 2, 2, 5, 1, 2]), 6) == (1, t(6)) and late(rows([1, 2, 2, 5, 1, 2])) == 2
    assert [r.step_result for r in logs.audit().collect()] == ["rows of ts below the mark that no load took: 2"]


# sketches


def test_sketch_estimates_and_decisions(spark):
    orders = C.read_table(spark, SF0001, "orders", "o_orderdate", "o_orderpriority", "o_custkey", "o_totalprice")
    sk = rollups.daily_sketches(orders, "o_orderdate", ["o_orderpriority"], "o_custkey", "o_totalprice").cache()
    exact = orders.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("n"), F.percentile("o_totalprice", F.lit(0.5)).alias("m"))
    exact = {r.o_orderpriority: (r.n, r.m) for r in exact.collect()}
    share = F.kll_sketch_get_rank_double("values", F.lit(200_000.0))
    below = {r.o_orderpriority: r.s for r in orders.groupBy("o_orderpriority").agg(F.avg((F.col("o_totalprice") < 200_000).cast("int")).alias("s")).collect()}
    for r in rollups.merged(sk, ["o_orderpriority"]).select("o_orderpriority", F.hll_sketch_estimate("keys").alias("n"), share.alias("s")).collect():
        assert abs(r.n - exact[r.o_orderpriority][0]) <= 5 * rollups.DISTINCT_ERROR * r.n + 1
        assert abs(r.s - below[r.o_orderpriority]) <= 2 * rollups.RANK_ERROR
    sets = spark.createDataFrame([("all", d.day) for d in sk.select("day").distinct().collect()], "name string, day date")
    args = (orders, "o_orderdate", ["o_orderpriority"], "o_custkey", "o_totalprice")
    some = sorted(n for n, _ in exact.values())
    for least, limit in ((some[2], exact["1-URGENT"][1]), (some[0] + 1, 1.0), (10**6, 10.0**9)):
        got = rollups.decisions(sk, sets, *args, least, limit)
        for r in got.collect():
            n, _ = exact[r.o_orderpriority]
            assert r.many == (n >= least)
            assert r.half_below == (orders.where(F.col("o_orderpriority") == r.o_orderpriority).where(F.col("o_totalprice") < limit).count() * 2 >= r["rows"])
    far = rollups.decisions(sk, sets, orders.where("o_custkey > raise_error('read')"), *args[1:], 10**6, 10.0**9)
    assert far.count() == 5  # the fact is not read where no decision is open


# hierarchies


def test_hierarchy_tells_null_labels_from_subtotals(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, None, 4), (None, "y", 8)], "p string, c string, v int")
    got = rollups.hierarchy_totals(df, {"h": ["p", "c"], "other": ["c"]}, ["v"])
    want = {
        ("all", "all", None, None, 15), ("h", "p", "a", None, 3), ("h", "p", None, None, 12), ("h", "c", "a", "x", 1), ("h", "c", "a", None, 2),
        ("h", "c", None, None, 4), ("h", "c", None, "y", 8), ("other", "c", None, "x", 1), ("other", "c", None, "y", 8), ("other", "c", None, None, 6),
    }
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_hierarchy_scans_once(spark):
    assert scans(plan_of(S.orders_hierarchy_totals_q(spark, SF0001)), "o_totalprice") == 1


# sessions


def test_session_stream_equals_its_batch(spark):
    """Sessions and counts over restarts equal those of the events on time (the
    SQL), and nothing is lost from the counts."""
    rows = S.events_stream_sessions_q(spark, SF0001).collect()
    counts = {r.kind: r.events for r in rows if r.kind != "session"}
    events = C._events(spark, SF0001, "event_id", "ts").count()
    assert set(counts) == {"without_time", "late", "repeated"} and all(v > 0 for v in counts.values())
    assert sum(r.events for r in rows if r.kind == "session") <= events


def test_stream_of_dayparts_counts_rows_without_a_time(spark, scratch):
    from caldim.streaming.daypart_stream import read_latest, start_daypart_stream
    from caldim.streaming.sessions import batch_counts

    at = dt.datetime(2024, 1, 1, 9)
    df = spark.createDataFrame([(at, 1.0), (None, 2.0), (at, 3.0), (None, None)], T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())]))
    df.write.parquet(f"{scratch}/in")
    q = start_daypart_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/cp")
    q.awaitTermination()
    assert sum(r.events for r in read_latest(spark, f"{scratch}/out").collect()) == 2
    assert [sum(x) for x in zip(*batch_counts(q))][1:4] == [4, 2, 0]
